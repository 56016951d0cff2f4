"""Source divergence audit: how far the words of each source of a language are from those of its other sources.

Tasks count words with Arrow compute functions (``ascii_lower``, ``split_pattern_regex``, ``dictionary_encode``, hash
``group_by``) and pass on partial counts; merged and sorted by term, these are read as columnar shards, in which terms'
divergences are computed and those of pairs of sources summed. All arithmetic is on integers and exact.

Null text, lang and source count as ''. A term is a maximal run of ASCII letters and characters above ASCII, with A-Z in
lower case. Each language keeps the terms of at least ``least_docs`` of its rows. A group is an occurring (lang, source),
also one without terms. Rows count as they are repeated; other columns, whatever their names, are not read; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.graph import landed, small_batches

#: Everything between terms.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1_000_000_000
#: Bytes of text counted at a time, partial counts held by a task, rows of a shard's block, pairs compared at a time.
CHUNK_BYTES, HELD_ROWS, BLOCK_ROWS, PAIRS = 4 << 20, 400_000, 250_000, 250_000

COUNTED = pa.schema([("lang", pa.large_string()), ("source", pa.large_string()), ("term", pa.large_string()),
                     ("n", pa.int64()), ("docs", pa.int64())])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches with large strings, small ones joined up to CHUNK_BYTES of text."""
    held, size = [], 0

    def joined() -> list[pa.RecordBatch]:
        return pa.Table.from_batches(held).combine_chunks().to_batches() if held else []

    for batch in batches:
        used = batch.column("text").nbytes
        if size + used > CHUNK_BYTES:
            yield from joined()
            held, size = [], 0
        held.append(pa.RecordBatch.from_arrays([c.cast(pa.large_string()) for c in batch.columns], batch.schema.names))
        size += used
    yield from joined()


def _grouped(table: pa.Table, keys: list[str]) -> pa.TableGroupBy:
    """Grouped by one thread: each of several would hold groups of its own, as many times over as the machine has cores."""
    return table.group_by(keys, use_threads=False)


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most CHUNK_BYTES of text, or one row."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy())
    lo = 0
    while lo < batch.num_rows:
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + CHUNK_BYTES, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def _counted(batch: pa.RecordBatch) -> pa.Table:
    """Occurrences and documents per (lang, source, term); each occurring (lang, source) also has a row of the term ''."""
    rows = pa.table({"lang": batch.column("lang"), "source": batch.column("source"), "row": np.arange(batch.num_rows)})
    groups = _grouped(rows, ["lang", "source"]).aggregate([("row", "list")])
    group_of = np.empty(batch.num_rows, np.int64)
    group_of[groups["row_list"].combine_chunks().flatten()] = pc.list_parent_indices(groups["row_list"]).combine_chunks()

    words = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), BETWEEN)
    term, doc = words.flatten(), pc.list_parent_indices(words)
    some = pc.not_equal(term, "")
    coded = term.filter(some).dictionary_encode()
    per_doc = _grouped(pa.table({"doc": doc.filter(some), "term": coded.indices}), ["doc", "term"]).aggregate([([], "count_all")])
    of_group = pa.table({"group": group_of[per_doc["doc"].to_numpy()], "term": per_doc["term"], "n": per_doc["count_all"]})
    grouped = _grouped(of_group, ["group", "term"]).aggregate([("n", "sum"), ("n", "count")])
    group, none = grouped["group"], pa.array(np.zeros(len(groups), np.int64))
    counts = pa.table([groups["lang"].take(group), groups["source"].take(group), coded.dictionary.take(grouped["term"]),
                       grouped["n_sum"], grouped["n_count"]], schema=COUNTED)
    present = pa.table([groups["lang"], groups["source"], pa.array([""] * len(groups), pa.large_string()), none, none], schema=COUNTED)
    return pa.concat_tables([counts, present])


def _merged(tables: list[pa.Table]) -> pa.Table:
    merged = _grouped(pa.concat_tables(tables), ["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return merged.rename_columns(COUNTED.names).cast(COUNTED)


def partial_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, docs)``: one row for each term that a task meets in a group, or a few."""
    blank = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in _joined(batches):
            for chunk in _chunks(batch):
                held.append(_counted(chunk))
                if sum(t.num_rows for t in held) > HELD_ROWS:
                    held = [_merged(held)]
                    if held[0].num_rows > HELD_ROWS // 2:
                        yield from out(held.pop())
        if held:
            yield from out(_merged(held))

    def out(table: pa.Table) -> list[pa.RecordBatch]:
        small = pa.schema([(f.name, pa.string() if pa.types.is_large_string(f.type) else f.type) for f in COUNTED])
        return table.cast(small).to_batches(max_chunksize=50_000)

    return docs.select(*blank).mapInArrow(counted, "lang string, source string, term string, n long, docs long")


def kept_counts(docs: DataFrame, least_docs: int = 3) -> DataFrame:
    """``(lang, term, source, n, lang_n, leads)``: the kept terms' occurrences in a source and in the language.

    ``leads`` is 1 in one row of each term. A group also has a row of the term '', with 0 occurrences.
    """
    merged = (partial_counts(docs).repartition("lang", "term")
              .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    of_term = Window.partitionBy("lang", "term")
    return (merged.withColumn("lang_n", F.sum("n").over(of_term)).withColumn("lang_docs", F.sum("docs").over(of_term))
            .withColumn("row", F.row_number().over(of_term.orderBy("source")))
            .where((F.col("lang_docs") >= least_docs) | (F.col("term") == ""))
            .select("lang", "term", "source", "n", "lang_n", ((F.col("row") == 1) & (F.col("term") != "")).cast("long").alias("leads")))


def _whole(a: Column, b: Column) -> Column:
    """``floor(a / b)`` of longs, a at least 0."""
    return F.call_function("div", a, b)


def _share(count: Column | str, total: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / total)``, by long division in three steps of 1000, so that nothing overflows."""
    rest, share = (F.col(count) if isinstance(count, str) else count) + 1, F.lit(0).cast("long")
    for _ in range(3):
        rest = rest * 1000
        share, rest = share * 1000 + _whole(rest, total), rest % total
    return share + 1


def _divergence(p: Column, q: Column) -> Column:
    return _whole((p - q) * (p - q), q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by (lang, term) in blocks that end where a term ends."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < BLOCK_ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cuts = _term_starts(table)
        if len(cuts) > 1:
            yield table.slice(0, cuts[-1])
            table = table.slice(cuts[-1])
        held, rows = table.combine_chunks().to_batches(), table.num_rows
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def _codes(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().dictionary_encode().indices.to_numpy()


def _term_starts(table: pa.Table) -> np.ndarray:
    lang, term = _codes(table["lang"]), _codes(table["term"])
    return np.concatenate(([0], np.flatnonzero((np.diff(lang) != 0) | (np.diff(term) != 0)) + 1))


def _groups(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Number of each row's (lang, source), and a row of each number."""
    lang, source = _codes(table["lang"]).astype(np.int64), _codes(table["source"])
    _, first, group = np.unique(lang * (source.max() + 1) + source, return_index=True, return_inverse=True)
    return group, first


def _top_terms(table: pa.Table, group: np.ndarray, top: int) -> pa.RecordBatch:
    """The rows of the ``top`` largest divergences of each group among terms that are more frequent there than in the language."""
    p, q = table["p"].to_numpy(), table["q"].to_numpy()
    value = _f(p, q)
    rows = np.flatnonzero(p > q)
    rows = rows[np.lexsort((rows, -value[rows], group[rows]))]  # rows of a language are in order of their terms
    starts = np.flatnonzero(np.concatenate(([True], np.diff(group[rows]) != 0))) if len(rows) else np.empty(0, int)
    rank = np.arange(len(rows)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(rows)]))))
    rows = rows[rank < top]
    found = table.take(pa.array(rows)).combine_chunks()
    return _answer(found["lang"], found["source"], "term", found["term"], value[rows])


def _answer(lang, source, part: str, item, value: np.ndarray) -> pa.RecordBatch:
    columns = [lang, source, pa.array([part] * len(value), pa.string()), item, pa.array(value, pa.int64())]
    return pa.RecordBatch.from_arrays(
        [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns], ["lang", "source", "part", "item", "value"])


def _pair_sums(table: pa.Table, group: np.ndarray, first: np.ndarray) -> pa.RecordBatch:
    """Per ordered pair of groups, over the terms that both have: what f(p, p') adds to the sums that take either side's
    count as zero (see ``divergences``)."""
    p, zero = table["p"].to_numpy(), table["p0"].to_numpy()
    starts = _term_starts(table)
    size = np.diff(np.concatenate((starts, [len(p)])))
    keys, sums = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    n = len(first)

    def add(rows: np.ndarray, lo: int, hi: int) -> None:
        """Terms of one size, a term a line: its sources lo to hi against all of its sources."""
        a, b = rows[:, lo:hi, None], rows[:, None, :]
        value = _f(p[a], p[b]) - _f(p[a], zero[b]) - _f(zero[a], p[b]) + _f(zero[a], zero[b])
        key = group[a] * n + group[b]
        other = np.broadcast_to(a != b, key.shape)
        one, at = np.unique(key[other], return_inverse=True)
        total = np.zeros(len(one), np.int64)
        np.add.at(total, at, value[other])
        keys.append(one)
        sums.append(total)

    for k in np.unique(size[size > 1]).tolist():
        lines = starts[size == k][:, None] + np.arange(k)
        terms, sources = max(1, PAIRS // (k * k)), max(1, min(k, PAIRS // k))
        for at in range(0, len(lines), terms):
            for lo in range(0, k, sources):
                add(lines[at:at + terms], lo, min(k, lo + sources))
    one, at = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(one), np.int64)
    np.add.at(total, at, np.concatenate(sums))
    left, right = table.take(pa.array(first[one // max(n, 1)])), table.take(pa.array(first[one % max(n, 1)]))
    return _answer(left["lang"], left["source"], "pair", right["source"], total)


def divergences(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of every group (lang, source).

    A group and a language give each of the language's V kept terms the share ``1 + floor(10^9 (count + 1) / (N + V))``,
    N the sum of its counts. Part ``pair``: another source of the language, and the sum over all kept terms of
    ``floor((p - q)^2 / q)``, q that source's share. Part ``term``: the ``top`` terms with p above the language's share q.
    Rank from 1 by value descending, then item ascending.

    Most terms are in few sources, so the sum of a pair is taken apart, with a count of zero giving p0 and q0:
    V f(p0, q0), plus f(p, q0) - f(p0, q0) over the terms of the one, f(p0, q) - f(p0, q0) over those of the other, and
    for terms of both the rest. The first parts come from counts of counts, the last from the shards, where a term's
    sources meet; its pairs are summed there and leave as one row for each pair of sources.
    """
    small_batches(docs.sparkSession)
    kept = landed(kept_counts(docs, least_docs), "divergence-kept")
    groups = kept.groupBy("lang", "source").agg(F.sum("n").alias("group_total"), F.sum("leads").alias("leads"))
    langs = groups.groupBy("lang").agg(F.sum("leads").alias("v"), F.sum("group_total").alias("lang_total"))
    totals = landed(groups.drop("leads").join(langs, "lang"), "divergence-totals")
    size, whole = F.col("group_total") + F.col("v"), F.col("lang_total") + F.col("v")
    terms = kept.where(F.col("term") != "")

    shares = (terms.join(totals, ["lang", "source"])
              .select("lang", "term", "source", _share("n", size).alias("p"), _share(F.lit(0), size).alias("p0"),
                      _share("lang_n", whole).alias("q")))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _blocks(batches):
            group, first = _groups(table)
            yield _top_terms(table, group, top)
            yield _pair_sums(table, group, first)

    answer = "lang string, source string, part string, item string, value long"
    shards = landed(shares.repartition("lang", "term").sortWithinPartitions("lang", "term", "source").mapInArrow(compared, answer),
                    "divergence-shards")

    zero = totals.select("lang", "source", "v", F.when(F.col("v") > 0, _share(F.lit(0), F.greatest(size, F.lit(1)))).alias("p0"))
    other = zero.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    pairs = zero.join(other, "lang").where(F.col("source") != F.col("item"))
    none = _divergence(F.col("p0"), F.col("q0"))
    base = pairs.select("lang", "source", "item", F.coalesce(F.col("v") * none, F.lit(0)).alias("value"))
    counts = (shares.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("terms"))
              .join(other, "lang").where(F.col("source") != F.col("item")))
    ours = counts.select("lang", "source", "item", (F.col("terms") * (_divergence(F.col("p"), F.col("q0")) - none)).alias("value"))
    theirs = counts.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), (
        F.col("terms") * (_divergence(F.col("q0"), F.col("p")) - _divergence(F.col("q0"), F.col("p0")))).alias("value"))
    both = shards.where("part = 'pair'").select("lang", "source", "item", "value")
    summed = (base.unionByName(ours).unionByName(theirs).unionByName(both)
              .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))

    tops = ranked(shards.where("part = 'term'"), "term").where(F.col("rank") <= top)
    return ranked(summed, "pair").unionByName(tops)
