"""SimHash near-duplicates: fingerprints, pigeonhole block join, Hamming check, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.graph import by_weight, components, landed, small_batches

BITS = 64
VOTES = 1 << 16
#: Prints of one block key that are compared in one task; those of a key with more are cut into parts.
PART = 2048


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """Majority bits of the XXH64 hashes of the word shingles of a UTF-8 text; 0 without words."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(tokens) > words:
        starts, ends = starts[: 1 - words], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), VOTES):
        spans = zip(starts[at:at + VOTES].tolist(), ends[at:at + VOTES].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, seed: int = 42) -> DataFrame:
    """``(id, fp)`` of every row; fp as a signed long. A null text counts as empty and has fingerprint 0."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            prints = np.array([fingerprint(t.as_py() or b"", words, seed) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["id", "fp"])

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(hashed, "id long, fp long")


def block_masks(n_blocks: int, distance: int) -> list[int]:
    """The masks of all choices of ``n_blocks - distance`` blocks: prints within the distance agree under one at least."""
    cuts = [BITS * i // n_blocks for i in range(n_blocks + 1)]
    blocks = [((1 << hi) - (1 << lo)) for lo, hi in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(blocks, n_blocks - distance)]


def blocks_for(n_prints: int, distance: int) -> int:
    """The least number of blocks whose keys have as many bits as it takes to number the prints."""
    need = max(1, n_prints).bit_length()
    return next((b for b in range(distance + 1, BITS // 5 + 1) if BITS // b * (b - distance) >= need), BITS // 5)


def _forest(prints: np.ndarray, distance: int) -> np.ndarray:
    """For each print the least print that it reaches by steps within the distance; prints are distinct and ascending.

    A print is compared with those that no cluster has taken yet, so a dense group costs little more than its size.
    """
    root = np.empty_like(prints)
    rest = np.arange(len(prints))
    while len(rest):
        first, rest = rest[0], rest[1:]
        todo = [first]
        while todo and len(rest):
            root[todo] = prints[first]
            near = np.zeros(len(rest), bool)
            for i in todo:
                near |= np.bitwise_count(prints[rest] ^ prints[i]) <= distance
                if near.all():
                    break
            todo, rest = rest[near].tolist(), rest[~near]
        root[todo] = prints[first]
        root[first] = prints[first]
    return root


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows of sorted batches as (choice, key, low, high, fp) arrays that end where a key ends."""
    kept = [np.empty(0, np.int64)] * 5
    for batch in batches:
        now = [np.concatenate((k, batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64))) for i, k in enumerate(kept)]
        change = np.flatnonzero(np.any([np.diff(k) != 0 for k in now[:4]], axis=0)) + 1
        cut = change[-1] if len(change) else 0
        if cut:
            yield tuple(c[:cut] for c in now)
        kept = [c[cut:] for c in now]
    if len(kept[0]):
        yield tuple(kept)


def _dealt(prints: DataFrame, masks: list[int], part: int) -> DataFrame:
    """``(choice, key, low, high, fp)``: the prints under their block keys.

    The prints of a key with more than ``part`` are cut into parts, and each part goes to the task of every pair of parts
    that it is in: any two prints of a key meet, and no task has more than some ``2 * part`` of one key.
    """
    keyed = prints.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(m - (1 << BITS) if m >> (BITS - 1) else m)) for m in masks])).alias("choice", "key"))
    keyed = keyed.select(F.col("choice").cast("long"), "key", "fp")
    whole = F.lit(0).cast("long")
    keys = landed(keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).where(F.col("n") > part), "simhash-hot")
    if not keys.take(1):
        return keyed.select("choice", "key", whole.alias("low"), whole.alias("high"), "fp")
    marked = by_weight(keyed, keys.withColumn("parts", F.ceil(F.col("n") / part)), ["choice", "key"], "n", len(masks) * prints.count(), "left")
    mine = F.pmod(F.xxhash64("fp"), F.col("parts"))
    pairs = F.transform(F.sequence(whole, F.col("parts") - 1), lambda x: F.struct(F.least(mine, x).alias("low"), F.greatest(mine, x).alias("high")))
    alone = F.array(F.struct(whole.alias("low"), whole.alias("high")))
    pair = F.explode(F.when(F.col("parts").isNotNull(), pairs).otherwise(alone))
    return marked.select("choice", "key", pair.alias("pair"), "fp").select("choice", "key", "pair.low", "pair.high", "fp")


def near_edges(prints: DataFrame, distance: int = 4, n_blocks: int | None = None, part: int = PART) -> DataFrame:
    """``(a, b)``: a spanning forest of the links among the distinct ``prints(fp)`` within each block key, or each pair of the
    parts of a key that very many share.

    All links lie inside some key, so the components of these edges are those of all links, while no task emits
    more than one edge a row: never the pairs of a group.
    """
    masks = block_masks(n_blocks or blocks_for(prints.count(), distance), distance)

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for *keys, fp in _runs(batches):
            fp = fp.view(np.uint64)
            bound = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
            starts, ends = np.concatenate(([0], bound)), np.concatenate((bound, [len(fp)]))
            size = ends - starts
            two = starts[size == 2]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= distance]
            a, b = [fp[two + 1]], [fp[two]]
            for lo, hi in zip(starts[size > 2].tolist(), ends[size > 2].tolist()):
                group = np.sort(fp[lo:hi])
                root = _forest(group, distance)
                moved = root != group
                a.append(group[moved])
                b.append(root[moved])
            columns = [pa.array(np.concatenate(x).view(np.int64), pa.int64()) for x in (a, b)]
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    keys = ["choice", "key", "low", "high"]
    return _dealt(prints, masks, part).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(linked, "a long, b long")


def _grouped(prints: DataFrame, distance: int, n_blocks: int | None) -> DataFrame:
    """``prints(id, fp)`` with root, the least print of the component, and component_id, its least id."""
    first = landed(prints.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    roots = components(near_edges(first.select("fp"), distance, n_blocks))
    rooted = first.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "root", "component_id")
    return prints.join(of, "fp").select("id", "fp", "root", "component_id")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                   distance: int = 4, n_blocks: int | None = None) -> DataFrame:
    """``(id, fp, root, component_id)`` of every row of ``docs``.

    Rows link if their fingerprints differ in at most ``distance`` bits; component_id is the smallest id reachable,
    itself included (ids that are null do not count; null where a component has no other), root the component's least
    fingerprint. Texts without words, null ones among them, share fingerprint 0. Repeated rows give repeated results; an
    empty table gives none. The work is done on distinct fingerprints: copies, however many, are one.
    """
    prints = landed(fingerprints(docs, id_col, text_col, words), "simhash")
    return _grouped(prints, distance, n_blocks)


def keep_first(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """The documents (columns as they are) whose doc_id is the smallest of its group: one of each group.

    Of rows that share this doc_id, the one with the least fingerprint stays; of a group without any doc_id likewise.
    """
    groups = landed(simhash_groups(docs, words=words, distance=distance), "simhash-groups")
    losers = landed(groups.where(F.col("id") != F.col("component_id")).select(F.col("id").alias("doc_id")).distinct(), "losers")
    odd = landed(groups.groupBy("id").agg(F.count("*").alias("n")).where(F.col("id").isNull() | (F.col("n") > 1))
                 .select(F.col("id").alias("__id")), "odd-ids")
    if not odd.take(1):
        return docs.join(losers, "doc_id", "left_anti").select(docs.columns)
    named = docs.join(odd, docs["doc_id"].eqNullSafe(odd["__id"]), "left_anti").join(losers, "doc_id", "left_anti").select(docs.columns)
    rows = docs.join(odd, docs["doc_id"].eqNullSafe(odd["__id"]), "left_semi").withColumn(
        "__row", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), "text"))
    prints = fingerprints(rows, "__row", "text", words).distinct().select(F.col("id").alias("__row"), F.col("fp").alias("__fp"))
    chosen = (groups.where(F.col("id") == F.col("component_id")).groupBy("root").agg(F.min("id").alias("__id"), F.min("fp").alias("__fp"))
              .union(groups.where(F.col("component_id").isNull()).groupBy("root").agg(F.first("id"), F.min("fp"))))
    chosen = chosen.select("__id", F.col("__fp").alias("__chosen"))
    kept = rows.join(prints, "__row")
    kept = kept.join(chosen, (kept["__fp"] == chosen["__chosen"]) & kept["doc_id"].eqNullSafe(chosen["__id"]), "left_semi")
    return named.union(kept.dropDuplicates(["doc_id", "__fp"]).select(docs.columns))
