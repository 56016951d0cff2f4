"""LM scoring: context-tree weighting over bytes, beside an add-one unigram model of words.

Each byte is eight binary decisions; each decision has a tree of contexts, the bytes before. The Krichevsky-Trofimov
estimates of all depths are mixed by their weights in the tree (Willems, Shtarkov, Tjalkens, 1995), learned on the training
texts and then fixed. Texts are packed into blocks; each block sends its words and codes, dealt into buckets that grow in
number with the corpus, and gets back the corpus's values for just these, so no task holds the counts of the corpus. From
FAN buckets on they are dealt digit by digit: a block sends a row for each first digit, rows of as many blocks are merged and
dealt by the next digit, and values come back the same way, so the rows grow with the blocks and not with their square.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.graph import landed

DEPTH = 5
#: Texts of so many bytes make a block; as many bytes of the corpus make a bucket of words and codes.
BLOCK_BYTES = 16 << 20
#: Compression of texts, which are written and shuffled, and of words, which move up and down by each digit: their bytes are most of the disk.
TEXT_LEVEL = 5
WORD_LEVEL = 3
#: Rows that a block, or what a group of blocks was merged to, sends at most.
FAN = 256
CHUNK_BYTES = 1 << 18
GRAMS_AT_ONCE = 100_000
#: Pairs of bytes that more than one in so many of the corpus's different codes follow are hot.
HOT = 512
TEXTS, WORDS, GRAMS = range(3)
LOG2 = float(np.log(2))
LANDED = "block long, kind int, bucket long, data binary, counts binary"


def in_training(doc_id: int | None, modulus: int = 7, remainder: int = 2) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus != remainder


def _chunks(texts: list[bytes], depth: int) -> Iterator[list[tuple[int, bytes, bytes]]]:
    """The texts with their ends, as chunks of (text number, the ``depth`` bytes before, bytes); long texts are cut."""
    chunk, size = [], 0
    for i, text in enumerate(texts):
        whole = b"\0" * depth + text + b"\0"
        for at in range(depth, len(whole), CHUNK_BYTES):
            chunk.append((i, whole[at - depth:at], whole[at:at + CHUNK_BYTES]))
            size += len(chunk[-1][2])
            if size >= CHUNK_BYTES:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


def gram_codes(chunk: list[tuple[int, bytes, bytes]], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(codes, first): a code of each byte of a chunk and the ``depth`` bytes before it, and where each part begins."""
    data = np.frombuffer(b"".join(x for _, before, body in chunk for x in (before, body)), np.uint8).astype(np.int64)
    codes = np.zeros(max(0, len(data) - depth), np.int64)
    for j in range(depth + 1):
        codes = (codes << 8) | data[j:len(data) - depth + j]
    sizes = np.array([len(body) for _, _, body in chunk], np.int64)
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    scored = np.ones(len(codes), bool)
    gaps = (first + depth * np.arange(len(chunk)))[1:] - depth  # the next part's bytes before, in places of ``codes``
    scored[(gaps[:, None] + np.arange(depth)).ravel()] = False
    return codes[scored], first


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    codes, inverse = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
    return codes, np.bincount(inverse, np.concatenate([n for _, n in parts]), len(codes)).astype(np.int64)


def _count_grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    parts, size = [(np.empty(0, np.int64), np.empty(0, np.int64))], 0
    for chunk in _chunks(texts, depth):
        parts.append(np.unique(gram_codes(chunk, depth)[0], return_counts=True))
        size += len(parts[-1][0])
        if size > 200_000 + len(parts[0][0]) // 2:
            parts, size = [_summed(parts)], 0
    return _summed(parts)


def _packed(values: np.ndarray) -> bytes:
    """An array as compressed bytes, the first byte of every value before their second; ``_unpacked`` gives it back."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def _unpacked(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _packed_codes(codes: np.ndarray) -> bytes:
    """Ascending codes by their differences."""
    return _packed(np.diff(codes, prepend=0).astype("<i8"))


def _unpacked_codes(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data, "<i8"))


def _packed_words(words: list[bytes]) -> bytes:
    return zstandard.compress(b"\n".join(words), WORD_LEVEL)


def _unpacked_words(data: bytes) -> list[bytes]:
    return zstandard.decompress(data).split(b"\n")


def _code_bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of codes by their contexts: the 256 codes of a context at most are in one, and their differences are small."""
    return (((codes >> 8).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.int64) % buckets


class Radix(NamedTuple):
    """Buckets as numbers of so many digits, each below ``fan``, and the blocks that send to them."""

    fan: int
    digits: int
    blocks: int

    @property
    def buckets(self) -> int:
        return self.fan**self.digits

    def prefix(self, bucket, digits: int):
        """The first digits of buckets."""
        return bucket // self.fan ** (self.digits - digits)

    def groups(self, digits: int) -> int:
        """Groups of blocks whose rows are merged before they are dealt by the digit after so many."""
        return -(-self.blocks // self.fan**digits)


def radix(blocks: int) -> Radix:
    """As many buckets as blocks, or some more."""
    digits = 1
    while FAN**digits < blocks:
        digits += 1
    fan = max(1, math.ceil(round(blocks ** (1 / digits), 9)))
    return Radix(fan, digits, blocks)


def _row(block: int, kind: int, bucket: int, data: bytes, counts: bytes = b"") -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block]), pa.array([kind], pa.int32()), pa.array([bucket], pa.int64()), pa.array([data]), pa.array([counts])],
        ["block", "kind", "bucket", "data", "counts"])


def _dealt_words(words: Iterable[bytes], plan: Radix, digits: int) -> dict[int, list[bytes]]:
    """The first digits of buckets, with their words in order, in which they pack best."""
    dealt: dict[int, list[bytes]] = defaultdict(list)
    for w in words:
        dealt[plan.prefix(zlib.crc32(w) % plan.buckets, digits)].append(w)
    for own in dealt.values():
        own.sort()
    return dealt


def _dealt_codes(codes: np.ndarray, plan: Radix, digits: int) -> Iterator[tuple[int, np.ndarray]]:
    """The first digits of buckets, with the places of their codes in ascending order."""
    bucket = plan.prefix(_code_bucket(codes, plan.buckets), digits)
    order = np.argsort(bucket, kind="stable")
    some, lows = np.unique(bucket[order], return_index=True)
    for i, lo, hi in zip(some.tolist(), lows.tolist(), [*lows[1:].tolist(), len(codes)]):
        yield i, order[lo:hi]


def _blocks(docs: DataFrame, plan: Radix, depth: int, modulus: int, remainder: int) -> DataFrame:
    """Blocks of whole texts, packed; by their buckets' first digit, the words and codes in each and their counts in its
    training texts.

    A row holds a bucket's words, parted by line ends, or codes, and their counts, as arrays: Spark moves the arrays.
    """

    def flush(block: int, ids: list, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.binary())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=TEXT_LEVEL))) as writer:
            writer.write_table(table)
        yield _row(block, TEXTS, 0, sink.getvalue().to_pybytes())
        del table, sink
        sides: tuple[list[bytes], list[bytes]] = ([], [])
        for i, t in zip(ids, texts):
            sides[in_training(i, modulus, remainder)].append(t)
        words: Counter[bytes] = Counter()
        for t in sides[1]:
            words.update(t.split())
        for t in sides[0]:
            words.update(dict.fromkeys(t.split(), 0))
        for bucket, own in _dealt_words(words, plan, 1).items():
            yield _row(block, WORDS, bucket, _packed_words(own), _packed(np.fromiter(map(words.__getitem__, own), "<i8", len(own))))
        del words
        (seen, _), (codes, n) = (_count_grams(side, depth) for side in sides)
        new = np.setdiff1d(seen, codes, assume_unique=True)
        codes, n = np.concatenate((codes, new)), np.concatenate((n, np.zeros(len(new), np.int64)))
        order = np.argsort(codes)
        codes, n = codes[order], n[order]
        for bucket, at in _dealt_codes(codes, plan, 1):
            yield _row(block, GRAMS, bucket, _packed_codes(codes[at]), _packed(n[at].astype("<i8")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                ids.append(doc_id)
                texts.append((text.as_py() or b"").lower())
                size += len(texts[-1])
                if size >= BLOCK_BYTES:
                    yield from flush(block, ids, texts)
                    block, ids, texts, size = block + 1, [], [], 0
                    pa.default_memory_pool().release_unused()
        if ids:
            yield from flush(block, ids, texts)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, LANDED)


VALUED = "block long, kind int, data binary, vals binary, train_tokens long, train_words long"
VALUED_KINDS = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]


def _valued(rows: list[tuple]) -> pa.Table:
    names = [c.split()[0] for c in VALUED.split(", ")]
    return pa.table({n: pa.array(c, k) for n, k, c in zip(names, VALUED_KINDS, list(zip(*rows)) or [[]] * len(names))})


def _word_values(rows: pa.Table) -> pa.Table:
    """For each row of a bucket the corpus's counts of its words; the bucket's tokens and trained words on the first."""
    blocks, data = (rows.column(c).to_pylist() for c in ("block", "data"))
    total = _summed_words(rows)
    out = []
    for block, words in zip(blocks, data):
        own = _unpacked_words(words)
        out.append((block, WORDS, words, _packed(np.fromiter(map(total.__getitem__, own), "<i8", len(own))), 0, 0))
    if out:
        out[0] = (*out[0][:4], sum(total.values()), sum(map(bool, total.values())))
    return _valued(out)


def _code_counts(rows: pa.Table) -> pa.Table:
    codes, inverse = np.unique(np.concatenate([_unpacked_codes(d) for d in rows.column("data").to_pylist()]), return_inverse=True)
    n = np.bincount(inverse, np.concatenate([_unpacked(d, "<i8") for d in rows.column("counts").to_pylist()]), len(codes))
    return pa.table({"code": pa.array(codes), "n": pa.array(n.astype(np.int64))})


def _summed_words(rows: pa.Table) -> dict[bytes, int]:
    total: dict[bytes, int] = {}
    for words, n in zip(rows.column("data").to_pylist(), rows.column("counts").to_pylist()):
        for w, k in zip(_unpacked_words(words), _unpacked(n, "<i8").tolist()):
            total[w] = total.get(w, 0) + k
    return total


DEALT = "block long, bucket long, data binary, counts binary"


def _merged(kind: int, plan: Radix, digits: int):
    """The rows of a node, merged, and dealt by one digit more."""

    def run(rows: pa.Table) -> pa.Table:
        out: list[tuple] = []
        node = rows.column("node")[0].as_py() if rows.num_rows else None
        if kind == WORDS:
            total = _summed_words(rows)
            out = [(node, bucket, _packed_words(own), _packed(np.fromiter(map(total.__getitem__, own), "<i8", len(own))))
                   for bucket, own in _dealt_words(total, plan, digits).items()]
        else:
            counts = _code_counts(rows)
            codes, n = counts.column("code").to_numpy(), counts.column("n").to_numpy()
            out = [(node, bucket, _packed_codes(codes[at]), _packed(n[at].astype("<i8"))) for bucket, at in _dealt_codes(codes, plan, digits)]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        names = [c.split()[0] for c in DEALT.split(", ")]
        return pa.table({name: pa.array(c, k) for name, k, c in zip(names, kinds, list(zip(*out)) or [[]] * 4)})

    return run


def _returned(rows: pa.Table, known: pa.Table) -> pa.Table:
    """For each row of a node the values of its words or codes, out of those that came back to the node."""
    words, codes, values, kind = {}, [], [], WORDS
    for kind, data, vals in zip(*(known.column(c).to_pylist() for c in ("kind", "data", "vals"))):
        if kind == WORDS:
            words.update(zip(_unpacked_words(data), _unpacked(vals, "<i8").tolist()))
        else:
            codes.append(_unpacked_codes(data))
            values.append(_unpacked(vals, "<f4"))
    if codes:
        codes, values = np.concatenate(codes), np.concatenate(values)
        order = np.argsort(codes)
        codes, values = codes[order], values[order]
    out = []
    for block, data in zip(rows.column("block").to_pylist(), rows.column("data").to_pylist()):
        if kind == WORDS:
            own = _unpacked_words(data)
            vals = np.fromiter(map(words.__getitem__, own), "<i8", len(own))
        else:
            vals = values[np.searchsorted(codes, _unpacked_codes(data))]
        out.append((block, kind, data, _packed(vals), 0, 0))
    if out:
        out[0] = (*out[0][:4], *(sum(known.column(c).to_pylist()) for c in ("train_tokens", "train_words")))
    return _valued(out)


def _exchange(rows: DataFrame, kind: int, plan: Radix, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Values for the words or codes of ``rows(block, bucket, data, counts)``, dealt by the first digit of their buckets;
    ``finish`` gives them for rows dealt by all digits."""
    levels = []
    for digits in range(1, plan.digits):
        groups = plan.groups(digits)
        group = F.pmod(F.xxhash64("block"), F.lit(groups)) if digits == 1 else F.pmod(F.pmod(F.col("block"), F.lit(plan.groups(digits - 1))), F.lit(groups))
        placed = rows.withColumn("node", F.col("bucket") * F.lit(groups) + group)
        levels.append(placed)
        rows = landed(placed.groupBy("node").applyInArrow(_merged(kind, plan, digits + 1), DEALT), "merged")
    known = finish(rows)
    for placed in reversed(levels):
        back = known.withColumnRenamed("block", "of")
        known = placed.select("block", "data", "node").groupBy("node").cogroup(back.groupBy("of")).applyInArrow(_returned, VALUED)
    return known


def _code_values(rows: pa.Table, scores: pa.Table) -> pa.Table:
    """For each row of a bucket the values of its codes."""
    codes, values = scores.column("code").to_numpy(), scores.column("value").to_numpy()
    order = np.argsort(codes)
    codes, values = codes[order], values[order].astype("<f4")
    return _valued([
        (block, GRAMS, data, _packed(values[np.searchsorted(codes, _unpacked_codes(data))]), 0, 0)
        for block, data in zip(rows.column("block").to_pylist(), rows.column("data").to_pylist())])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for x > 0: eight steps of the recurrence, then Stirling's series."""
    down = sum(np.log(x + i) for i in range(8))
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - down


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with so many zeros and ones."""
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def _decision(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For the k-th binary decision on each code's last byte its node, 1 to 255, and the bit taken there."""
    symbol = codes & 255
    return (1 << k) | (symbol >> (8 - k)), (symbol >> (7 - k)) & 1


def _tree(codes: np.ndarray, n: np.ndarray, k: int, depth: int, top: int):
    """Nodes of depth ``depth`` to ``top`` for the k-th decision: by depth (keys, each code's place there, zeros, ones, ln KT, ln weighted)."""
    node, bit = _decision(codes, k)
    levels, below = {}, None
    for d in range(depth, top - 1, -1):
        context = (codes >> 8) & ((1 << 8 * d) - 1)
        keys, place = np.unique((context << 8) | node, return_inverse=True)
        ones = np.bincount(place, n * bit, len(keys))
        zeros = np.bincount(place, n, len(keys)) - ones
        kt = log_kt(zeros, ones)
        if below is None:
            weighted = kt
        else:
            above = (((below[0] >> 8) & ((1 << 8 * d) - 1)) << 8) | (below[0] & 255)
            children = np.bincount(np.searchsorted(keys, above), below[1], len(keys))
            weighted = np.logaddexp(kt, children) - LOG2
        below = (keys, weighted)
        levels[d] = (keys, place, zeros, ones, kt, weighted)
    return levels


def _by_context(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(codes, n, top) of batches sorted by the last two bytes of their context, and by the last three where these two are
    ``hot``; cut where they change. ``top`` is the depth from which on a part has whole trees: 2, of hot ones 3."""
    codes, n = np.empty(0, np.int64), np.empty(0, np.int64)

    def parts(codes: np.ndarray, n: np.ndarray, is_hot: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        for top, own in ((2, ~is_hot), (3, is_hot)):
            if own.any():
                yield codes[own], n[own], top

    def grouped(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pair = (codes >> 8) & 0xFFFF
        is_hot = np.isin(pair, hot)
        return is_hot, np.where(is_hot, (codes >> 8) & 0xFFFFFF, pair)

    for batch in batches:
        codes = np.concatenate((codes, batch.column("code").to_numpy()))
        n = np.concatenate((n, batch.column("n").to_numpy()))
        if len(codes) >= GRAMS_AT_ONCE:
            is_hot, group = grouped(codes)
            change = np.flatnonzero(np.diff(group)) + 1
            if len(change):
                cut = change[-1]
                yield from parts(codes[:cut], n[:cut], is_hot[:cut])
                codes, n = codes[cut:], n[cut:]
    if len(codes):
        yield from parts(codes, n, grouped(codes)[0])


def _placed(grams: DataFrame, depth: int) -> tuple[DataFrame, np.ndarray]:
    """``(code, n)`` dealt and sorted by the last two bytes of the context, and the pairs of bytes that are hot: those that more
    than one in HOT codes follow, fewer than HOT; their codes are dealt by the last three."""
    pairs = grams.withColumn("pair", F.shiftright("code", 8).bitwiseAND(F.lit(0xFFFF)))
    total = grams.count()
    hot = [r["pair"] for r in pairs.groupBy("pair").count().where(F.col("count") * HOT > total).collect()] if depth > 2 else []
    third = F.when(F.col("pair").isin(hot), F.shiftright("code", 24).bitwiseAND(F.lit(0xFF))).otherwise(0) if hot else F.lit(0)
    dealt = pairs.withColumn("third", third).repartition("pair", "third").sortWithinPartitions("pair", "third")
    return dealt.select("code", "n"), np.sort(np.array(hot, np.int64))


def _code_scores(grams: DataFrame, buckets: int, depth: int) -> DataFrame:
    """``(of, code, value)``: a code's bucket and the mixed log10 probability of each code's last byte after the bytes before.

    Contexts that share their last two bytes, or three after hot pairs, are weighted in one place; what is above them,
    65,536 nodes and 255 a hot pair at most whatever the corpus, is put together on the driver and sent to the tasks.
    """
    placed, hot = _placed(grams, depth)

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, n, top, k in ((*part, k) for part in _by_context(batches, hot) for k in range(8)):
            keys, _, zeros, ones, _, weighted = _tree(codes, n, k, depth, top)[top]
            upper, at = np.unique(keys & ((1 << 8 * top) - 1), return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(upper), top - 1)), pa.array(upper), *(pa.array(np.bincount(at, v, len(upper))) for v in (zeros, ones, weighted))],
                ["level", "key", "zeros", "ones", "below"])

    rows = (placed.mapInArrow(roots, "level long, key long, zeros double, ones double, below double").groupBy("level", "key")
            .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below")).orderBy("level", "key").toArrow())
    level, keys, *sums = (rows.column(c).to_numpy() for c in ("level", "key", "zeros", "ones", "below"))
    hot_keys, zeros2, ones2, below2 = (v[level == 2] for v in (keys, *sums))
    kt2 = log_kt(zeros2, ones2)
    weighted2 = np.logaddexp(kt2, below2) - LOG2
    zeros, ones, below = (np.zeros(1 << 16) for _ in range(3))
    for column, own, hot_own in zip((zeros, ones, below), sums, (zeros2, ones2, weighted2)):
        column[keys[level == 1]] = own[level == 1]
        np.add.at(column, hot_keys & 0xFFFF, hot_own)
    kt = log_kt(zeros, ones)
    weighted = np.logaddexp(kt, below) - LOG2
    zeros0, ones0, below0 = (v.reshape(256, 256).sum(axis=0) for v in (zeros, ones, weighted))
    kt0 = log_kt(zeros0, ones0)
    weighted0 = np.logaddexp(kt0, below0) - LOG2
    shared = grams.sparkSession.sparkContext.broadcast((
        (zeros0, ones0, np.exp(kt0 - LOG2 - weighted0)), (zeros, ones, np.exp(kt - LOG2 - weighted)),
        (zeros2, ones2, np.exp(kt2 - LOG2 - weighted2)), hot_keys))

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *upper, hot_keys = shared.value
        for codes, n, top in _by_context(batches, hot):
            total = np.zeros(len(codes))
            for k in range(8):
                levels = _tree(codes, n, k, depth, top)
                node, bit = _decision(codes, k)
                mixed = None
                for d in range(depth, -1, -1):
                    if d >= top:
                        _, place, zeros, ones, kt, weighted = levels[d]
                        stop = np.exp(kt - LOG2 - weighted)
                    else:
                        zeros, ones, stop = upper[d]
                        place = (((codes >> 8) & ((1 << 8 * d) - 1)) << 8) | node
                        if d == 2:
                            place = np.searchsorted(hot_keys, place)
                    own = (np.where(bit, ones[place], zeros[place]) + 0.5) / (zeros[place] + ones[place] + 1)
                    mixed = own if mixed is None else stop[place] * own + (1 - stop[place]) * mixed
                total += np.log10(mixed)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_code_bucket(codes, buckets)), pa.array(codes), pa.array(total)], ["of", "code", "value"])

    return placed.mapInArrow(scores, "of long, code long, value double")


SCORED = "doc_id long, held_out boolean, n_words long, n_known long, words double, score double, train_docs long, train_tokens long, train_words long"


def _score_block(modulus: int, remainder: int, depth: int):
    def run(packed: pa.Table, known: pa.Table) -> pa.Table:
        gains: dict[bytes, float] = {}
        codes, values = [], []
        for kind, data, vals in zip(*(known.column(c).to_pylist() for c in ("kind", "data", "vals"))):
            if kind == WORDS:
                gains.update(zip(_unpacked_words(data), np.log10(_unpacked(vals, "<i8") + 1.0).tolist()))
            else:
                codes.append(_unpacked_codes(data))
                values.append(_unpacked(vals, "<f4"))
        index, values = pd.Index(np.concatenate(codes)), np.concatenate(values).astype(np.float64)
        out = []
        for payload in packed.column("data").to_pylist():
            table = pa.ipc.open_stream(payload).read_all()
            ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
            scores = np.zeros(len(texts))
            for chunk in _chunks(texts, depth):
                at, starts = gram_codes(chunk, depth)
                np.add.at(scores, [i for i, _, _ in chunk], np.add.reduceat(values[index.get_indexer(at)], starts))
            for doc_id, text, score in zip(ids, texts, scores.tolist()):
                gain = np.array([gains[w] for w in text.split()])
                out.append((doc_id, not in_training(doc_id, modulus, remainder), len(gain), int(np.count_nonzero(gain)), float(gain.sum()), score, 0, 0, 0))
        held = sum(r[1] for r in out)
        out.append((None, None, None, None, None, None, len(out) - held,
                    sum(known.column("train_tokens").to_pylist()), sum(known.column("train_words").to_pylist())))
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in SCORED.split(", ")]
        return pa.table({name: pa.array(c, kind) for name, kind, c in zip(names, kinds, zip(*out))})

    return run


def score(docs: DataFrame, modulus: int = 7, remainder: int = 2, depth: int = DEPTH) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row of ``docs``.

    Training texts are those whose crc32(doc_id) leaves another remainder. ``base_score`` sums the add-one log10 frequencies
    of the words and of one end; ``score`` is the log10 probability of the lower-cased UTF-8 bytes and their end under the
    tree of contexts up to ``depth`` bytes (2 to 6). Null and empty texts have the end alone. Repeated rows repeat, and
    count as often in training; without training texts every bit has probability 1/2; an empty table gives no rows.
    """
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string"))).alias("bytes")).first()["bytes"] or 0
    plan = radix(1 + size // BLOCK_BYTES)
    blocks = landed(_blocks(docs, plan, depth, modulus, remainder), "blocks")
    of_words = blocks.where(F.col("kind") == WORDS).select("block", "bucket", "data", "counts")
    of_codes = blocks.where(F.col("kind") == GRAMS).select("block", "bucket", "data", "counts")

    def code_values(rows: DataFrame) -> DataFrame:
        grams = landed(rows.groupBy("bucket").applyInArrow(_code_counts, "code long, n long"), "grams")
        return rows.select("block", "bucket", "data").groupBy("bucket").cogroup(
            _code_scores(grams, plan.buckets, depth).groupBy("of")).applyInArrow(_code_values, VALUED)

    words = _exchange(of_words, WORDS, plan, lambda rows: rows.groupBy("bucket").applyInArrow(_word_values, VALUED))
    codes = _exchange(of_codes, GRAMS, plan, code_values)
    known = words.union(codes).withColumnRenamed("block", "of")
    packed = blocks.where(F.col("kind") == TEXTS).select("block", "data")
    rows = landed(packed.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(
        _score_block(modulus, remainder, depth), SCORED), "scores")
    sums = rows.agg(F.sum("train_docs").alias("docs"), F.sum("train_tokens").alias("tokens"), F.sum("train_words").alias("words")).first()
    ends = sums["docs"] or 0
    total, distinct = (sums["tokens"] or 0) + ends, (sums["words"] or 0) + (ends > 0)
    n_tokens = F.col("n_words") + 1
    return rows.where(F.col("n_words").isNotNull()).select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"), (F.col("n_known") + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("words") + F.lit(float(np.log10(ends + 1))) - n_tokens * F.lit(float(np.log10(total + distinct + 1)))).alias("base_score"),
        "score")
