"""Exact duplicates: a sharded cuckoo-filter index of live digests, with insertion and deletion.

A text's digest is the SHA-256 of its UTF-8 bytes after lower-casing A-Z. Shards of the index hold short prints of
their digests in a cuckoo filter; a print that is met is verified against the content record of its bucket's slot, the
whole digest, so a false hit never joins two texts. A filter that overflows is built anew, twice as large, from the
stored digests. Tasks reduce repeats before the shuffle, so a text that a third of all rows share reaches its shard as
a row a task.

Null texts count as empty. Of equal texts the row with the largest id stays; rows that repeat an id and its text
stay or go together. Null ids count in ``group_size`` but stay only where no row of the group has an id. An empty table
gives no rows. Other columns of the documents, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import scratch_path

SLOTS, MAX_KICKS, LOAD = 4, 200, 0.93
#: A filter with more slots than so many a digest is not made larger.
SPARSE = 16
#: Digests that a shard is sized for, the least number of shards, and digests that a task holds before it passes them on.
SHARD_KEYS, LEAST_SHARDS, TASK_KEYS = 1_000_000, 1024, 200_000
#: A group that holds more than one in so many rows is joined by broadcast: there are fewer such groups than this.
HEAVY = 2048
NO_ID = -(2**63)
DIGEST, FILTER, ARRIVED, CHANGED = range(4)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ROWS = "shard int, kind int, digest binary, keep long, size long, filter binary"


class Shard:
    """The live digests of one shard: a cuckoo filter of 16-bit prints whose slots point to content records.

    A record is a digest of four 64-bit words with the largest id and the number of rows that have it. Digests that find
    no slot though the filter is almost empty, as more share print and buckets than these have slots, go to a stash.
    """

    def __init__(self, buckets: int = 8) -> None:
        self.digests = np.empty((64, 4), np.uint64)
        self.keep, self.size = np.empty(64, np.int64), np.empty(64, np.int64)
        self.used = self.n_live = 0
        self.resized = 0
        self._clear(buckets)

    def _clear(self, buckets: int) -> None:
        self.prints = np.zeros((buckets, SLOTS), np.uint16)
        self.slots = np.full((buckets, SLOTS), -1, np.int32)
        self.stash: list[int] = []

    @staticmethod
    def places(digests: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Print, first and second bucket of each digest; either bucket follows from the other and the print."""
        prints = (digests[:, 0] & np.uint64(0xFFFF)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (digests[:, 1] & np.uint64(buckets - 1)).astype(np.int64)
        return prints, first, Shard._other(first, prints, buckets)

    @staticmethod
    def _other(bucket, prints, buckets: int):
        spread = (np.asarray(prints).astype(np.int64) * 0x5BD1E995) >> 7
        return bucket ^ (spread & (buckets - 1))

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The record of each digest, -1 if it is not live: prints met in its two buckets are verified in full."""
        prints, first, second = self.places(digests, len(self.prints))
        met = np.concatenate((self.prints[first], self.prints[second]), axis=1) == prints[:, None]
        row, at = np.nonzero(met)
        record = np.where(at < SLOTS, self.slots[first[row], at % SLOTS], self.slots[second[row], at % SLOTS])
        same = (self.digests[record] == digests[row]).all(axis=1)
        found = np.full(len(digests), -1, np.int64)
        found[row[same]] = record[same]
        for record in self.stash:
            found[(digests == self.digests[record]).all(axis=1)] = record
        return found

    def absorb(self, digests: np.ndarray, keep: np.ndarray, size: np.ndarray) -> None:
        """Count rows of digests; those that are not live yet are inserted."""
        found = self.find(digests)
        new = np.flatnonzero(found < 0)
        if len(new):
            whole = np.ascontiguousarray(digests[new]).view(np.dtype((np.void, 32))).ravel()
            _, first, which = np.unique(whole, return_index=True, return_inverse=True)
            found[new] = self._insert(digests[new][first])[which]
        np.maximum.at(self.keep, found, keep)
        np.add.at(self.size, found, size)

    def set(self, digests: np.ndarray, keep: np.ndarray, size: np.ndarray) -> None:
        """Give live digests other counts; those of size 0 are deleted."""
        found = self.find(digests)
        known = found >= 0
        self.keep[found[known]], self.size[found[known]] = keep[known], size[known]
        self._delete(digests[known & (size == 0)])

    def _insert(self, digests: np.ndarray) -> np.ndarray:
        need = self.used + len(digests)
        if need > len(self.digests):
            room = max(need, 2 * len(self.digests))
            self.digests = np.concatenate((self.digests[:self.used], np.empty((room - self.used, 4), np.uint64)))
            self.keep, self.size = (np.concatenate((a[:self.used], np.empty(room - self.used, np.int64))) for a in (self.keep, self.size))
        records = np.arange(self.used, need)
        self.digests[records], self.keep[records], self.size[records] = digests, NO_ID, 0
        self.used, self.n_live = need, self.n_live + len(digests)
        self._place(records)
        return records

    def _delete(self, digests: np.ndarray) -> None:
        records = self.find(digests)
        prints, first, second = self.places(digests, len(self.prints))
        for record, *buckets in zip(records.tolist(), first.tolist(), second.tolist()):
            for bucket in buckets:
                at = np.flatnonzero(self.slots[bucket] == record)
                if len(at):
                    self.prints[bucket, at[0]], self.slots[bucket, at[0]] = 0, -1
                    break
        self.size[records] = 0
        self.n_live -= len(records)
        waiting = [record for record in self.stash if self.size[record] > 0]
        self.stash = []
        self._place(np.array(waiting, np.int64))

    def live(self) -> np.ndarray:
        return np.flatnonzero(self.size[:self.used] > 0)

    def _place(self, records: np.ndarray) -> None:
        buckets = len(self.prints)
        while self.n_live > LOAD * SLOTS * buckets:
            buckets *= 2
        if buckets > len(self.prints):
            self._resize(buckets, records)
            return
        prints, first, second = self.places(self.digests[records], buckets)
        todo = np.arange(len(records))
        while len(todo):
            before = len(todo)
            for bucket in (first, second):
                _, one = np.unique(bucket[todo], return_index=True)  # one a bucket at a time
                now = todo[one]
                free = self.prints[bucket[now]] == 0
                fits = free.any(axis=1)
                now, at = now[fits], free[fits].argmax(axis=1)
                self.prints[bucket[now], at], self.slots[bucket[now], at] = prints[now], records[now]
                todo = np.delete(todo, one[fits])
            if len(todo) == before:
                break
        for i in todo.tolist():
            homeless = self._kick(int(records[i]), int(prints[i]), int(first[i]))
            if homeless is not None and self.n_live * SPARSE > SLOTS * buckets:
                self._resize(2 * buckets, records)
                return
            if homeless is not None:
                self.stash.append(homeless)

    def _kick(self, record: int, print_: int, bucket: int) -> int | None:
        """Put one record in a full bucket: its slot's print moves to its other bucket, and so on; the one left over at last."""
        for step in range(MAX_KICKS):
            free = np.flatnonzero(self.prints[bucket] == 0)
            at = int(free[0]) if len(free) else (record + step) % SLOTS
            print_, self.prints[bucket, at] = int(self.prints[bucket, at]), print_
            record, self.slots[bucket, at] = int(self.slots[bucket, at]), record
            if len(free):
                return None
            bucket = int(self._other(bucket, print_, len(self.prints)))
        return record

    def _resize(self, buckets: int, arriving: np.ndarray) -> None:
        """Build the filter anew from the stored digests; those that just arrive have no count yet."""
        self.resized += 1
        self._clear(buckets)
        self._place(np.union1d(self.live(), arriving))


@dataclass(frozen=True)
class Index:
    """One version of an index: its folder holds the shards' records and filters, and every member's id and digest."""

    path: str
    shards: int

    def _rows(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(ROWS).parquet(f"{self.path}/shards")

    def records(self, spark: SparkSession) -> DataFrame:
        """``(shard, digest, keep, size)`` of every live digest."""
        return self._rows(spark).where(F.col("kind") == DIGEST).select("shard", "digest", "keep", "size")

    def filters(self, spark: SparkSession) -> DataFrame:
        """``(shard, filter, keep)``: the prints of every shard, two bytes a slot, and how many digests its stash has."""
        return self._rows(spark).where(F.col("kind") == FILTER).select("shard", "filter", "keep")

    def members(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("doc_id long, digest binary, shard int").parquet(f"{self.path}/members")


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def digests(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, digest, shard)`` of every row."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.sha2(normalised(F.col(text_col)), 256).alias("hex"))
    shard = F.conv(F.substring("hex", 57, 8), 16, 10).cast("long") % shards
    return narrow.select("doc_id", F.unhex("hex").alias("digest"), shard.cast("int").alias("shard"))


def _words(column: pa.Array) -> np.ndarray:
    """Digests of 32 bytes as rows of four words."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, 4)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _reduced(members: DataFrame) -> DataFrame:
    """``(shard, digest, keep, size)``: a row for each digest that a task meets, or a few if it meets very many."""
    shards_of = pa.schema([("shard", pa.int32()), ("digest", pa.binary()), ("keep", pa.int64()), ("size", pa.int64())])

    def out(held: Shard, shard_of: dict[bytes, int]) -> pa.RecordBatch:
        live = held.live()
        keys = [held.digests[i].tobytes() for i in live]
        keep = held.keep[live]
        return pa.RecordBatch.from_arrays([
            pa.array([shard_of[k] for k in keys], pa.int32()), pa.array(keys, pa.binary()),
            pa.array(keep, pa.int64(), mask=keep == NO_ID), pa.array(held.size[live], pa.int64())], schema=shards_of)

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard_of = Shard(), {}
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("digest")
            shard_of.update(zip(keys.to_pylist(), batch.column("shard").to_pylist()))
            held.absorb(_words(keys), _ids(batch.column("doc_id")), np.ones(batch.num_rows, np.int64))
            if held.n_live >= TASK_KEYS:
                yield out(held, shard_of)
                held, shard_of = Shard(), {}
        if held.n_live:
            yield out(held, shard_of)

    return members.mapInArrow(reduced, "shard int, digest binary, keep long, size long")


def _merged(rows: DataFrame) -> DataFrame:
    """The new records and filters of all shards that ``rows`` (as ROWS) speak of."""

    def written(number: int, held: Shard) -> Iterator[pa.RecordBatch]:
        live = held.live()
        if not len(live):
            return
        n, keep = len(live), held.keep[live]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(n, number), pa.int32()), pa.array(np.full(n, DIGEST), pa.int32()),
            pa.array([held.digests[i].tobytes() for i in live], pa.binary()),
            pa.array(keep, pa.int64(), mask=keep == NO_ID), pa.array(held.size[live], pa.int64()), pa.nulls(n, pa.binary())],
            ["shard", "kind", "digest", "keep", "size", "filter"])
        yield pa.RecordBatch.from_arrays([
            pa.array([number], pa.int32()), pa.array([FILTER], pa.int32()), pa.nulls(1, pa.binary()), pa.array([len(held.stash)]),
            pa.array([n], pa.int64()), pa.array([held.prints.tobytes()], pa.binary())],
            ["shard", "kind", "digest", "keep", "size", "filter"])

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = None, Shard()
        for batch in batches:
            shard, kind = (batch.column(c).to_numpy() for c in ("shard", "kind"))
            cuts = np.flatnonzero(np.diff(shard) | np.diff(kind)) + 1
            for lo, hi in zip(np.concatenate(([0], cuts)).tolist(), np.concatenate((cuts, [len(shard)])).tolist()):
                if hi == lo:
                    continue
                if shard[lo] != number:
                    if number is not None:
                        yield from written(number, held)
                    number, held = int(shard[lo]), Shard()
                part = batch.slice(lo, hi - lo)
                change = held.set if kind[lo] == CHANGED else held.absorb
                change(_words(part.column("digest")), _ids(part.column("keep")), part.column("size").to_numpy())
        if number is not None:
            yield from written(number, held)

    return (rows.where(F.col("kind") != FILTER).repartition("shard").sortWithinPartitions("shard", "kind")
            .mapInArrow(merged, ROWS))


def _as(rows: DataFrame, kind: int) -> DataFrame:
    return rows.select("shard", F.lit(kind).alias("kind"), "digest", "keep", "size", F.lit(None).cast("binary").alias("filter"))


def insert(docs: DataFrame, index: Index | None = None, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """A new version of the index with the rows of ``docs``; without an index, the first version.

    The number of shards is fixed then, from the number of rows; filters grow within their shards.
    """
    spark = docs.sparkSession
    shards = index.shards if index else max(LEAST_SHARDS, docs.count() // SHARD_KEYS)
    path = scratch_path(spark, "digest-index")
    digests(docs, shards, id_col, text_col).write.parquet(f"{path}/members")
    new = Index(path, shards)
    rows = _as(_reduced(new.members(spark)), ARRIVED)
    if index:
        index.members(spark).write.mode("append").parquet(f"{path}/members")
        rows = rows.unionByName(_as(index.records(spark), DIGEST))
    _merged(rows).write.parquet(f"{path}/shards")
    return new


def delete(ids: DataFrame, index: Index, id_col: str = "doc_id") -> Index:
    """A new version of the index without the members whose ids are in ``ids``.

    A digest whose kept row goes passes to the largest id left, one without rows leaves its filter. Ids that are null or
    no member's change nothing.
    """
    spark = ids.sparkSession
    path = scratch_path(spark, "digest-index")
    new, gone = Index(path, index.shards), ids.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    members = index.members(spark)
    members.join(gone, "doc_id", "left_anti").select(members.columns).write.parquet(f"{path}/members")
    touched = members.join(gone, "doc_id", "left_semi").select("shard", "digest").distinct()
    left = new.members(spark).groupBy("digest").agg(F.max("doc_id").alias("keep"), F.count("*").alias("size"))
    changed = touched.join(left, "digest", "left").withColumn("size", F.coalesce("size", F.lit(0).cast("long")))
    _merged(_as(index.records(spark), DIGEST).unionByName(_as(changed, CHANGED))).write.parquet(f"{path}/shards")
    return new


def lookup(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(digest, keep, size)``: the live records of the digests that ``docs`` hold.

    Only digests whose print a shard's filter holds are looked up among the records, which verify them.
    """
    spark = docs.sparkSession
    probes = _reduced(digests(docs, index.shards, id_col, text_col)).select(
        "shard", F.lit(ARRIVED).alias("kind"), "digest", F.lit(None).cast("binary").alias("filter"), "keep")
    filters = index.filters(spark).select("shard", F.lit(FILTER).alias("kind"), F.lit(None).cast("binary").alias("digest"), "filter", "keep")

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, prints, stashed = None, None, 0
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            cuts = np.flatnonzero(np.diff(shard)) + 1
            hits = np.zeros(len(shard), bool)
            for lo, hi in zip(np.concatenate(([0], cuts)).tolist(), np.concatenate((cuts, [len(shard)])).tolist()):
                if hi > lo and batch.column("kind")[lo].as_py() == FILTER:
                    number = int(shard[lo])
                    prints = np.frombuffer(batch.column("filter")[lo].as_py(), np.uint16).reshape(-1, SLOTS)
                    stashed = batch.column("keep")[lo].as_py()
                    lo += 1
                if hi > lo and shard[lo] == number:
                    print_, first, second = Shard.places(_words(batch.column("digest").slice(lo, hi - lo)), len(prints))
                    hits[lo:hi] = ((prints[first] == print_[:, None]) | (prints[second] == print_[:, None])).any(axis=1) | (stashed > 0)
            yield pa.RecordBatch.from_arrays([batch.column("digest").filter(pa.array(hits))], ["digest"])

    met = (filters.unionByName(probes).repartition("shard").sortWithinPartitions("shard", "kind")
           .mapInArrow(probed, "digest binary").distinct())
    return index.records(spark).join(met, "digest").select("digest", "keep", "size")


def groups(index: Index, spark: SparkSession) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` of every member.

    Records of groups that hold more than a 2048th of all rows, fewer than 2048, are broadcast; the others are joined by
    digest, so no task of that join gets more than such a share for one key.
    """
    members, records = index.members(spark), index.records(spark).drop("shard")
    total = records.agg(F.sum("size")).first()[0] or 0
    heavy = records.where(F.col("size") * HEAVY > total)
    marked = members.drop("shard").join(F.broadcast(heavy), "digest", "left")
    light = marked.where(F.col("size").isNull()).select("doc_id", "digest").join(records.where(F.col("size") * HEAVY <= total), "digest")
    rows = marked.where(F.col("size").isNotNull()).unionByName(light)
    return rows.select(
        "doc_id", F.col("keep").alias("keep_id"), F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``groups`` of all rows of ``docs``, through a new index."""
    return groups(insert(docs, None, id_col, text_col), docs.sparkSession)
