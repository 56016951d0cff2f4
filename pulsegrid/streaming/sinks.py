"""Streaming sinks on Parquet. All are idempotent: a replayed micro-batch overwrites or skips itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from ..functions.keys import newest_first
from ..operators.readings import latest_readings
from ..sources.sinks import BUCKET, current_version, in_buckets, publish_version, read_published
from .commits import NEWEST, commit, forget_commits, read_commits

#: Folders that a published table is laid out in by its key, of which a micro-batch opens those of its own keys.
BUCKETS = 16
BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


def start(writer: DataStreamWriter, checkpoint: str, every: str | None) -> StreamingQuery:
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def append_stream(
    df: DataFrame, path: str, checkpoint: str, partition_by: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Append to a Parquet table. Without ``every`` the query ends when the input is used up."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return start(writer, checkpoint, every)


def write_changes(
    df: DataFrame,
    path: str,
    checkpoint: str,
    keys: list[str],
    mode: str = "update",
    publish_every: int = 100,
    every: str | None = None,
) -> StreamingQuery:
    """Write each micro-batch's changed rows as a commit below ``path/changes``. After
    ``publish_every`` commits the current rows of all ``keys`` are published as a
    version, so that ``latest_changes`` has only the changes since then to read.
    A stream with a new checkpoint goes on after the commits of the one before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.sparkSession, path, batch_id, lambda last: batch, keys, publish_every)

    return start(df.writeStream.outputMode(mode).foreachBatch(write), checkpoint, every)


def write_batch(
    spark: SparkSession,
    path: str,
    batch_id: int,
    changes: Callable[[int], DataFrame],
    keys: list[str],
    publish_every: int,
    newest: int | None = None,
) -> None:
    """One micro-batch of ``write_changes``: ``changes(last)`` on top of commit ``last``, or with ``newest`` beside it.

    Commits that the version before the new one contains are removed, so readers have the time of ``publish_every``
    micro-batches to finish.
    """
    made = commit(spark, f"{path}/changes", batch_id, changes, newest)
    published = current_version(spark, path)[1]
    if made is not None and made - published >= publish_every:
        publish_version(latest_changes(spark, path, keys, buckets=BUCKETS), path, made, (keys[0], BUCKETS), keep=2)
        forget_commits(spark, f"{path}/changes", published)


def latest_changes(
    spark: SparkSession,
    path: str,
    keys: list[str],
    only: DataFrame | None = None,
    until: int | None = None,
    buckets: int | None = None,
) -> DataFrame | None:
    """The rows of every key from the last commit that changed it; None before the first one. Of readings that commits
    add (``commit_latest``), the newest of each key.

    A key whose last rows are ``deleted``, if the table has that column, has none. With ``only``, the rows of at least the
    keys in it, and no more of the published version is opened than the buckets that hold them. ``until`` is the last
    commit that counts. With ``buckets`` the rows meet in that many buckets of the first key, ``BUCKET``, as a version
    is laid out, so that publishing them shuffles them once.
    """
    version, published = current_version(spark, path)
    rows = read_commits(spark, f"{path}/changes", published, until)
    if version:
        base = read_published(spark, path, only, keys[0]).withColumn("commit", F.lit(published))
        rows = base if rows is None else rows.unionByName(base, allowMissingColumns=True)
    if rows is None:
        return None
    if buckets:
        rows, keys = in_buckets(rows, keys[0], buckets), [BUCKET, *keys]
    if NEWEST in rows.columns:
        return _newest_rows(rows, keys)
    newest = Window.partitionBy(*keys).orderBy(F.col("commit").desc())
    rows = rows.withColumn("_r", F.rank().over(newest)).filter("_r = 1").drop("_r", "commit")
    return rows.filter("deleted IS NOT TRUE").drop("deleted") if "deleted" in rows.columns else rows


def _newest_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The newest readings of every key, as many as its last commit asks for, of the last rows that were written whole and
    of all that were added since. Nothing is added to readings without key: the last commit's stay."""
    readings = rows.drop("commit", NEWEST, "rn").columns
    newest = Window.partitionBy(*keys).orderBy(*newest_first(rows.select(readings).drop(BUCKET)))
    of_key = newest.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # in the same order: sorted once
    added = F.col(NEWEST).isNotNull()
    nobody = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    since = F.max(F.when(nobody | ~added, F.col("commit"))).over(of_key)
    last = F.max(F.when(added, F.struct("commit", NEWEST))).over(of_key)[NEWEST]
    kept = rows.withColumns({"_since": since, "_last": last}).filter("_since IS NULL OR commit >= _since")
    ranked = kept.withColumn("rn", F.row_number().over(newest)).filter("_last IS NULL OR rn <= _last")
    return ranked.select(*readings, "rn")


def commit_latest(spark: SparkSession, path: str, batch_id: int, newest: DataFrame, n: int, publish_every: int) -> None:
    """Commit the newest n readings of a micro-batch's patients. They are merged with those before when the table is read
    or published, so a micro-batch costs by its own rows and not by the table's."""
    write_batch(spark, path, batch_id, lambda last: newest, ["patient_id"], publish_every, newest=n)


def batch_session(batch: DataFrame) -> SparkSession:
    """The micro-batch's session, with adaptive execution: what is joined and sorted there is batch work.

    A table is broadcast only if its rows, once read, are small; its files may be a small part of that.
    """
    spark = batch.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    largest = spark.conf.get(BROADCAST)
    if largest != "-1":
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", largest)
        spark.conf.set(BROADCAST, "-1")
    return spark


def start_latest_n(
    readings: DataFrame, path: str, checkpoint: str, n: int = 20, publish_every: int = 100, every: str | None = None
) -> StreamingQuery:
    """Keep the newest n readings of every patient as a table; ``latest_changes(spark, path, ["patient_id"])`` reads it.

    Each micro-batch is cut to its own newest n per patient by the batch operator, and these are its commit. Every
    ``publish_every`` micro-batches they are merged with the published ones.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch_session(batch)
        commit_latest(spark, path, batch_id, latest_readings(batch, n).drop("rn"), n, publish_every)

    return start(readings.writeStream.outputMode("append").foreachBatch(add), checkpoint, every)


def batch_durations(query: StreamingQuery) -> list[dict]:
    """Batch id, rows and milliseconds of the query's last micro-batches: the ingest latency."""
    return [
        {"batch_id": p["batchId"], "rows": p["numInputRows"], "ms": p["durationMs"].get("triggerExecution", 0)}
        for p in query.recentProgress
    ]
