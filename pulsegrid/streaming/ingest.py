"""Live readings as a table that stays readable: commits of micro-batches, compacted by date.

The table is what its newest layout says: for every date a folder of compacted files, and the commits since. A reader has
one layout or the next, never both, and what a new layout replaces stays until the one after it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.readings import dedup_readings
from ..sources.files import CORRUPT, whole_rows
from ..sources.log import NumberedLog
from ..sources.sinks import with_event_date
from .commits import commit, forget_commits, last_commit, read_commits
from .sinks import batch_session, start

#: Rows of a compacted file, some 128 MB.
FILE_ROWS = 4_000_000
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def start_ingest(readings: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Land readings with their micro-batch time and date: no state and no shuffle.

    Of a stream ``with_rejects``, the lines that do not fit are landed from the same read: ``read_rejected`` gives them.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch_session(batch)
        marked = CORRUPT in batch.columns
        batch = batch.withColumn("ingested_at", F.current_timestamp())
        if marked:
            batch = batch.persist()
        try:
            commit(spark, path, batch_id, lambda last: with_event_date(whole_rows(batch) if marked else batch))
            if marked:
                lines = batch.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), "ingested_at")
                commit(spark, f"{path}/rejected", batch_id, lambda last: lines)
        finally:
            if marked:
                batch.unpersist()

    return start(readings.writeStream.outputMode("append").foreachBatch(land), checkpoint, every)


def _layouts(spark: SparkSession, path: str) -> NumberedLog:
    return NumberedLog(spark, f"{path}/_layouts")


def _read_dates(spark: SparkSession, path: str, layout: dict, dates: list[str]) -> DataFrame | None:
    folders = [f"{path}/{layout['dates'][d]}" for d in dates]
    if not folders:
        return None
    schema = T.StructType.fromJson(layout["schema"])
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).drop("compact")


def read_ingested(spark: SparkSession, path: str, since=None, until=None) -> DataFrame | None:
    """The readings landed so far, with ``ingested_at`` and ``event_date``; None before the first.

    With ``since`` or ``until`` (dates), only folders of these dates are opened. ``dedup_readings`` lets the last write of
    a key win, also of one that was not compacted yet.
    """
    _, layout = _layouts(spark, path).last()
    within = [d for d in layout.get("dates", {}) if (since is None or d >= str(since)) and (until is None or d <= str(until))]
    if since is not None or until is not None:
        within = [d for d in within if d != NO_DATE]
    tail = read_commits(spark, path, layout.get("until", -1))
    if tail is not None:
        tail = tail.drop("commit")
        for bound, keep in ((since, F.col("event_date") >= F.lit(since)), (until, F.col("event_date") <= F.lit(until))):
            tail = tail if bound is None else tail.filter(keep)
    compacted = _read_dates(spark, path, layout, within) if layout else None
    if compacted is None or tail is None:
        return tail if compacted is None else compacted
    return compacted.unionByName(tail.select(compacted.columns))


def compact_ingested(spark: SparkSession, path: str, unit: str = "second") -> int:
    """Merge the commits so far into the dates that they have rows of; the number of dates rewritten.

    Of a key ``<patient_id>_<epoch unit>`` the last write is kept, as by ``dedup_readings``. A date has at most a file for
    every FILE_ROWS rows and one more; a date with many rows is written by many tasks. The list of dates is the only thing
    that the driver holds. Of two compactions at once, one takes effect.
    """
    log = _layouts(spark, path)
    number, layout = log.last()
    until, before = last_commit(spark, path), layout.get("until", -1)
    fresh = read_commits(spark, path, before, until)
    if fresh is None:
        return 0
    fresh = fresh.drop("commit")
    counts = fresh.groupBy(F.col("event_date").cast("string").alias("d")).count().collect()
    touched = {r["d"] or NO_DATE: r["count"] for r in counts}
    stored = _read_dates(spark, path, layout, [d for d in touched if d in layout.get("dates", {})]) if layout else None
    rows = fresh if stored is None else stored.unionByName(fresh.select(stored.columns))
    sizes = {d: n + layout.get("rows", {}).get(d, 0) for d, n in touched.items()}
    large = {d: -(-n // FILE_ROWS) for d, n in sizes.items() if n > FILE_ROWS}
    date = F.coalesce(F.col("event_date").cast("string"), F.lit(NO_DATE))
    files = F.lit(1)
    for d, n in large.items():
        files = F.when(date == d, n).otherwise(files)
    kept = dedup_readings(rows, unit).drop("key")
    name = f"compact={uuid.uuid4().hex}"
    kept.withColumn("_file", F.pmod(F.xxhash64("patient_id", "timestamp"), files)).repartition("event_date", "_file").drop(
        "_file").write.partitionBy("event_date").parquet(f"{path}/{name}")
    fields = [f for f in kept.schema.fields if f.name != "event_date"] + [T.StructField("event_date", T.DateType())]
    replaced = [layout["dates"][d] for d in touched if d in layout.get("dates", {})]
    entry = {
        "until": until, "schema": T.StructType(fields).jsonValue(), "replaced": replaced, "rows": {**layout.get("rows", {}), **sizes},
        "dates": {**layout.get("dates", {}), **{d: f"{name}/event_date={d}" for d in touched}}}
    if not log.add(number + 1, entry):
        log.remove_folder(f"{path}/{name}")
        return 0
    for folder in layout.get("replaced", []):
        log.remove_folder(f"{path}/{folder}")
    for old in log.numbers()[:-2]:
        log.remove(old)
    forget_commits(spark, path, before)
    return len(touched)


def read_rejected(spark: SparkSession, path: str) -> DataFrame | None:
    """The lines that ``start_ingest`` found not to fit, with their micro-batch time; None before the first."""
    lines = read_commits(spark, f"{path}/rejected", -1)
    return None if lines is None else lines.drop("commit")
