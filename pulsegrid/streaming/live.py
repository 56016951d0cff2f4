"""Analyses of the live feed that are kept as tables: each micro-batch rewrites the keys that it touches.

A micro-batch is one commit of its table (see ``commits``), replayed ones change nothing, and late rows change their own
window, day or patient only. Readings without a time or patient are kept under their null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.profiles import lookup
from ..operators.readings import (
    ABNORMAL_COLUMNS,
    NEWEST_COLUMNS,
    cycle_counts,
    day_totals,
    enrich,
    latest_readings,
    newest_abnormal,
    over_days,
    windowed,
)
from ..sources.sinks import read_published
from .commits import commit, fold_commits, is_done, read_all
from .feeds import stream_alerts
from .risk import read_live_profiles
from .sinks import batch_session, commit_latest, latest_changes, start, write_batch

WINDOW, DAY, PATIENT = ["window_start"], ["day"], ["patient_id"]


def start_patients_monitored(
    readings: DataFrame, path: str, checkpoint: str, width: str = "1 hour", lg_k: int = 12, publish_every: int = 100, every: str | None = None
) -> StreamingQuery:
    """Keep a sketch of the patients of every tumbling window, of 2^lg_k registers at most.

    Sketches merge, so a window's row is its stored sketch with that of the micro-batch, and any span of windows can be
    counted when it is read. The relative standard error is about 1.04 / sqrt(2^lg_k), 1.6 % at 12; a count of up to some
    hundred patients is exact.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch_session(batch)
        fresh = (windowed(batch, width).groupBy("window_start")
                 .agg(F.hll_sketch_agg(F.col("patient_id").cast("string"), lg_k).alias("sketch")).persist())

        def changes(last: int) -> DataFrame:
            stored = latest_changes(spark, path, WINDOW, fresh, last)
            rows = fresh.withColumn("touched", F.lit(True))
            if stored is not None:
                rows = rows.unionByName(stored.withColumn("touched", F.lit(False)))
            merged = rows.groupBy("window_start").agg(F.hll_union_agg("sketch").alias("sketch"), F.bool_or("touched").alias("touched"))
            return merged.filter("touched").drop("touched")

        try:
            write_batch(spark, path, batch_id, changes, WINDOW, publish_every)
        finally:
            fresh.unpersist()

    return start(readings.writeStream.outputMode("append").foreachBatch(merge), checkpoint, every)


def read_patients_monitored(spark: SparkSession, path: str, since=None, until=None, whole: bool = False) -> DataFrame:
    """Patients per window, of windows that begin at ``since`` or later and before ``until``; ``whole``: of all of these together."""
    rows = latest_changes(spark, path, WINDOW)
    if since is not None:
        rows = rows.filter(F.col("window_start") >= since)
    if until is not None:
        rows = rows.filter(F.col("window_start") < until)
    if whole:
        return rows.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0).cast("long")).alias("patients"))
    return rows.select("window_start", F.hll_sketch_estimate("sketch").alias("patients"))


def start_running_totals(
    readings: DataFrame, path: str, checkpoint: str, width: str = "5 seconds", publish_every: int = 100, every: str | None = None
) -> StreamingQuery:
    """Keep counts per window, and their totals since the day began, in days: a window that changes rewrites its day only.

    ``read_running_totals`` adds the totals of the days before, one row a day.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch_session(batch)
        fresh = cycle_counts(batch, width).withColumn("day", F.to_date("window_start")).persist()
        days = fresh.select(F.col("day").alias("_day")).distinct()

        def changes(last: int) -> DataFrame:
            stored = latest_changes(spark, path, DAY, fresh, last)
            rows = fresh
            if stored is not None:
                touched = stored.join(days, F.col("day").eqNullSafe(F.col("_day")), "left_semi")
                rows = rows.unionByName(touched.select(rows.columns))
            counts = rows.groupBy("day", "window_start").agg(F.sum("events").alias("events"), F.sum("abnormal").alias("abnormal"))
            return day_totals(counts)

        try:
            write_batch(spark, path, batch_id, changes, DAY, publish_every)
        finally:
            fresh.unpersist()

    return start(readings.writeStream.outputMode("append").foreachBatch(merge), checkpoint, every)


def read_running_totals(spark: SparkSession, path: str) -> DataFrame:
    """The columns of ``running_totals``, of all readings so far."""
    return over_days(latest_changes(spark, path, DAY))


def start_abnormal_patients(
    readings: DataFrame, path: str, checkpoint: str, n: int = 5, publish_every: int = 100, every: str | None = None
) -> StreamingQuery:
    """Keep, for every patient, the newest ABNORMAL reading among the newest n, as long as there is one.

    ``path/newest`` holds the newest n readings, ``path/answers`` the answers. A commit of the answers has a patient only if
    the answer is another than before: the new reading, or a ``deleted`` row when newer normal readings have pushed the last
    abnormal one out. A micro-batch that dies between the two tables makes the answers when it is replayed.
    """
    newest_path, answers_path = f"{path}/newest", f"{path}/answers"

    def detect(batch: DataFrame, batch_id: int) -> None:
        spark = batch_session(batch)
        if is_done(spark, f"{answers_path}/changes", batch_id):
            return
        used = batch.select(*[c for c in NEWEST_COLUMNS if c in batch.columns])
        newest = latest_readings(used, n).drop("rn").persist()  # at most n rows a patient

        def changes(last: int) -> DataFrame:
            stored = latest_changes(spark, newest_path, PATIENT, newest)
            now = newest_abnormal(lookup(stored.drop("rn"), newest), n)
            before = latest_changes(spark, answers_path, PATIENT, newest, last)
            if before is None:
                return now.withColumn("deleted", F.lit(False))
            before = lookup(before, newest).select(now.columns)
            same = [F.col(f"now.{c}").eqNullSafe(F.col(f"before.{c}")) for c in now.columns]
            new = now.alias("now").join(before.alias("before"), same, "left_anti").withColumn("deleted", F.lit(False))
            gone = before.join(now, "patient_id", "left_anti").withColumn("deleted", F.lit(True))
            return new.unionByName(gone)

        try:
            commit_latest(spark, newest_path, batch_id, newest, n, publish_every)
            write_batch(spark, answers_path, batch_id, changes, PATIENT, publish_every)
        finally:
            newest.unpersist()

    return start(readings.writeStream.outputMode("append").foreachBatch(detect), checkpoint, every)


def read_abnormal_patients(spark: SparkSession, path: str, profiles: DataFrame) -> DataFrame:
    """The columns of ``abnormal_patients``, of all readings so far, with the profiles as given."""
    return enrich(latest_changes(spark, f"{path}/answers", PATIENT), profiles).select(*ABNORMAL_COLUMNS)


def start_alerts(
    readings: DataFrame,
    profiles_root: str,
    path: str,
    checkpoint: str,
    history_path: str | None = None,
    fold_every: int = 100,
    every: str | None = None,
) -> StreamingQuery:
    """Land alerts with the profiles in force: each micro-batch joins the version that is published by then.

    With ``history_path``, the risk updates since that version are in force, too. ``read_alerts`` reads the alerts.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch_session(batch)
        profiles = read_live_profiles(spark, profiles_root, history_path) if history_path else read_published(spark, profiles_root)
        made = commit(spark, path, batch_id, lambda last: stream_alerts(batch, profiles))
        if made is not None and (made + 1) % fold_every == 0:
            fold_commits(spark, path, made)

    return start(readings.writeStream.outputMode("append").foreachBatch(land), checkpoint, every)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """All alerts that ``start_alerts`` has landed."""
    return read_all(spark, path).drop("commit")
