"""Continuous risk updates on a published profile table.

A micro-batch writes only its history rows. The score in force for a patient is that of
the patient's last history row, or the published profile's without one, so the profile
table is rewritten only every ``publish_every`` micro-batches, not with each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import mean_of
from ..operators.profiles import admitted_recently, lookup
from ..operators.skew import top_n_per_key
from ..operators.updates import apply_risk_updates
from ..params import HIGH_RISK_SCORE, RECENT_ADMISSION_DAYS
from ..sources.sinks import current_version, follow_commits, publish_version, read_published
from .commits import commit, fold_commits, is_done, log_path, read_all, read_commits, stream_id
from .sinks import BUCKETS, batch_session, start


def _in_force(profiles: DataFrame, history: DataFrame | None) -> DataFrame:
    """Profiles with the score and time of their patients' last history rows."""
    if "risk_score_updated" not in profiles.columns:
        profiles = profiles.withColumn("risk_score_updated", F.lit(None).cast("timestamp_ntz"))
    if history is None:
        return profiles
    newest = [F.col(c).desc_nulls_last() for c in ("commit", "timestamp", "seq", "score")]
    last = top_n_per_key(history, ["patient_id"], newest, 1).select(
        "patient_id", F.col("score").alias("_score"), F.col("timestamp").alias("_at")
    )
    return (
        profiles.join(last, "patient_id", "left")
        .withColumn("risk_score", F.coalesce("_score", "risk_score"))
        .withColumn("risk_score_updated", F.coalesce("_at", "risk_score_updated"))
        .drop("_score", "_at")
    )


def start_risk_updates(
    updates: DataFrame,
    profiles_root: str,
    history_path: str,
    checkpoint: str,
    skip_unchanged: bool = False,
    publish_every: int = 100,
    every: str | None = None,
) -> StreamingQuery:
    """Apply risk updates to the published profiles, micro-batch by micro-batch.

    Each micro-batch is one commit of the history, found there when it is replayed. A
    stream with a new checkpoint adds its commits after those of the one before.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch_session(batch)
        if is_done(spark, history_path, batch_id):
            return
        follow_commits(spark, profiles_root, log_path(history_path))
        batch = batch.persist()  # it is used several times
        batch.count()  # from here on its size is known

        def changes(last: int) -> DataFrame:
            published = current_version(spark, profiles_root)[1]
            profiles = read_published(spark, profiles_root, batch)
            earlier = read_commits(spark, history_path, published, last)
            touched = lookup(profiles.select("patient_id", "risk_score"), batch)
            if earlier is not None:
                earlier = lookup(earlier, batch)
            return apply_risk_updates(
                _in_force(touched, earlier), batch, skip_unchanged, parts_path=f"{history_path}/_parts/{stream_id(spark)}").history

        try:
            made = commit(spark, history_path, batch_id, changes)
            published = current_version(spark, profiles_root)[1]
            if made is not None and made - published >= publish_every:
                applied = read_commits(spark, history_path, published, made)
                current = _in_force(read_published(spark, profiles_root), applied)
                publish_version(current, profiles_root, made, ("patient_id", BUCKETS), keep=2)
                fold_commits(spark, history_path, made)
                _overview_cube(spark, profiles_root)
        finally:
            batch.unpersist()

    return start(updates.writeStream.outputMode("append").foreachBatch(apply), checkpoint, every)


def read_live_profiles(spark: SparkSession, profiles_root: str, history_path: str) -> DataFrame:
    """The published profiles with all risk updates since applied."""
    published = current_version(spark, profiles_root)[1]
    return _in_force(read_published(spark, profiles_root), read_commits(spark, history_path, published))


def read_risk_history(spark: SparkSession, history_path: str) -> DataFrame:
    """All history rows that ``start_risk_updates`` has written."""
    return read_all(spark, history_path).drop("commit")


def _overview_cube(spark: SparkSession, profiles_root: str) -> DataFrame:
    """Additive counts of the published profiles by admission, made once for each version."""
    cube, version = f"{profiles_root}/_cube", current_version(spark, profiles_root)[0]
    if current_version(spark, cube)[1] != version:
        counts = read_published(spark, profiles_root).groupBy("admission_date").agg(
            F.count("*").alias("total"), F.count_if(F.col("risk_score") >= HIGH_RISK_SCORE).alias("high_risk"),
            F.sum("age").alias("age_sum"), F.count("age").alias("ages"))
        publish_version(counts, cube, version, keep=2)
    return read_published(spark, cube)


def read_live_overview(
    spark: SparkSession, profiles_root: str, history_path: str, as_of=None, days: int = RECENT_ADMISSION_DAYS
) -> DataFrame:
    """``overview`` of the live profiles, from counts of the published version and the updates since.

    An update takes its patient's earlier score out of the counts and puts the new one in; over a patient's updates these
    changes add up to the last one's. Neither a micro-batch nor this reader scans the profiles.
    """
    published = current_version(spark, profiles_root)[1]
    counts, history = _overview_cube(spark, profiles_root), read_commits(spark, history_path, published)
    changed = F.lit(0).cast("long")
    if history is not None:
        is_high = lambda score: F.coalesce((F.col(score) >= HIGH_RISK_SCORE).cast("long"), F.lit(0))
        changed = F.coalesce(history.select(F.sum(is_high("score") - is_high("previous_score"))).scalar(), F.lit(0))
    active = F.sum(F.when(admitted_recently(as_of, days), F.col("total")).otherwise(0))
    ages = counts.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"), F.sum("high_risk").alias("high"),
                      F.sum("age_sum").alias("age_sum"), F.sum("ages").alias("ages"), F.coalesce(active, F.lit(0)).alias("active"))
    return ages.select(
        "total", (F.coalesce("high", F.lit(0)) + changed).alias("high_risk"),
        F.coalesce(mean_of(F.col("age_sum"), F.col("ages"), 1), F.lit(0.0)).alias("avg_age"), "active")
