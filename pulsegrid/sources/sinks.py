"""Writers, and tables as numbered versions (Parquet has no row-level update)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .log import NumberedLog

#: The column, and folder, of a row's bucket in a version that is laid out by a key.
BUCKET = "_bucket"
# Spark's default JSON formats cut timestamps to milliseconds.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


class ResultSet:
    """A set of results written together: readers get the last whole set, whatever becomes of a run.

    Each run writes to a folder of its own; ``publish`` names the folder in the set's log, the one step that readers see.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path, self._log = path.rstrip("/"), NumberedLog(spark, f"{path.rstrip('/')}/_sets")
        self.folder = f"{self.path}/set={uuid.uuid4().hex}"

    def publish(self, names: list[str], fmt: str, keep: int = 2) -> dict[str, str]:
        """Make this run's results the current ones; sets before the last ``keep`` are removed."""
        number = self._log.append({"folder": self.folder, "names": names, "format": fmt})
        for old in self._log.numbers():
            if old <= number - keep:
                entry = self._log.read(old)
                self._log.remove(old)
                if entry:
                    self._log.remove_folder(entry["folder"])
        return {name: f"{self.folder}/analysis={name}" for name in names}

    def current(self) -> dict:
        """``folder``, ``names`` and ``format`` of the last whole set; empty before the first."""
        return self._log.last()[1]


def write_result(df: DataFrame, path: str, name: str, fmt: str = "parquet") -> str:
    """Write one analysis to ``path/analysis=name`` with its field names and types."""
    target = f"{path.rstrip('/')}/analysis={name}"
    df.write.mode("overwrite").options(**(JSON_TIMES if fmt == "json" else {})).format(fmt).save(target)
    return target


def export_profiles(profiles: DataFrame, path: str) -> None:
    """Profiles as JSON Lines, without a document store's ``_id``."""
    profiles.drop("_id").write.mode("overwrite").options(**JSON_TIMES).json(path)


def replace_profiles(profiles: DataFrame, root: str) -> int:
    """Replace the whole profile table at ``root`` by a new version, which ``read_published`` gives once it is whole.

    The one before it stays for its readers; ``profiles`` may be read from it.
    """
    return publish_version(profiles, root, keep=2)


def with_event_date(readings: DataFrame) -> DataFrame:
    """``readings`` with the date of their time in the session's zone, as a folder for pruning."""
    return readings.withColumn("event_date", F.to_date("timestamp"))


def append_readings(readings: DataFrame, path: str) -> None:
    """Append readings, stamped with the load time, partitioned by event date.

    Nothing is looked up or replaced on write: ``dedup_readings`` lets the last load
    of a key win when the table is read.
    """
    stamped = with_event_date(readings.withColumn("ingested_at", F.current_timestamp()))
    # Files of even size per date, instead of one per task and date.
    stamped.hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").parquet(path)


def _versions(spark: SparkSession, root: str) -> NumberedLog:
    return NumberedLog(spark, f"{root.rstrip('/')}/_versions")


def follow_commits(spark: SparkSession, root: str, commits: str) -> None:
    """Note that the commits in the log at ``commits`` change the table published at ``root``."""
    NumberedLog(spark, f"{root.rstrip('/')}/_follows").add(1, {"commits": commits})


def _last_followed(spark: SparkSession, root: str) -> int:
    _, follows = NumberedLog(spark, f"{root.rstrip('/')}/_follows").last()
    numbers = NumberedLog(spark, follows["commits"]).numbers() if follows else []
    return numbers[-1] - 1 if numbers else -1


def current_version(spark: SparkSession, root: str) -> tuple[int, int]:
    """The newest published version and its own batch_id; (0, -1) when nothing is published."""
    version, entry = _versions(spark, root).last()
    return (version, entry["batch_id"]) if entry else (0, -1)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.hash(key), F.lit(buckets))


def in_buckets(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` with its ``BUCKET``, a task for each."""
    return df.withColumn(BUCKET, bucket_of(key, buckets)).repartitionById(buckets, BUCKET)


def publish_version(
    df: DataFrame, root: str, batch_id: int | None = None, bucket_by: tuple[str, int] | None = None, keep: int | None = None
) -> int:
    """Write a new version of the table at ``root``, then log it. Readers see it only once it is whole; what a writer
    leaves that dies in between is never read.

    ``batch_id`` is the last commit of a stream that the version contains: by default, of the commits that change this
    table (``follow_commits``) the last one so far, as a load replaces what they made. ``bucket_by`` (column, number) lays
    the rows out in that many folders, so that ``read_published`` can open some of them only; rows that have their ``BUCKET``
    lie in it already (``in_buckets``). With ``keep``, versions
    before the last so many are removed.
    """
    spark = df.sparkSession
    log = _versions(spark, root)
    if batch_id is None:
        batch_id = max(_last_followed(spark, root), current_version(spark, root)[1])
    folder = f"v={log.last()[0] + 1:08d}-{uuid.uuid4().hex[:8]}"
    path = f"{root.rstrip('/')}/{folder}"
    if bucket_by:
        key, buckets = bucket_by
        laid = df if BUCKET in df.columns else in_buckets(df, key, buckets)
        laid.write.partitionBy(BUCKET).parquet(path)
    else:
        df.write.parquet(path)
    version = log.append({"folder": folder, "batch_id": batch_id, "buckets": bucket_by and bucket_by[1]})
    if keep:
        for old in log.numbers():
            if old <= version - keep:
                entry = log.read(old)
                log.remove(old)
                if entry:
                    log.remove_folder(f"{root.rstrip('/')}/{entry['folder']}")
    return version


def read_published(spark: SparkSession, root: str, only: DataFrame | None = None, key: str = "patient_id") -> DataFrame:
    """The newest version; with ``only``, of a version in buckets just those that hold any of its keys."""
    _, entry = _versions(spark, root).last()
    if not entry:
        raise ValueError(f"nothing is published in {root}")
    df = spark.read.parquet(f"{root.rstrip('/')}/{entry['folder']}")
    if not entry["buckets"]:
        return df
    if only is not None:
        touched = only.select(bucket_of(key, entry["buckets"]).alias("b")).distinct().collect()
        df = df.filter(F.col(BUCKET).isin([r["b"] for r in touched]))
    return df.drop(BUCKET)
