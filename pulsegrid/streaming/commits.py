"""The order in which streams changed a table: one numbered commit a micro-batch, whatever its checkpoint.

Micro-batch numbers begin anew with each checkpoint, so a table's data lie under commit numbers that go on over streams.
A commit is in force when its entry is in the log. Entries are claimed one after the other, so of two streams that change
a table at the same time one makes the commit, and the other makes its own on top of it. An entry says which micro-batch
each stream committed last, so one look at the newest entry tells a replayed micro-batch.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.log import NumberedLog

NEWEST = "_newest"


def log_path(path: str) -> str:
    return f"{path}/_commits"


def _log(spark: SparkSession, path: str) -> NumberedLog:
    return NumberedLog(spark, log_path(path))


def last_commit(spark: SparkSession, path: str) -> int:
    """The number of the last commit; -1 before the first one."""
    numbers = _log(spark, path).numbers()
    return numbers[-1] - 1 if numbers else -1


def commit_path(path: str, commit: int, stream: str) -> str:
    return f"{path}/commit={commit}/stream={stream}"


def is_done(spark: SparkSession, path: str, batch_id: int) -> bool:
    """Whether an earlier try of the running query's micro-batch is a commit of the table."""
    streams = _log(spark, path).last()[1].get("streams", {})
    return streams.get(stream_id(spark), -1) >= batch_id


def commit(
    spark: SparkSession, path: str, batch_id: int, changes: Callable[[int], DataFrame], newest: int | None = None
) -> int | None:
    """Make ``changes(last)`` the next commit, where ``last`` is the commit that they build on; its number.

    With ``newest`` the rows of a key add to those of the commits before, and the newest so many of all are in force.

    If another stream commits first, the changes are made again on top of that. None, and nothing is done, if the
    micro-batch is a commit already. A try that ends before its log entry leaves data that no reader opens.
    """
    log, stream = _log(spark, path), stream_id(spark)
    while True:
        number, entry = log.last()
        streams = entry.get("streams", {})
        if streams.get(stream, -1) >= batch_id:
            return None
        folder = commit_path(path, number, stream)
        changes(number - 1).write.mode("overwrite").parquet(folder)
        added = {"newest": newest} if newest else {}
        if log.add(number + 1, {"stream": stream, "streams": {**streams, stream: batch_id}, **added}):
            return number
        log.remove_folder(folder)


def stream_id(spark: SparkSession) -> str:
    """The running query's id, which Spark keeps in its checkpoint."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def read_commits(spark: SparkSession, path: str, after: int, until: int | None = None) -> DataFrame | None:
    """The rows of the commits after ``after`` up to ``until`` (default: the last), with their ``commit``; None without any.

    Only the log entries and folders of these commits are opened. If any adds to the rows before, ``NEWEST`` is how many
    rows of a key it leaves in force, null in the others.
    """
    log = _log(spark, path)
    wanted = [n for n in log.numbers() if n - 1 > after and (until is None or n - 1 <= until)]
    entries = [(n - 1, log.read(n)) for n in wanted]
    folders = [commit_path(path, n, entry["stream"]) for n, entry in entries if entry]
    if not folders:
        return None
    rows = spark.read.option("basePath", path).parquet(*folders).drop("stream")
    adding = defaultdict(list)
    for number, entry in entries:
        if entry and "newest" in entry:
            adding[entry["newest"]].append(number)
    if not adding:
        return rows
    return rows.withColumn(NEWEST, F.coalesce(*[F.when(F.col("commit").isin(of), n) for n, of in adding.items()]))


def forget_commits(spark: SparkSession, path: str, until: int) -> None:
    """Remove the entries and rows of the commits up to ``until``, which a published version or fold contains.

    The newest entry always stays: it is what tells replayed micro-batches.
    """
    log = _log(spark, path)
    for number in log.numbers()[:-1]:
        if number - 1 <= until:
            log.remove(number)
            log.remove_folder(f"{path}/commit={number - 1}")


def fold_commits(spark: SparkSession, path: str, until: int) -> None:
    """Copy the rows of the commits since the last fold up to ``until`` to one folder, so that reading all rows opens a
    folder for each fold and not for each commit; then forget the commits of the fold before."""
    folds = NumberedLog(spark, f"{path}/_folds")
    number, fold = folds.last()
    after = fold.get("until", -1)
    rows = read_commits(spark, path, after, until)
    if rows is None or until <= after:
        return
    folder = f"{path}/fold={until}"
    rows.write.mode("overwrite").parquet(folder)
    if folds.add(number + 1, {"until": until}):
        forget_commits(spark, path, after)


def read_all(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows ever committed to a table whose commits are folded, with their ``commit``."""
    folds = NumberedLog(spark, f"{path}/_folds")
    entries = [entry["until"] for entry in map(folds.read, folds.numbers()) if entry]
    tail = read_commits(spark, path, max(entries, default=-1))
    if not entries:
        return tail
    folded = spark.read.parquet(*[f"{path}/fold={until}" for until in entries])
    return folded if tail is None else folded.unionByName(tail)
