"""Per-key work that stays even when one key holds a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

# Up to this n, the map-side limit leaves n rows of a hot key per map task, which rounds over groups of tasks cut
# down; beyond it, a first round over slices of the key does.
ONE_ROUND_LIMIT = 32
SLICES = 4096
# Rows of a hot key that may meet in one task, map tasks whose rows meet in one round, and bytes that a map task reads.
MEETING_ROWS, FAN_IN, TASK_BYTES = 1_000_000, 1024, 128 << 20
# A table of fewer bytes than this is read by one task at ease.
SMALL_BYTES = 32 << 20
# The optimizer's size of what it does not know is larger.
UNKNOWN_BYTES = 1 << 52

NOT_SPLIT = -1


def top_n_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rn",
) -> DataFrame:
    """The first ``n`` rows of every key in ``order``, numbered from 1 in column ``rank``.

    Spark keeps only n rows per key in every map task before the shuffle, for n up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``. Where so many tasks would still bring more than MEETING_ROWS rows of
    one key together, groups of FAN_IN tasks are ranked first, then groups of groups, a tree of rounds. For a larger n, a
    first round ranks within (key, slice of the row hash), so that no task ever holds all rows of a hot key. The top n of
    the slices or groups contain the top n of the key.
    """
    if n > ONE_ROUND_LIMIT:
        sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*df.columns), F.lit(SLICES)))
        first = Window.partitionBy(*keys, "_slice").orderBy(*order)
        df = sliced.withColumn("_rn", F.row_number().over(first)).filter(F.col("_rn") <= n).drop("_rn", "_slice")
    else:
        tasks = _map_tasks(df) if not df.isStreaming else 1
        group = F.spark_partition_id()
        while n * tasks > MEETING_ROWS and tasks > FAN_IN:
            of_group = Window.partitionBy(*keys, "_group").orderBy(*order)
            grouped = df.withColumn("_group", F.floor(group / FAN_IN))
            df = grouped.withColumn("_rn", F.row_number().over(of_group)).filter(F.col("_rn") <= n).drop("_rn")
            tasks, group = -(-tasks // FAN_IN), F.col("_group")
        df = df.drop("_group")
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def expected_bytes(df: DataFrame) -> int:
    """The size of ``df`` as the optimizer expects it; UNKNOWN_BYTES or more if it knows none."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _map_tasks(df: DataFrame) -> int:
    """About how many tasks bring the rows of ``df``, by the size that the optimizer expects; 1 if it knows none, as of
    rows that are no table's, such as a micro-batch's."""
    size = expected_bytes(df)
    return size // TASK_BYTES + 1 if size < UNKNOWN_BYTES else 1


def with_parts(
    df: DataFrame, key: str, order: Sequence[str], parts: int | None = None, path: str | None = None, whole_below: int = 0
) -> DataFrame:
    """``df`` with ``part``: NOT_SPLIT for keys whose rows lie in one range, else the number of the row's range.

    The rows are cut into ranges of (key, order) of about equal size, as many as shuffle
    partitions or ``parts``, so a part is a range's rows at most, whatever a key's share,
    times or numbers; rows that are equal in all of ``order`` share a part. The ranges are
    written to ``path`` (default: a new scratch folder), as their bounds come from a sample
    and must not change. A key in several ranges is the last of all but one of them, so there
    are fewer such keys than ranges. Rows without key belong to nobody and stay in their ranges.

    Without ``parts``, a table that the optimizer expects to be smaller than ``whole_below`` bytes is one range: one task
    can hold any of its keys, and nothing is written.
    """
    spark = df.sparkSession
    if not parts and expected_bytes(df) < whole_below:
        return df.withColumn("part", F.when(F.col(key).isNotNull(), NOT_SPLIT).otherwise(0))
    path = path or scratch_path(spark, "parts")
    by = [key, *order]
    ranges = df.repartitionByRange(parts, *by) if parts else df.repartitionByRange(*by)
    ranges.withColumn("part", F.spark_partition_id()).write.mode("overwrite").parquet(path)
    laid = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType())])).parquet(path)
    split = (
        laid.groupBy(key).agg((F.min("part") < F.max("part")).alias("_split"))
        .filter(F.col("_split") & F.col(key).isNotNull())
    )
    whole = F.col(key).isNotNull() & F.col("_split").isNull()
    return laid.join(split, key, "left").withColumn("part", F.when(whole, NOT_SPLIT).otherwise(F.col("part"))).drop("_split")


def last_per_field(df: DataFrame, keys: list[str], field: Column, value: Column, order: list[str], names: list[str]) -> DataFrame:
    """One row per ``keys`` with a column for each of ``names``: the last non-null ``value``
    in ``order`` among the rows whose ``field`` is that name."""
    rows = df.select(*keys, field.alias("_field"), value.alias("_value"), *order)
    newest = [F.col("_value").isNull(), *[F.col(c).desc() for c in order]]
    last = top_n_per_key(rows, [*keys, "_field"], newest, 1)
    named = F.when(F.col("_field").isin(*names), F.struct("_field", "_value"))
    fields = last.groupBy(*keys).agg(F.map_from_entries(F.collect_list(named)).alias("_fields"))
    return fields.select(*keys, *[F.try_element_at("_fields", F.lit(n)).alias(n) for n in names])


def values_before_parts(
    parted: DataFrame, stored: DataFrame, key: str, field: Column, value: Column, order: list[str]
) -> DataFrame:
    """Per (key, part): the values in force when the part begins, a column per field.

    ``stored`` has a row per key and a column per field; its values hold for keys that
    are not split. For the later parts of hot keys the last non-null ``value`` of the
    earlier parts' rows holds, of those whose ``field`` names the column. Keys that are
    not stored have no row.
    """
    names = [c for c in stored.columns if c != key]
    earlier = Window.partitionBy(key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    hot = parted.filter((F.col("part") != NOT_SPLIT) & F.col(key).isNotNull())
    ends = last_per_field(hot, [key, "part"], field, value, order, names)
    carried = ends.select(key, "part", *[F.last(n, ignorenulls=True).over(earlier).alias(f"_{n}") for n in names])
    split = carried.join(stored, key).select(key, "part", *[F.coalesce(f"_{n}", n).alias(n) for n in names])
    return stored.select(key, F.lit(NOT_SPLIT).alias("part"), *names).unionByName(split)


def value_before_row(parted: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Add ``name``: the last non-null ``value`` before each row within its (keys, part)."""
    earlier = (
        Window.partitionBy(*keys, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return parted.withColumn(name, F.last(value, ignorenulls=True).over(earlier))
