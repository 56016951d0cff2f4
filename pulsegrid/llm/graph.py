"""Connected components over written tables, for the near-duplicate operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.session import scratch_path


def landed(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: its lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _digest(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_003).alias("h")).first()
    return row["n"], row["h"] or 0


#: A key that holds more than one in so many rows is heavy: there are fewer such keys than this.
HEAVY = 2048


def by_weight(rows: DataFrame, keyed: DataFrame, keys: list[str], weight: str, total: int, how: str = "inner") -> DataFrame:
    """Inner or left join of ``rows`` with ``keyed``, which has one row for each of the ``keys`` and the number of its rows in
    column ``weight``; ``total`` is the number of all rows.

    Heavy keys, fewer than HEAVY, are broadcast, so their rows stay where they are; a key of the shuffled rest has a
    share of 1 / HEAVY at most, if keys that are not in ``keyed`` have no more.
    """
    heavy = F.col(weight) * HEAVY > total
    marked = rows.join(F.broadcast(keyed.where(heavy).withColumn("__heavy", F.lit(True))), keys, "left")
    light = marked.where(F.col("__heavy").isNull()).select(rows.columns).join(keyed.where(~heavy), keys, how)
    return marked.where(F.col("__heavy").isNotNull()).drop("__heavy").unionByName(light)


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of the undirected ``edges(a, b)``; root is the component's smallest node.

    Large-star and small-star rounds: every node sends its larger, then its smaller neighbours to the smallest
    node it sees, until all edges point at the roots. Minima are pre-aggregated, and the minima of hubs are broadcast to their
    edges (``by_weight``), so a hub of any degree is no hot group; each round is a written table. Edges with a null end or both ends equal say nothing; no edges,
    no rows.
    """
    links = landed(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _digest(links)
    while seen[0]:
        both = links.union(links.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n")).withColumn("low", F.least("a", "low"))
        large = (by_weight(both, low, ["a"], "n", 2 * seen[0]).where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        large = landed(large, "large-star")
        low = large.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
        small = by_weight(large, low, ["a"], "n", large.count())
        links = landed(
            small.where(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
            .union(small.select("a", F.col("low").alias("b"))).distinct(), "small-star")
        now = _digest(links)
        if now == seen:
            break
        seen = now
    return (links.select(F.col("a").alias("node"), F.col("b").alias("root"))
            .union(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct())


#: Rows of whole texts that are sent to a Python worker at a time.
TEXTS_A_BATCH = 512


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches have TEXTS_A_BATCH rows at most, a setting of the session, so that JVM and worker hold few whole
    texts at a time; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > TEXTS_A_BATCH:
        spark.conf.set(name, str(TEXTS_A_BATCH))


def slices(batches: Iterator[pa.RecordBatch], rows: int = TEXTS_A_BATCH) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so many rows, so that a task holds few texts as Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
