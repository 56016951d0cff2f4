"""Readers. Schemas are explicit; JSON timestamps are ISO text."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameReader
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamReader

from ..functions.keys import key_patient_id
from ..schemas import LANDED_READING_SCHEMA, PROFILE_SCHEMA, READING_SCHEMA
from .sinks import ResultSet

CORRUPT = "_corrupt_record"


def _marked(reader: DataFrameReader | DataStreamReader, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    """Rows of ``path`` with the text of their line, where it does not fit ``schema``, in column CORRUPT."""
    marked = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    if fmt == "json":
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    rows = reader.schema(marked if fmt == "json" else schema).format(fmt).load(path)
    return rows if fmt == "json" else rows.withColumn(CORRUPT, F.lit(None).cast("string"))


def whole_rows(marked: DataFrame) -> DataFrame:
    """The rows of marked lines. A line that does not parse gives no row; one with a field that does not fit keeps its
    other fields."""
    return marked.filter(F.col(CORRUPT).isNull() | F.col("patient_id").isNotNull()).drop(CORRUPT)


def _parse_counts() -> list[Column]:
    """Counted as lines are parsed, by an ``Observation`` in batch and in a stream's progress under the name ``parse``."""
    return [F.count(F.lit(1)).alias("lines"), F.count(CORRUPT).alias("rejects")]


def _read(reader: DataFrameReader | DataStreamReader, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    return whole_rows(_marked(reader, path, schema, fmt)) if fmt == "json" else reader.schema(schema).format(fmt).load(path)


def land_lines(spark: SparkSession, path: str, target: str, schema: T.StructType = PROFILE_SCHEMA) -> dict[str, int]:
    """Parse the JSON lines of ``path`` once into a table at ``target``; how many ``lines`` and ``rejects`` it met.

    ``landed_rows`` reads the rows and ``landed_rejects`` the lines that do not fit, from a folder of their own.
    """
    seen = Observation("parse")
    marked = _marked(spark.read, path, schema, "json").observe(seen, *_parse_counts())
    marked.withColumn("rejected", F.col(CORRUPT).isNotNull()).write.mode("overwrite").partitionBy("rejected").parquet(target)
    return dict(seen.get)


def landed_rows(spark: SparkSession, target: str) -> DataFrame:
    return whole_rows(spark.read.parquet(target).drop("rejected"))


def landed_rejects(spark: SparkSession, target: str) -> DataFrame:
    """``(line)`` of every line that does not fit; the folder of the others is not opened."""
    return spark.read.parquet(target).filter("rejected = 'true'").select(F.col(CORRUPT).alias("line"))


def read_profiles(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Patient profiles; ``corrupt_lines`` returns the JSON lines that gave none, or not all of their fields."""
    return _read(spark.read, path, PROFILE_SCHEMA, fmt)


def read_readings(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """All monitoring readings in one scan."""
    return _read(spark.read, path, READING_SCHEMA, fmt)


def read_landed_readings(spark: SparkSession, path: str) -> DataFrame:
    """Readings landed by ``append_readings``, with their load time and date; ``streaming.read_ingested`` reads those of a stream.

    ``dedup_readings`` over them lets the last load of a key win.
    """
    return spark.read.schema(LANDED_READING_SCHEMA).parquet(path)


def corrupt_lines(spark: SparkSession, path: str, schema: T.StructType = PROFILE_SCHEMA) -> DataFrame:
    """The text of the JSON lines that do not fit ``schema``."""
    text = spark.read.text(path)
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = text.select(
        F.from_json("value", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("row")
    )
    return parsed.select(F.col(f"row.{CORRUPT}").alias("line")).filter(F.col("line").isNotNull())


def stream_readings(
    spark: SparkSession,
    path: str,
    max_files: int = 64,
    fmt: str = "json",
    schema: T.StructType | str = READING_SCHEMA,
    with_rejects: bool = False,
) -> DataFrame:
    """Live readings: files that arrive in ``path``, at most ``max_files`` per micro-batch.

    ``with_rejects`` keeps the lines that do not fit, in column CORRUPT, for a sink that lands them beside the rows
    (``start_ingest``), and observes their number: see ``parse_counts``.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    return _marked(reader, path, schema, fmt).observe("parse", *_parse_counts()) if with_rejects else _read(reader, path, schema, fmt)


def parse_counts(query: StreamingQuery) -> list[dict[str, int]]:
    """``lines`` and ``rejects`` of the last micro-batches of a query over ``stream_readings(…, with_rejects=True)``."""
    seen = [p["observedMetrics"].get("parse") for p in query.recentProgress]
    return [{"lines": row["lines"], "rejects": row["rejects"]} for row in seen if row is not None]


def _parsed_values(dump: DataFrame, schema: T.StructType) -> DataFrame:
    """``dump`` with ``row``, the value's fields, and ``fits``: whether it has any of them."""
    parsed = dump.select("key", "value", F.from_json("value", schema).alias("row"))
    return parsed.withColumn("fits", F.greatest(*[F.col(f"row.{name}").isNotNull() for name in schema.names], F.lit(False)))


def import_key_values(dump: DataFrame, schema: T.StructType = READING_SCHEMA) -> DataFrame:
    """Readings from a key-value dump ``(key, value)`` with JSON values.

    The patient of a value without ``patient_id`` is taken from the key. Values that
    have no field of the schema give no reading: ``rejected_key_values`` returns them.
    """
    patient = F.coalesce("row.patient_id", key_patient_id(F.col("key"))).alias("patient_id")
    others = [F.col(f"row.{name}") for name in schema.names if name != "patient_id"]
    return _parsed_values(dump, schema).filter("fits").select("key", patient, *others)


def rejected_key_values(dump: DataFrame, schema: T.StructType = READING_SCHEMA) -> DataFrame:
    """The entries ``(key, value)`` of a dump that ``import_key_values`` leaves out."""
    return _parsed_values(dump, schema).filter(~F.col("fits")).select("key", "value")


def land_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Land parsed JSON as Parquet, where nested column pruning and pushdown work."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def read_result(spark: SparkSession, path: str, fmt: str = "parquet", name: str | None = None) -> DataFrame:
    """A stored result, or one ``(status, message)`` row when there is none yet.

    With ``name``, that analysis of the last whole set below ``path``.
    """
    if name is not None:
        found = ResultSet(spark, path).current()
        if name not in found.get("names", ()):
            return _no_results(spark)
        path, fmt = f"{found['folder']}/analysis={name}", found["format"]
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return _no_results(spark)


def _no_results(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(
        F.lit("no_results").alias("status"),
        F.lit("nothing has been stored here").alias("message"),
    )
