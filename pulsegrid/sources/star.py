"""Profiles, readings, risk updates and patches derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the order price above which an order's priority counts as a condition.
CONDITION_PRICE = 430000
# Fixed value: the condition text that plays the "None" sentinel.
STAR_SENTINELS = ("4-NOT SPECIFIED",)


# The tables' schemas, stated so that no job has to read file footers before planning.
TABLES = {
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def star_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile per customer. The orders side is unique per customer, so Catalyst
    drops it from queries that use neither conditions nor the admission date."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sort_array(
            F.collect_set(F.when(F.col("o_totalprice") > CONDITION_PRICE, F.col("o_orderpriority")))
        ).alias("conditions"),
        F.max("o_orderdate").alias("admission_date"),
    )
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # Plain columns first, structs over them second: that lets Catalyst see through the structs.
    flat = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(orders, "c_custkey", "left")
        .select(
            F.col("c_custkey").alias("patient_id"),
            F.col("c_name").alias("name"),
            (20 + F.col("c_custkey") % 66).cast("int").alias("age"),
            F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
            F.concat(F.lit("0"), F.col("c_custkey").cast("string")).alias("phone"),
            F.col("n_name").alias("city"),
            F.col("conditions"),
            F.col("c_mktsegment").alias("blood_type"),
            (F.floor((F.col("c_acctbal") + 1000) / 1100).cast("int") + 1).alias("risk_score"),
            F.col("admission_date"),
        )
    )
    none = F.lit(None).cast("string")
    return flat.select(
        "patient_id",
        "name",
        "age",
        "gender",
        F.struct("phone", none.alias("email"), "city").alias("contact"),
        F.struct("conditions", F.array().cast("array<string>").alias("allergies"), "blood_type").alias("medical_history"),
        "risk_score",
        "admission_date",
        none.alias("notes"),
    )


def reading_columns(events: DataFrame) -> DataFrame:
    """Readings from events, batch or streaming. ``props.k`` (0 to 99) gives blood pressure."""
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    return events.select(
        F.col("user_id").alias("patient_id"),
        F.col("event_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("heart_rate"),
        F.struct((70 + k).alias("systolic"), (40 + F.floor(k * 7 / 10)).cast("int").alias("diastolic")).alias("blood_pressure"),
        F.when(F.col("event_type") == "error", "ABNORMAL").otherwise("NORMAL").alias("status"),
    )


def star_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reading_columns(table(spark, sf_dir, "events"))


def risk_update_columns(events: DataFrame) -> DataFrame:
    """Every event as a score change: the score is 1 to 10 from its value."""
    return events.select(
        F.col("user_id").alias("patient_id"),
        (1 + F.floor("value").cast("int") % 10).alias("score"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
    )


def star_risk_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk_update_columns(table(spark, sf_dir, "events"))


def star_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a profile patch: its type names the path, ``props.k`` the value.

    ``view`` sends ages as text that is not a number for k below 5, and ``purchase`` a
    null note for even k.
    """
    events = table(spark, sf_dir, "events").withColumn("k", F.regexp_extract("props", r"(\d+)", 1).cast("int"))
    k, kind = F.col("k"), F.col("event_type")
    path = (
        F.when(kind == "view", "age")
        .when(kind == "click", "contact.phone")
        .when(kind == "signup", "medical_history.blood_type")
        .when(kind == "purchase", "notes")
        .otherwise("contact.fax")
    )
    value = (
        F.when((kind == "view") & (k < 5), "old")
        .when((kind == "purchase") & (k % 2 == 0), F.lit(None))
        .when(kind == "view", (20 + F.floor(k / 25)).cast("string"))
        .otherwise((k % 4).cast("string"))
    )
    return events.select(
        F.col("user_id").alias("patient_id"),
        path.alias("path"),
        value.alias("value"),
        F.col("event_id").alias("seq"),
    )
