"""The daily statistics report as one long table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import gender_label
from ..functions.numbers import mean_of, percent
from ..operators.profiles import condition_counts
from ..params import DEFAULTS, Params
from .batch import ALL_PATIENTS, profile_cube

REPORTED = ("gender", "city", "blood_type")
BARRED = ("gender", "city")


def daily_report(profiles: DataFrame, k: int = 7, params: Params = DEFAULTS) -> DataFrame:
    """Rows ``(section, label, count, value, pct, rank, bar)``.

    Sections: ``patients`` (total), ``age`` (average, min, max as ``value``), ``risk``
    (average as ``value``, then levels), ``gender``, ``city``, ``blood_type`` and the
    top k ``conditions``. Shares are of all patients; the conditions' sentinels are
    kept. ``rank`` counts down the section by falling count; ``bar`` has one block
    for every two percent.
    """
    counted = F.col("section").isin(*REPORTED, "conditions")
    order = [F.col("count").desc(), F.col("label").asc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy("section").orderBy(*order))
    # Over the report's rows, one a label: the total is the cube's, so no scan is spent on it.
    everyone = F.max(F.when(F.col("section") == "patients", F.col("count"))).over(Window.partitionBy(F.lit(0)))
    conditions = (
        condition_counts(profiles, replace(params, sentinels=()))
        .orderBy(F.col("count").desc(), F.col("condition").asc_nulls_last())
        .limit(k)
    )
    blocks = F.floor(F.col("count") * 50 / F.col("everyone")).cast("int")
    return (
        _cube_rows(profile_cube(profiles, params, REPORTED))
        .unionByName(
            conditions.select(
                F.lit("conditions").alias("section"),
                F.col("condition").alias("label"),
                "count",
                F.lit(None).cast("double").alias("value"),
            )
        )
        .withColumn("everyone", everyone)
        .select(
            "section",
            "label",
            "count",
            "value",
            percent(F.col("count"), F.col("everyone")).alias("pct"),
            F.when(counted, rank).alias("rank"),
            F.when(F.col("section").isin(*BARRED), F.repeat(F.lit("█"), blocks)).alias("bar"),
        )
    )


def _cube_rows(cube: DataFrame) -> DataFrame:
    """Report rows of the cube: several from its all-patients row, one from each other."""

    def row(section, label, count=None, value=None):
        return F.struct(
            F.lit(section).alias("section"),
            F.lit(label).alias("label"),
            (F.lit(None) if count is None else F.col(count)).cast("long").alias("count"),
            (F.lit(None) if value is None else value).cast("double").alias("value"),
        )

    overall = F.array(
        row("patients", "total", "count"),
        row("age", "average", value=mean_of(F.col("age_sum"), F.col("ages"), 1)),
        row("age", "min", value=F.col("min_age")),
        row("age", "max", value=F.col("max_age")),
        row("risk", "average", value=mean_of(F.col("risk_sum"), F.col("risks"), 2)),
        row("risk", "HIGH", "high"),
        row("risk", "MEDIUM", "medium"),
        row("risk", "LOW", "low"),
    )
    label = F.when(F.col("dimension") == "gender", gender_label(F.col("label"))).otherwise(F.col("label"))
    single = F.array(
        F.struct(
            F.col("dimension").alias("section"),
            label.alias("label"),
            F.col("count"),
            F.lit(None).cast("double").alias("value"),
        )
    )
    rows = F.when(F.col("dimension") == ALL_PATIENTS, overall).otherwise(single)
    return cube.select(F.inline(rows))
