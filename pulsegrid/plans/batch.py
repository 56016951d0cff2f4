"""The whole batch run from two scans: one grouping-sets cube and one conditions count."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.bands import risk_band
from ..functions.numbers import mean_of
from ..operators.profiles import dimension, top_conditions
from ..params import DEFAULTS, Params
from ..sources.sinks import ResultSet, write_result

CUBE_DIMENSIONS = ("age_band", "gender", "city", "blood_type", "risk_score", "num_conditions")
ALL_PATIENTS = "all"


def profile_cube(
    profiles: DataFrame, params: Params = DEFAULTS, dimensions: Sequence[str] = CUBE_DIMENSIONS
) -> DataFrame:
    """Counts and sums of all patients and of every value of each dimension, in one scan.

    One row per (``dimension``, ``label``); ``label`` is text, null for a missing value.
    """
    levels = dict(zip(("low", "medium", "high"), params.risk_labels))
    facts = profiles.select(
        *[dimension(d, params) for d in dimensions],
        F.col("age").alias("age_value"),
        F.col("risk_score").alias("risk_value"),
    )
    level = risk_band(F.col("risk_value"), params)
    sets = [[F.col(d)] for d in dimensions] + [[]]
    cube = facts.groupingSets(sets, *dimensions).agg(
        F.grouping_id().alias("gid"),
        F.count("*").alias("count"),
        F.count("age_value").alias("ages"),
        F.sum("age_value").alias("age_sum"),
        F.min("age_value").alias("min_age"),
        F.max("age_value").alias("max_age"),
        F.count("risk_value").alias("risks"),
        F.sum("risk_value").alias("risk_sum"),
        *[F.count_if(level == label).alias(name) for name, label in levels.items()],
    )
    # Bit i of the grouping id, from the left, is 0 for the dimension that is grouped by.
    everything = 2 ** len(dimensions) - 1
    name, label = F.lit(ALL_PATIENTS), F.lit(None).cast("string")
    for i, d in enumerate(dimensions):
        grouped = F.col("gid") == everything - 2 ** (len(dimensions) - 1 - i)
        name = F.when(grouped, d).otherwise(name)
        label = F.when(grouped, F.col(d).cast("string")).otherwise(label)
    measures = ["count", "ages", "age_sum", "min_age", "max_age", "risks", "risk_sum", *levels]
    return cube.select(name.alias("dimension"), label.alias("label"), *measures)


def _slice(cube: DataFrame, name: str, key: str | None = None, dtype: str = "string") -> DataFrame:
    part = cube.filter(F.col("dimension") == name)
    return part.withColumn(key, F.col("label").cast(dtype)) if key else part


def _everyone(cube: DataFrame) -> Column:
    """Number of patients as a scalar subquery of the cube."""
    return _slice(cube, ALL_PATIENTS).select("count").scalar()


def _risk_columns(part: DataFrame, key: str) -> DataFrame:
    return part.select(key, mean_of(F.col("risk_sum"), F.col("risks"), 2).alias("avg_risk"), "count")


def analyses_of(cube: DataFrame, conditions: DataFrame, as_of=None) -> dict[str, DataFrame]:
    everyone = _slice(cube, ALL_PATIENTS)
    age = _slice(cube, "age_band", "age_band")
    city = _slice(cube, "city", "city")
    blood = _slice(cube, "blood_type", "blood_type")
    by_count = F.col("count").desc()
    moment = F.localtimestamp() if as_of is None else F.lit(as_of)

    def by_label(key):
        return F.col(key).asc_nulls_last()

    return {
        "demographics": everyone.select(
            F.col("count").alias("total_patients"),
            mean_of(F.col("age_sum"), F.col("ages"), 1).alias("avg_age"),
            "min_age",
            "max_age",
            moment.alias("as_of"),
        ),
        "age_groups": age.select("age_band", "count").orderBy(by_label("age_band")),
        "gender_distribution": _slice(cube, "gender", "gender").select("gender", "count").orderBy(by_label("gender")),
        "risk_summary": everyone.select(
            mean_of(F.col("risk_sum"), F.col("risks"), 2).alias("avg_risk"), "high", "medium", "low"
        ),
        "risk_by_age": _risk_columns(age, "age_band").orderBy(by_label("age_band")),
        "top_conditions": conditions,
        "multi_condition": _slice(cube, "num_conditions", "num_conditions", "int")
        .select("num_conditions", "count")
        .orderBy(by_label("num_conditions")),
        "city_distribution": _risk_columns(city, "city").orderBy(by_count, by_label("city")),
        "blood_type_distribution": blood.select("blood_type", "count").orderBy(by_count, by_label("blood_type")),
        "blood_type_risk": _risk_columns(blood, "blood_type").orderBy(F.col("avg_risk").desc_nulls_last(), by_label("blood_type")),
    }


ANALYSES = (
    "demographics",
    "age_groups",
    "gender_distribution",
    "risk_summary",
    "risk_by_age",
    "top_conditions",
    "multi_condition",
    "city_distribution",
    "blood_type_distribution",
    "blood_type_risk",
)


def run_batch(
    profiles: DataFrame, as_of=None, k: int = 10, params: Params = DEFAULTS, cube: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every batch analysis as a lazy DataFrame over one cube.

    The cube, one row per label, is cached with the first analysis that runs; give your
    own ``profile_cube`` to choose where it is kept and when it is freed.
    """
    if cube is None:
        cube = profile_cube(profiles, params).persist()
    return analyses_of(cube, top_conditions(profiles, k, params, _everyone(cube)), as_of)


def save_batch(
    profiles: DataFrame, path: str, as_of=None, k: int = 10, params: Params = DEFAULTS, fmt: str = "parquet"
) -> dict[str, str]:
    """Write every analysis as one set below ``path``; returns where. ``read_result(spark, path, name=…)`` gives the
    analyses of the last whole set, so a run that dies changes nothing for readers.

    The cube is written first and the analyses read it back, so the profiles are scanned once for all of them and once
    for the conditions; the small writes run side by side."""
    spark = profiles.sparkSession
    results = ResultSet(spark, path)
    cube = spark.read.parquet(write_result(profile_cube(profiles, params), results.folder, "cube"))
    analyses = analyses_of(cube, top_conditions(profiles, k, params, _everyone(cube)), as_of)
    with ThreadPoolExecutor(max_workers=4) as pool:
        writes = [
            pool.submit(inheritable_thread_target(spark)(write_result), df, results.folder, name, fmt) for name, df in analyses.items()
        ]
        for write in writes:
            write.result()
    return results.publish(list(analyses), fmt)
