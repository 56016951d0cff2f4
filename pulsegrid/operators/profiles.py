"""Analyses over patient profiles. Each is one scan with partial aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.bands import age_band, gender_label, risk_band
from ..functions.numbers import percent, rounded_mean
from ..params import DEFAULTS, HIGH_RISK_SCORE, RECENT_ADMISSION_DAYS, Params


def _or_missing(col: Column, params: Params) -> Column:
    return col if params.missing_label is None else F.coalesce(col, F.lit(params.missing_label))


def num_conditions() -> Column:
    """Length of the conditions array, sentinels included; a null array has 0."""
    return F.coalesce(F.size("medical_history.conditions"), F.lit(0))


def dimension(name: str, params: Params = DEFAULTS) -> Column:
    """Grouping column of a profile by name."""
    if name == "age_band":
        col = age_band(F.col("age"), params)
    elif name == "risk_band":
        col = risk_band(F.col("risk_score"), params)
    elif name == "gender_label":
        col = gender_label(F.col("gender"))
    elif name == "city":
        col = _or_missing(F.col("contact.city"), params)
    elif name == "blood_type":
        col = _or_missing(F.col("medical_history.blood_type"), params)
    elif name == "num_conditions":
        col = num_conditions()
    elif name in ("gender", "risk_score"):
        col = F.col(name)
    else:
        raise ValueError(f"unknown dimension {name!r}")
    return col.alias(name)


# Dimensions listed by their own value; the others by falling count.
ORDERED_DIMENSIONS = ("age_band", "risk_score", "num_conditions")


def _listing_order(by: str) -> list[Column]:
    if by in ORDERED_DIMENSIONS:
        return [F.col(by).asc_nulls_last()]
    return [F.col("count").desc(), F.col(by).asc_nulls_last()]


def patient_count(profiles: DataFrame) -> DataFrame:
    return profiles.select(F.count("*").alias("total"))


def total(profiles: DataFrame) -> Column:
    """Number of patients as a scalar subquery."""
    return patient_count(profiles).scalar()


def lookup(profiles: DataFrame, ids: DataFrame | Sequence | str | int) -> DataFrame:
    """Profiles of the given patients: one id, a list of ids, or a table with ``patient_id``."""
    if isinstance(ids, DataFrame):
        return profiles.join(ids.select("patient_id").distinct(), "patient_id", "left_semi")
    if isinstance(ids, (str, int)):
        ids = [ids]
    return profiles.filter(F.col("patient_id").isin(list(ids)))


def high_risk(profiles: DataFrame, min_score: int = HIGH_RISK_SCORE) -> DataFrame:
    return profiles.filter(F.col("risk_score") >= min_score)


def admitted_recently(as_of: Column | None, days: int) -> Column:
    moment = F.localtimestamp() if as_of is None else F.lit(as_of)
    return F.col("admission_date") >= moment - F.make_dt_interval(F.lit(days))


def admitted_within(profiles: DataFrame, as_of=None, days: int = RECENT_ADMISSION_DAYS) -> DataFrame:
    """Patients admitted at ``as_of - days`` or later. ``as_of`` defaults to now."""
    return profiles.filter(admitted_recently(as_of, days))


def age_stats(profiles: DataFrame, digits: int | None = 1) -> DataFrame:
    """Mean, least and greatest age; ``digits=None`` leaves the mean unrounded."""
    return profiles.agg(
        rounded_mean(F.col("age"), digits).alias("avg_age"),
        F.min("age").alias("min_age"),
        F.max("age").alias("max_age"),
    )


def mean_age(profiles: DataFrame) -> DataFrame:
    """Mean age to one decimal, 0 without patients."""
    return profiles.agg(F.coalesce(rounded_mean(F.col("age"), 1), F.lit(0.0)).alias("avg_age"))


def _with_zero_rows(counts: DataFrame, by: str, labels: Sequence[str]) -> DataFrame:
    zeros = counts.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(label) for label in labels])).alias(by), F.lit(0).cast("long").alias("count")
    )
    return counts.unionByName(zeros).groupBy(by).agg(F.sum("count").alias("count"))


def distribution(
    profiles: DataFrame,
    by: str,
    params: Params = DEFAULTS,
    with_share: bool = False,
    all_bands: bool = False,
) -> DataFrame:
    """Patients per value of a dimension, with their share of all patients on request.

    ``all_bands`` also lists the bands of ``age_band`` or ``risk_band`` that nobody is in.
    """
    counts = profiles.groupBy(dimension(by, params)).agg(F.count("*").alias("count"))
    if all_bands:
        labels = {"age_band": params.age_labels, "risk_band": params.risk_labels}[by]
        counts = _with_zero_rows(counts, by, labels)
    if with_share:
        counts = counts.withColumn("pct", percent(F.col("count"), total(profiles)))
    return counts.orderBy(*_listing_order(by))


def risk_histogram(profiles: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Patients per exact score, with the score's band."""
    return distribution(profiles, "risk_score", params).select(
        "risk_score", "count", risk_band(F.col("risk_score"), params).alias("level")
    )


def _in_level(level: str, params: Params) -> Column:
    return F.count_if(risk_band(F.col("risk_score"), params) == level)


def risk_summary(profiles: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    low, medium, high = params.risk_labels
    return profiles.agg(
        rounded_mean(F.col("risk_score"), 2).alias("avg_risk"),
        _in_level(high, params).alias("high"),
        _in_level(medium, params).alias("medium"),
        _in_level(low, params).alias("low"),
    )


def risk_shares(profiles: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Count and share of all patients per risk level, one row each, from one scan."""
    levels = list(reversed(params.risk_labels))
    counts = profiles.agg(
        F.count("*").alias("total"), *[_in_level(level, params).alias(level) for level in levels]
    )
    rows = F.explode(
        F.array(*[F.struct(F.lit(level).alias("level"), F.col(level).alias("count")) for level in levels])
    )
    return counts.select("total", rows.alias("r")).select(
        "r.level", "r.count", percent(F.col("r.count"), F.col("total")).alias("pct")
    )


def risk_by(profiles: DataFrame, by: str, params: Params = DEFAULTS) -> DataFrame:
    """Mean risk and patients per dimension: by band for ages, by falling count for
    cities, by falling mean for the rest."""
    out = profiles.groupBy(dimension(by, params)).agg(
        rounded_mean(F.col("risk_score"), 2).alias("avg_risk"), F.count("*").alias("count")
    )
    if by in ORDERED_DIMENSIONS or by == "city":
        return out.orderBy(*_listing_order(by))
    return out.orderBy(F.col("avg_risk").desc_nulls_last(), F.col(by).asc_nulls_last())


def overview(profiles: DataFrame, as_of=None, days: int = RECENT_ADMISSION_DAYS) -> DataFrame:
    """Total, high-risk and recently admitted patients and the mean age, in one pass."""
    return profiles.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("risk_score") >= HIGH_RISK_SCORE).alias("high_risk"),
        F.coalesce(rounded_mean(F.col("age"), 1), F.lit(0.0)).alias("avg_age"),
        F.count_if(admitted_recently(as_of, days)).alias("active"),
    )


def condition_counts(profiles: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """Patients' condition entries per condition, without the sentinels."""
    conditions = profiles.select(F.explode("medical_history.conditions").alias("condition"))
    if params.sentinels:
        conditions = conditions.filter(~F.col("condition").isin(*params.sentinels))
    return conditions.groupBy("condition").agg(F.count("*").alias("count"))


def top_conditions(
    profiles: DataFrame, k: int | None = 10, params: Params = DEFAULTS, everyone: Column | None = None
) -> DataFrame:
    """The k most frequent conditions with their share of patients and their rank;
    all conditions, without rank, for ``k=None``. ``everyone``: the number of patients,
    where it is known without a scan."""
    order = [F.col("count").desc(), F.col("condition").asc_nulls_last()]
    pct = percent(F.col("count"), total(profiles) if everyone is None else everyone).alias("pct")
    counts = condition_counts(profiles, params).orderBy(*order)
    if k is None:
        return counts.select("condition", "count", pct)
    rank = F.row_number().over(Window.orderBy(*order)).alias("rank")  # over k rows
    return counts.limit(k).select("condition", "count", pct, rank)


def multi_condition(profiles: DataFrame) -> DataFrame:
    return distribution(profiles, "num_conditions")


def recent_patients(profiles: DataFrame, k: int = 10) -> DataFrame:
    return (
        profiles.select("patient_id", "name", "age", "risk_score", "admission_date")
        .orderBy(F.col("admission_date").desc_nulls_last(), F.col("patient_id"))
        .limit(k)
    )
