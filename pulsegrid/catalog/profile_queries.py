from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.bands import gender_label
from ..operators import profiles as ops
from ..operators.cards import patient_card
from ..params import Params
from ..plans.batch import run_batch
from ..plans.report import daily_report
from ..sources.star import STAR_SENTINELS, star_profiles, table
from .registry import AGE_BAND, CONDITIONS_TEXT, RISK_LEVEL, query, ratio, share, with_profiles

PARAMS = Params(sentinels=STAR_SENTINELS)
KEEP_SENTINELS = Params(sentinels=())
TOTAL = "(SELECT count(*) FROM profiles)"
LEVEL = RISK_LEVEL.format("risk_score")


def last_admission(profiles):
    """The data's own "now": the latest admission."""
    return profiles.select(F.max("admission_date")).scalar()


def _grouped(key: str, expr: str, extra: str = "") -> str:
    return with_profiles(f"SELECT {expr} AS {key}, count(*) AS count{extra} FROM profiles GROUP BY 1")


MEAN_RISK = f", {ratio('sum(risk_score)', 'count(*)', 2)} AS avg_risk"
SHARE = f", {share('count(*)', TOTAL)} AS pct"


@query("patient_count", with_profiles("SELECT count(*) AS total FROM profiles"))
def _(spark, sf):
    return ops.patient_count(star_profiles(spark, sf))


@query("age_stats", with_profiles(
    f"SELECT {ratio('sum(age)', 'count(*)', 1)} AS avg_age, min(age) AS min_age, max(age) AS max_age FROM profiles"))
def _(spark, sf):
    return ops.age_stats(star_profiles(spark, sf))


@query("mean_age", with_profiles(f"SELECT {ratio('sum(age)', 'count(*)', 1)} AS avg_age FROM profiles"))
def _(spark, sf):
    return ops.mean_age(star_profiles(spark, sf))


@query("age_bands", _grouped("age_band", AGE_BAND))
def _(spark, sf):
    return ops.distribution(star_profiles(spark, sf), "age_band", all_bands=True)


@query("gender_dist", _grouped("gender", "gender"))
def _(spark, sf):
    return ops.distribution(star_profiles(spark, sf), "gender")


@query("gender_share", _grouped("gender_label", "CASE gender WHEN 'M' THEN 'Male' ELSE 'Female' END", SHARE))
def _(spark, sf):
    return ops.distribution(star_profiles(spark, sf), "gender_label", with_share=True)


@query("gender_labels", with_profiles(
    "SELECT patient_id, CASE gender WHEN 'M' THEN 'Male' ELSE 'Female' END AS gender_label FROM profiles"))
def _(spark, sf):
    return star_profiles(spark, sf).select("patient_id", gender_label(F.col("gender")).alias("gender_label"))


@query("risk_summary", with_profiles(f"""
SELECT {ratio('sum(risk_score)', 'count(*)', 2)} AS avg_risk, count(*) FILTER (risk_score >= 7) AS high,
       count(*) FILTER (risk_score >= 4 AND risk_score < 7) AS medium, count(*) FILTER (risk_score < 4) AS low
FROM profiles"""))
def _(spark, sf):
    return ops.risk_summary(star_profiles(spark, sf))


@query("risk_share", _grouped("level", LEVEL, SHARE))
def _(spark, sf):
    return ops.risk_shares(star_profiles(spark, sf))


@query("risk_by_age", _grouped("age_band", AGE_BAND, MEAN_RISK))
def risk_by_age(spark, sf):
    return ops.risk_by(star_profiles(spark, sf), "age_band")


@query("risk_hist", with_profiles(
    f"SELECT risk_score, count(*) AS count, {LEVEL} AS level FROM profiles GROUP BY risk_score"))
def _(spark, sf):
    return ops.risk_histogram(star_profiles(spark, sf))


@query("city_dist", _grouped("city", "city", MEAN_RISK))
def _(spark, sf):
    return ops.risk_by(star_profiles(spark, sf), "city")


@query("city_share", _grouped("city", "coalesce(city, 'Unknown')", SHARE))
def _(spark, sf):
    return ops.distribution(star_profiles(spark, sf), "city", Params(missing_label="Unknown"), with_share=True)


@query("blood_dist", _grouped("blood_type", "coalesce(blood_type, 'Unknown')"))
def _(spark, sf):
    return ops.distribution(star_profiles(spark, sf), "blood_type", Params(missing_label="Unknown"))


@query("blood_share", _grouped("blood_type", "blood_type", SHARE))
def _(spark, sf):
    return ops.distribution(star_profiles(spark, sf), "blood_type", with_share=True)


@query("blood_risk", _grouped("blood_type", "blood_type", MEAN_RISK))
def _(spark, sf):
    return ops.risk_by(star_profiles(spark, sf), "blood_type")


@query("multi_condition", _grouped("num_conditions", "CAST(coalesce(len(conditions), 0) AS INTEGER)"))
def _(spark, sf):
    return ops.multi_condition(star_profiles(spark, sf))


def _conditions(k: int | None, sentinel: bool) -> str:
    kept = "" if sentinel else "WHERE condition <> '4-NOT SPECIFIED'"
    rank = "" if k is None else ", CAST(row_number() OVER (ORDER BY count(*) DESC, condition) AS INTEGER) AS rank"
    limit = "" if k is None else f"ORDER BY count DESC, condition LIMIT {k}"
    return with_profiles(f"""
SELECT condition, count(*) AS count, {share('count(*)', TOTAL)} AS pct{rank}
FROM (SELECT unnest(conditions) AS condition FROM profiles) {kept} GROUP BY condition {limit}""")


@query("top_conditions", _conditions(10, False))
def _(spark, sf):
    return ops.top_conditions(star_profiles(spark, sf), 10, PARAMS)


@query("dashboard_conditions", _conditions(8, False))
def _(spark, sf):
    return ops.top_conditions(star_profiles(spark, sf), 8, PARAMS)


@query("report_conditions", _conditions(7, True))
def _(spark, sf):
    return ops.top_conditions(star_profiles(spark, sf), 7, KEEP_SENTINELS)


@query("condition_share", _conditions(None, True))
def _(spark, sf):
    return ops.top_conditions(star_profiles(spark, sf), None, KEEP_SENTINELS)


SINCE = "admission_date >= (SELECT max(admission_date) FROM profiles) - INTERVAL 30 DAYS"


@query("overview", with_profiles(f"""
SELECT count(*) AS total, count(*) FILTER (risk_score >= 7) AS high_risk,
       {ratio('sum(age)', 'count(*)', 1)} AS avg_age, count(*) FILTER ({SINCE}) AS active FROM profiles"""))
def _(spark, sf):
    profiles = star_profiles(spark, sf)
    return ops.overview(profiles, last_admission(profiles))


@query("high_risk", with_profiles("SELECT patient_id, risk_score FROM profiles WHERE risk_score >= 7"))
def _(spark, sf):
    return ops.high_risk(star_profiles(spark, sf)).select("patient_id", "risk_score")


@query("active_monitoring", with_profiles(f"SELECT patient_id, admission_date FROM profiles WHERE {SINCE}"))
def _(spark, sf):
    profiles = star_profiles(spark, sf)
    return ops.admitted_within(profiles, last_admission(profiles)).select("patient_id", "admission_date")


@query("recent_patients", with_profiles("""
SELECT patient_id, name, age, risk_score, admission_date FROM profiles
ORDER BY admission_date DESC NULLS LAST, patient_id LIMIT 10"""))
def _(spark, sf):
    return ops.recent_patients(star_profiles(spark, sf))


@query("profile_lookup", with_profiles("""
SELECT patient_id, name, age FROM profiles WHERE patient_id IN (SELECT user_id FROM events)"""))
def _(spark, sf):
    monitored = table(spark, sf, "events").select(F.col("user_id").alias("patient_id"))
    return ops.lookup(star_profiles(spark, sf), monitored).select("patient_id", "name", "age")


@query("patient_card", with_profiles(f"""
SELECT patient_id, name, age, gender, phone, city, risk_score, {CONDITIONS_TEXT} AS conditions,
       'None' AS allergies, blood_type, 'N/A' AS notes, NULL::VARCHAR AS recent_changes FROM profiles"""))
def _(spark, sf):
    return patient_card(star_profiles(spark, sf))


def _report_rows(section: str, label: str, order: str, bar: bool) -> str:
    blocks = f"repeat('█', CAST(count(*) * 50 // {TOTAL} AS INTEGER))" if bar else "NULL::VARCHAR"
    return f"""
SELECT '{section}' AS section, {label} AS label, count(*) AS count, NULL::DOUBLE AS value,
       {share('count(*)', TOTAL)} AS pct,
       CAST(row_number() OVER (ORDER BY count(*) DESC, {label}) AS INTEGER) AS rank, {blocks} AS bar
FROM {order} GROUP BY 2"""


def _report_fact(section: str, label: str, count: str, value: str) -> str:
    pct = "NULL::DOUBLE" if count == "NULL::BIGINT" else share(f"({count})", TOTAL)
    return f"""
SELECT '{section}', '{label}', {count}, {value}, {pct}, NULL::INTEGER, NULL::VARCHAR FROM profiles"""


REPORT = with_profiles(" UNION ALL ".join([
    _report_rows("gender", "CASE gender WHEN 'M' THEN 'Male' ELSE 'Female' END", "profiles", True),
    _report_rows("city", "city", "profiles", True),
    _report_rows("blood_type", "blood_type", "profiles", False),
    "SELECT * FROM (" + _report_rows("conditions", "condition",
                                     "(SELECT unnest(conditions) AS condition FROM profiles)", False)
    + " ORDER BY count DESC, label LIMIT 7)",
    _report_fact("patients", "total", "count(*)", "NULL::DOUBLE"),
    _report_fact("age", "average", "NULL::BIGINT", ratio("sum(age)", "count(*)", 1)),
    _report_fact("age", "min", "NULL::BIGINT", "min(age)::DOUBLE"),
    _report_fact("age", "max", "NULL::BIGINT", "max(age)::DOUBLE"),
    _report_fact("risk", "average", "NULL::BIGINT", ratio("sum(risk_score)", "count(*)", 2)),
    _report_fact("risk", "HIGH", "count(*) FILTER (risk_score >= 7)", "NULL::DOUBLE"),
    _report_fact("risk", "MEDIUM", "count(*) FILTER (risk_score >= 4 AND risk_score < 7)", "NULL::DOUBLE"),
    _report_fact("risk", "LOW", "count(*) FILTER (risk_score < 4)", "NULL::DOUBLE"),
]))


@query("daily_report", REPORT)
def _(spark, sf):
    return daily_report(star_profiles(spark, sf))


def _tidy(analysis: str, label: str, count: str, value: str) -> str:
    return f"SELECT '{analysis}' AS analysis, {label} AS label, {count} AS count, {value} AS value"


MEAN = ratio("sum(risk_score)", "count(*)", 2)
NO_VALUE = "NULL::DOUBLE"
BATCH = with_profiles(" UNION ALL ".join([
    _tidy("demographics", "min(age)::VARCHAR || '-' || max(age)::VARCHAR", "count(*)", ratio("sum(age)", "count(*)", 1)) + " FROM profiles",
    _tidy("age_groups", AGE_BAND, "count(*)", NO_VALUE) + " FROM profiles GROUP BY 2",
    _tidy("gender_distribution", "gender", "count(*)", NO_VALUE) + " FROM profiles GROUP BY 2",
    _tidy("risk_summary", "'avg_risk'", "count(*) FILTER (risk_score >= 7)", MEAN) + " FROM profiles",
    _tidy("risk_by_age", AGE_BAND, "count(*)", MEAN) + " FROM profiles GROUP BY 2",
    "SELECT * FROM (" + _tidy("top_conditions", "condition", "count(*)", share("count(*)", TOTAL))
    + " FROM (SELECT unnest(conditions) AS condition FROM profiles) WHERE condition <> '4-NOT SPECIFIED'"
    " GROUP BY 2 ORDER BY count DESC, label LIMIT 10)",
    _tidy("multi_condition", "coalesce(len(conditions), 0)::VARCHAR", "count(*)", NO_VALUE) + " FROM profiles GROUP BY 2",
    _tidy("city_distribution", "city", "count(*)", MEAN) + " FROM profiles GROUP BY 2",
    _tidy("blood_type_distribution", "blood_type", "count(*)", NO_VALUE) + " FROM profiles GROUP BY 2",
    _tidy("blood_type_risk", "blood_type", "count(*)", MEAN) + " FROM profiles GROUP BY 2",
]))


def tidy_batch(results):
    """All batch analyses as one table (analysis, label, count, value)."""
    shapes = {
        "demographics": ("concat_ws('-', min_age, max_age)", "total_patients", "avg_age"),
        "age_groups": ("age_band", "count", "NULL"),
        "gender_distribution": ("gender", "count", "NULL"),
        "risk_summary": ("'avg_risk'", "high", "avg_risk"),
        "risk_by_age": ("age_band", "count", "avg_risk"),
        "top_conditions": ("condition", "count", "pct"),
        "multi_condition": ("num_conditions", "count", "NULL"),
        "city_distribution": ("city", "count", "avg_risk"),
        "blood_type_distribution": ("blood_type", "count", "NULL"),
        "blood_type_risk": ("blood_type", "count", "avg_risk"),
    }
    out = None
    for name, (label, count, value) in shapes.items():
        part = results[name].selectExpr(
            f"'{name}' AS analysis", f"CAST({label} AS STRING) AS label", f"{count} AS count", f"CAST({value} AS DOUBLE) AS value"
        )
        out = part if out is None else out.unionByName(part)
    return out


@query("batch_run", BATCH)
def _(spark, sf):
    profiles = star_profiles(spark, sf)
    return tidy_batch(run_batch(profiles, last_admission(profiles), params=PARAMS))
