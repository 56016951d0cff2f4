from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import profile, tuples
from pulsegrid import operators as ops
from pulsegrid.__main__ import main
from pulsegrid.functions import age_band, band, gender_label, heart_rate_severity, risk_band
from pulsegrid.params import Params
from pulsegrid.plans import daily_report, profile_cube, run_batch, save_batch
from pulsegrid.schemas import PROFILE_SCHEMA
from pulsegrid.sources import export_profiles, read_result

NOW = datetime(2025, 6, 30, 12)


def labels(spark, values, rule, dtype="int"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(rule(F.col("v"))).collect()]


def test_bands_at_their_edges(spark):
    assert labels(spark, [20, 29, 30, 49, 50, 64, 65, 85, None], age_band) == [
        "18-29", "18-29", "30-49", "30-49", "50-64", "50-64", "65+", "65+", None]
    assert labels(spark, [1, 3, 4, 6, 7, 10, None], risk_band) == [
        "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", None]


def test_null_band_options(spark):
    assert labels(spark, [None], lambda c: age_band(c, Params(null_age_as_last=True))) == ["65+"]
    assert labels(spark, [None], lambda c: risk_band(c, Params(null_risk_as_low=True))) == ["LOW"]
    with pytest.raises(ValueError):
        band(F.col("v"), (1, 2), ("a", "b"))


def test_severity_and_gender(spark):
    assert labels(spark, [None, 120, 121], heart_rate_severity) == ["Medium", "Medium", "High"]
    assert labels(spark, ["M", "F", "X", None], gender_label, "string") == ["Male", "Female", "Female", "Female"]


@pytest.fixture
def ward(profiles_of):
    return profiles_of(
        profile("P1", 25, "M", "Oslen", ["Ague", "None"], 9, NOW - timedelta(days=30)),
        profile("P2", 45, "F", "Oslen", ["Ague", ""], 4, NOW - timedelta(days=30, seconds=1)),
        profile("P3", 66, "F", "Annaba", [], 3, NOW, blood="B-"),
        profile("P4", None, "X", None, None, None, None),
        profile("P5", 64, "M", "Annaba", ["Anglewort"], 7, NOW - timedelta(days=2), contact=None, blood=None),
    )


def test_aggregates_with_nulls(ward):
    assert tuples(ops.age_stats(ward)) == [(50.0, 25, 66)]
    assert tuples(ops.age_stats(ward.filter("age IN (25, 45, 64)"), None)) == [(134 / 3, 25, 64)]
    assert tuples(ops.risk_summary(ward)) == [(5.75, 2, 1, 1)]
    assert tuples(ops.risk_summary(ward, Params(null_risk_as_low=True))) == [(5.75, 2, 1, 2)]
    assert tuples(ops.risk_shares(ward)) == [("HIGH", 2, 40.0), ("MEDIUM", 1, 20.0), ("LOW", 1, 20.0)]
    assert tuples(ops.overview(ward, NOW)) == [(5, 2, 50.0, 3)]
    assert tuples(ops.patient_count(ward)) == [(5,)]


def test_empty_table(spark):
    empty = spark.createDataFrame([], PROFILE_SCHEMA)
    assert tuples(ops.mean_age(empty)) == [(0.0,)]
    assert tuples(ops.overview(empty, NOW)) == [(0, 0, 0.0, 0)]
    assert tuples(ops.risk_shares(empty)) == [("HIGH", 0, None), ("MEDIUM", 0, None), ("LOW", 0, None)]
    assert tuples(ops.distribution(empty, "city", with_share=True)) == []


def test_admission_exactly_at_the_limit_counts(ward):
    assert {r.patient_id for r in ops.admitted_within(ward, NOW).collect()} == {"P1", "P3", "P5"}
    assert {r.patient_id for r in ops.high_risk(ward).collect()} == {"P1", "P5"}


def test_distributions(ward):
    assert tuples(ops.distribution(ward, "city")) == [("Oslen", 2), (None, 2), ("Annaba", 1)]
    assert tuples(ops.distribution(ward, "city", Params(missing_label="Unknown"), with_share=True)) == [
        ("Oslen", 2, 40.0), ("Unknown", 2, 40.0), ("Annaba", 1, 20.0)]
    assert tuples(ops.distribution(ward, "gender_label")) == [("Female", 3), ("Male", 2)]
    assert tuples(ops.multi_condition(ward)) == [(0, 2), (1, 1), (2, 2)]
    assert tuples(ops.risk_by(ward, "city"))[0] == ("Oslen", 6.5, 2)
    assert tuples(ops.risk_histogram(ward))[0] == (3, 1, "LOW")
    with pytest.raises(ValueError):
        ops.distribution(ward, "shoe_size")


def test_empty_bands_are_listed_on_request(ward):
    assert tuples(ops.distribution(ward, "age_band")) == [("18-29", 1), ("30-49", 1), ("50-64", 1), ("65+", 1), (None, 1)]
    young = ward.filter("age = 25")
    assert tuples(ops.distribution(young, "age_band", all_bands=True)) == [
        ("18-29", 1), ("30-49", 0), ("50-64", 0), ("65+", 0)]


def test_conditions_and_sentinels(ward):
    assert tuples(ops.top_conditions(ward)) == [("Ague", 2, 40.0, 1), ("Anglewort", 1, 20.0, 2)]
    assert tuples(ops.top_conditions(ward, 1)) == [("Ague", 2, 40.0, 1)]
    kept = tuples(ops.top_conditions(ward, None, Params(sentinels=())))
    assert kept == [("Ague", 2, 40.0), ("", 1, 20.0), ("Anglewort", 1, 20.0), ("None", 1, 20.0)]


def test_recent_patients_and_lookup(ward, spark):
    assert [r.patient_id for r in ops.recent_patients(ward, 3).collect()] == ["P3", "P5", "P1"]
    assert ops.recent_patients(ward).count() == 5
    assert ops.lookup(ward, "P9").count() == 0
    assert ops.lookup(ward, ["P1", "P9"]).count() == 1
    twice = spark.createDataFrame([("P1",), ("P1",), ("P2",)], "patient_id string")
    assert ops.lookup(ward, twice).count() == 2


def test_patient_card(profiles_of):
    entries = [{"score": i + 1, "timestamp": datetime(2025, 1, i + 1, 9, 0, 0, 123), "previous_score": i} for i in range(4)]
    cards = {r.patient_id: r for r in ops.patient_card(profiles_of(
        profile("P1", conditions=["Ague", "Anglewort"], risk_score_history=entries, notes="calm"),
        profile("P2", conditions=None, contact=None),
    )).collect()}
    assert cards["P1"].conditions == "Ague, Anglewort" and cards["P1"].notes == "calm"
    assert cards["P1"].recent_changes == (
        "2025-01-02T09:00:00: 1 → 2; 2025-01-03T09:00:00: 2 → 3; 2025-01-04T09:00:00: 3 → 4")
    assert (cards["P2"].conditions, cards["P2"].allergies, cards["P2"].notes) == ("None", "None", "N/A")
    assert cards["P2"].city is None and cards["P2"].recent_changes is None


def test_cube_agrees_with_the_single_analyses(ward):
    batch = run_batch(ward, NOW)
    assert tuples(batch["risk_by_age"]) == tuples(ops.risk_by(ward, "age_band"))
    assert tuples(batch["risk_summary"]) == tuples(ops.risk_summary(ward))
    assert tuples(batch["city_distribution"]) == tuples(ops.risk_by(ward, "city"))
    assert tuples(batch["blood_type_risk"]) == tuples(ops.risk_by(ward, "blood_type"))
    assert tuples(batch["multi_condition"]) == tuples(ops.multi_condition(ward))
    assert tuples(batch["demographics"]) == [(5, 50.0, 25, 66, NOW)]
    assert profile_cube(ward).filter("dimension = 'all'").count() == 1


def test_saved_batch_keeps_names_and_types(ward, tmp_path, spark):
    saved = save_batch(ward, str(tmp_path), NOW)
    blood = read_result(spark, saved["blood_type_risk"])
    assert blood.dtypes == [("blood_type", "string"), ("avg_risk", "double"), ("count", "bigint")]
    assert tuples(read_result(spark, str(tmp_path / "absent"))) == [("no_results", "nothing has been stored here")]


def test_daily_report(ward):
    rows = {(r.section, r.label): r for r in daily_report(ward, k=2).collect()}
    assert rows[("patients", "total")]["count"] == 5
    assert rows[("age", "average")]["value"] == 50.0
    assert rows[("risk", "HIGH")].pct == 40.0
    assert rows[("city", "Oslen")].bar == "█" * 20 and rows[("city", "Oslen")]["rank"] == 1
    assert [(k[1], r["rank"]) for k, r in sorted(rows.items(), key=str) if k[0] == "conditions"] == [("", 2), ("Ague", 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(20, 85)), st.one_of(st.none(), st.integers(1, 10))), max_size=30))
def test_band_counts_add_up(profiles_of, people):
    table = profiles_of(*[profile(f"P{i}", age, risk=risk) for i, (age, risk) in enumerate(people)])
    assert sum(n for _, n in tuples(ops.distribution(table, "age_band", all_bands=True))) == len(people)
    _, high, medium, low = tuples(ops.risk_summary(table))[0]
    assert high + medium + low == sum(risk is not None for _, risk in people)


def test_batch_job_from_the_command_line(spark, ward, tmp_path):
    export_profiles(ward, str(tmp_path / "in"))
    main(["batch", "--profiles", str(tmp_path / "in"), "--out", str(tmp_path / "out"), "--output-format", "json",
          "--as-of", NOW.isoformat()])
    risk = read_result(spark, str(tmp_path / "out"), name="risk_summary").first()
    assert risk.asDict() == {"avg_risk": 5.75, "high": 2, "medium": 1, "low": 1}
    main(["report", "--profiles", str(tmp_path / "in"), "--out", str(tmp_path / "out")])
    assert read_result(spark, str(tmp_path / "out" / "analysis=daily_report")).filter("section = 'risk'").count() == 4
