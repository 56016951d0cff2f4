from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import profile, reading, tuples
from pulsegrid import operators as ops
from pulsegrid.functions import key_patient_id, reading_key
from pulsegrid.operators import skew
from pulsegrid.operators.skew import top_n_per_key
from pulsegrid.sources import sinks

T0 = datetime(2025, 1, 1, 10)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def test_keys(readings_of):
    row = readings_of(reading("P0001", datetime(2025, 1, 1, 0, 0, 1, 999_999))).select(
        reading_key(F.col("patient_id"), F.col("timestamp")).alias("s"),
        reading_key(F.col("patient_id"), F.col("timestamp"), "millisecond").alias("ms"),
    ).withColumn("p", key_patient_id(F.col("s"))).first()
    assert tuple(row) == ("P0001_1735689601", "P0001_1735689601999", "P0001")
    with pytest.raises(ValueError):
        reading_key(F.col("a"), F.col("b"), "day")


def test_last_write_wins_within_a_second(readings_of):
    table = readings_of(reading("P1", at(0.1), 61), reading("P1", at(0.9), 62), reading("P1", at(1), 63), reading("P2", at(0), 64))
    assert sorted(r.heart_rate for r in ops.dedup_readings(table).collect()) == [62, 63, 64]
    assert sorted(r.heart_rate for r in ops.dedup_readings(table, keep="first").collect()) == [61, 63, 64]


def test_load_order_beats_event_time(readings_of):
    early = readings_of(reading("P1", at(0.9), 61)).withColumn("ingested_at", F.lit(at(100)))
    late = readings_of(reading("P1", at(0.1), 62)).withColumn("ingested_at", F.lit(at(200)))
    assert ops.dedup_readings(early.union(late)).first().heart_rate == 62


def test_latest_readings(readings_of):
    table = readings_of(*[reading("P1", at(i), 60 + i) for i in range(7)], reading("P2", at(0), 90))
    rows = {(r.patient_id, r.rn): r.heart_rate for r in ops.latest_readings(table, 3).collect()}
    assert rows == {("P1", 1): 66, ("P1", 2): 65, ("P1", 3): 64, ("P2", 1): 90}
    assert ops.latest_readings(table, patient_id="P1").count() == 7
    assert ops.latest_readings(table, 40).count() == 8


def abnormal_rows(position):
    """Seven readings of P1, newest first, only the one at ``position`` ABNORMAL."""
    return [reading("P1", at(100 - i), 60 + i, "ABNORMAL" if i == position else "NORMAL") for i in range(1, 8)]


def test_only_the_newest_five_are_looked_at(readings_of, profiles_of):
    people = profiles_of(profile("P1", conditions=["Ague"]))
    assert [r.heart_rate for r in ops.abnormal_patients(readings_of(*abnormal_rows(5)), people).collect()] == [65]
    assert ops.abnormal_patients(readings_of(*abnormal_rows(6)), people).count() == 0


def test_newest_abnormal_reading_and_unknown_patient(readings_of, profiles_of):
    table = readings_of(
        reading("P1", at(1), 130, "ABNORMAL"), reading("P1", at(2), 140, "ABNORMAL"), reading("P1", at(3)),
        reading("P9", at(1), 150, "ABNORMAL", systolic=180),
    )
    found = {r.patient_id: r for r in ops.abnormal_patients(table, profiles_of(profile("P1", age=None))).collect()}
    assert found["P1"].heart_rate == 140 and found["P1"].name == "name P1" and found["P1"].age is None
    assert (found["P9"].name, found["P9"].age, found["P9"].conditions, found["P9"].systolic) == ("Unknown", None, [], 180)
    assert found["P9"].temperature == 36.6


def test_time_window(readings_of, profiles_of):
    table = readings_of(reading("P1", at(0), 130, "ABNORMAL"), reading("P2", at(60), 130, "ABNORMAL"))
    recent = ops.abnormal_patients(table, profiles_of(profile("P1")), window_minutes=1, as_of=at(90))
    assert [r.patient_id for r in recent.collect()] == ["P2"]


def test_summary_counts_those_not_shown(readings_of, profiles_of):
    table = readings_of(*[reading(f"P{i:02d}", at(i), 130, "ABNORMAL") for i in range(13)])
    rows = ops.abnormal_summary(table, profiles_of(profile("P00"))).collect()
    assert len(rows) == 10 and {(r.found, r.more) for r in rows} == {(13, 3)}
    assert sorted(r.name for r in rows)[0] == "Unknown"


def test_alerts_limit_before_filter(readings_of):
    table = readings_of(*[reading("P1", at(i), 121 if i % 2 else None, "ABNORMAL" if i < 5 else "NORMAL") for i in range(10)])
    assert tuples(ops.alerts(table, scan=6).select("timestamp", "severity")) == [(at(4), "Medium")]
    assert [r.severity for r in ops.alerts(table, k=3).collect()] == ["Medium", "High", "Medium"]


def test_counters_across_days(readings_of):
    hours = [0, 0, 13, 14, 15, 15, 39]
    table = readings_of(*[reading("P1", at(3600 * h), status="ABNORMAL" if h == 15 else "NORMAL") for h in hours])
    rows = ops.running_totals(table, "1 hour").orderBy("window_start").collect()
    assert [(r.events, r.total, r.total_abnormal, r.abnormal_pct) for r in rows] == [
        (2, 2, 0, 0.0), (1, 3, 0, 0.0), (1, 4, 0, 0.0), (2, 6, 2, 33.3), (1, 7, 2, 28.6)]
    trend = {r.hour: (r.normal, r.abnormal) for r in ops.hourly_trend(table).collect()}
    assert len(trend) == 24 and trend[10] == (2, 0) and trend[1] == (1, 2) and trend[5] == (0, 0)


def test_vital_ranges(readings_of):
    table = readings_of(
        reading("P1", at(0), 60, systolic=90, diastolic=80), reading("P2", at(0), 59, systolic=121, diastolic=81),
        reading("P3", at(0), 101, systolic=100, diastolic=70), reading("P4", at(0), None, systolic=None, diastolic=39),
    )
    assert [r.status for r in ops.classify_vitals(table).orderBy("patient_id").collect()] == ["NORMAL", "ABNORMAL", "NORMAL", "NORMAL"]
    any_out = ops.classify_vitals(table, min_out_of_range=1).orderBy("patient_id").collect()
    assert [r.status for r in any_out] == ["NORMAL", "ABNORMAL", "ABNORMAL", "ABNORMAL"]
    assert [(r.hr_out, r.sys_out, r.dia_out) for r in any_out][3] == (False, False, True)


def test_patients_monitored(readings_of):
    table = readings_of(*[reading(f"P{i % 3}", at(i)) for i in range(9)])
    assert tuples(ops.patients_monitored(table)) == [(3,)] == tuples(ops.patients_monitored(table, approx=True))


@pytest.mark.parametrize("n", [1, 5, 33, 50])
def test_top_n_of_a_hot_key_is_exact(spark, n):
    """One key with most of the rows, and n on both sides of the two-round limit."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id") % 50).alias("k"), (F.col("id") * 7919 % 3001).alias("v"))
    rows = [tuple(r) for r in df.collect()]
    want = set()
    for key in {k for k, _ in rows}:
        want |= {(key, v, i) for i, v in enumerate(sorted((v for k, v in rows if k == key), reverse=True)[:n], 1)}
    got = top_n_per_key(df, ["k"], [F.col("v").desc()], n)
    assert {tuple(r) for r in got.select("k", "v", "rn").collect()} == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ABC"), st.integers(0, 50)), min_size=1, max_size=40), st.integers(1, 6))
def test_latest_n_against_brute_force(spark, rows, n):
    table = spark.createDataFrame(
        [(p, i, at(s), "NORMAL") for i, (p, s) in enumerate(rows)],
        "patient_id string, event_id long, timestamp timestamp, status string")
    want = set()
    for p in "ABC":
        newest = sorted(((s, i) for i, (q, s) in enumerate(rows) if q == p), reverse=True)[:n]
        want |= {(p, i) for _, i in newest}
    assert {(r.patient_id, r.event_id) for r in ops.latest_readings(table, n).collect()} == want


def test_landed_dates_in_any_zone(spark, tmp_path):
    zone, now = spark.conf.get("spark.sql.session.timeZone"), "2025-01-02T00:10:00Z"
    made = spark.sql("SELECT 'P' AS patient_id, timestamp'2025-01-01T23:50:00Z' AS timestamp, 1 AS heart_rate, 'NORMAL' AS status")
    try:
        for writer in ("UTC", "Asia/Tokyo", "Pacific/Kiritimati", "Pacific/Midway"):
            spark.conf.set("spark.sql.session.timeZone", writer)
            path = str(tmp_path / writer.replace("/", "-"))
            sinks.append_readings(made, path)
            for reader in ("UTC", "Asia/Tokyo", "Pacific/Kiritimati", "Pacific/Midway"):
                spark.conf.set("spark.sql.session.timeZone", reader)
                recent = ops.within_minutes(spark.read.parquet(path), 30, F.expr(f"timestamp'{now}'"))
                assert recent.count() == 1, (writer, reader)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_readings_without_time_are_counted(readings_of):
    counts = ops.cycle_counts(readings_of(reading("P", None), reading("P", None, status="ABNORMAL"), reading("P", datetime(2025, 1, 1))))
    assert {(r.window_start is None, r.events, r.abnormal) for r in counts.collect()} == {(True, 2, 1), (False, 1, 0)}
    totals = ops.running_totals(readings_of(reading("P", None), reading("P", datetime(2025, 1, 1))))
    assert sorted(r.total for r in totals.collect()) == [1, 2]


def test_rounds_over_groups_of_tasks(spark, monkeypatch):
    """All rows are one patient's, in 300 parts of which 16 meet at a time: no group ranks more than 16 times n rows."""
    monkeypatch.setattr(skew, "MEETING_ROWS", 50)
    monkeypatch.setattr(skew, "FAN_IN", 16)
    monkeypatch.setattr(skew, "_map_tasks", lambda df: 300)
    rows = spark.range(6000).repartition(300).selectExpr("'hot' || id DIV 10000 AS patient_id", "hash(id) AS v", "id")
    top = skew.top_n_per_key(rows, ["patient_id"], [F.col("v").desc(), F.col("id")], 5)
    want = sorted((r.v, -r.id) for r in rows.collect())[::-1][:5]
    assert [(r.v, -r.id) for r in top.orderBy("rn").collect()] == want
    assert top.columns == ["patient_id", "v", "id", "rn"]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SPARK_PARTITION_ID") >= 1 and plan.count("WindowGroupLimit") >= 6  # 300 parts: 19 groups, 2 groups, the key


def test_small_tables_take_one_round(spark):
    plan = skew.top_n_per_key(spark.range(10).selectExpr("id", "id AS k"), ["k"], [F.col("id")], 5)
    assert "SPARK_PARTITION_ID" not in plan._jdf.queryExecution().executedPlan().toString()


def test_cycle_counts_scan_once(spark, tmp_path):
    spark.createDataFrame([("A", None, "NORMAL")], "patient_id string, timestamp timestamp_ntz, status string").write.parquet(str(tmp_path / "r"))
    readings = spark.read.parquet(str(tmp_path / "r"))
    for df in (ops.cycle_counts(readings), ops.running_totals(readings)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parquet") <= (1 if df.columns[-1] == "abnormal" else 2)
