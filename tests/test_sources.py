import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import profile, reading, tuples
from pulsegrid import sources as src
from pulsegrid.operators import dedup_readings, within_minutes
from pulsegrid.schemas import PROFILE_SCHEMA
from pulsegrid.session import scratch_path


def test_profiles_from_json_lines(spark, tmp_path):
    good = {"patient_id": "P1", "age": 30, "contact": {"city": "Oslen"}, "medical_history": {"conditions": []},
            "admission_date": "2025-03-09T08:15:27.250300", "extra": 1}
    no_fraction = {"patient_id": "P2", "admission_date": "2025-03-09T08:15:27"}
    no_id, bad_age = {"age": 70}, {"patient_id": "P3", "age": "old", "gender": "M"}
    lines = [json.dumps(d) for d in (good, no_fraction, no_id, bad_age)]
    (tmp_path / "p.json").write_text("\n".join([*lines, "{broken", ""]))
    profiles = src.read_profiles(spark, str(tmp_path))
    assert profiles.schema == PROFILE_SCHEMA
    rows = {r.patient_id: r for r in profiles.collect()}
    assert rows["P1"].admission_date == datetime(2025, 3, 9, 8, 15, 27, 250300) and rows["P1"].contact.city == "Oslen"
    assert rows["P1"].risk_score is None and rows["P2"].admission_date == datetime(2025, 3, 9, 8, 15, 27)
    assert profiles.count() == 4 and rows[None].age == 70
    assert rows["P3"].age is None and rows["P3"].gender == "M"
    assert [r.line for r in src.corrupt_lines(spark, str(tmp_path)).collect()] == [lines[3], "{broken"]


def test_export_drops_the_store_id_and_keeps_microseconds(spark, profiles_of, tmp_path):
    people = profiles_of(profile("P1", admitted=datetime(2025, 1, 2, 3, 4, 5, 678901), conditions=["Ague"]))
    src.export_profiles(people.withColumn("_id", F.lit("x")), str(tmp_path / "out"))
    assert "_id" not in spark.read.json(str(tmp_path / "out")).columns
    assert tuples(src.read_profiles(spark, str(tmp_path / "out"))) == tuples(people)


def test_key_value_dump(spark):
    dump = spark.createDataFrame([
        ("P0001_1735689600", '{"heart_rate": 61, "blood_pressure": {"systolic": 100, "diastolic": 70}, "status": "NORMAL"}'),
        ("P0002_1735689600123", '{"patient_id": "P0002", "timestamp": "2025-01-01T00:00:00.123000", "temperature": 36.5}'),
        ("P0003_1", "not json"),
    ], "key string, value string")
    rows = {r.patient_id: r for r in src.import_key_values(dump).collect()}
    assert tuples(src.rejected_key_values(dump)) == [("P0003_1", "not json")]
    assert set(rows) == {"P0001", "P0002"}
    assert rows["P0001"].blood_pressure.systolic == 100 and rows["P0002"].temperature == 36.5


def test_appended_readings(spark, readings_of, tmp_path):
    path = str(tmp_path / "readings")
    src.append_readings(readings_of(reading("P1", datetime(2025, 1, 1), 61), reading("P1", datetime(2025, 1, 2), 62)), path)
    src.append_readings(readings_of(reading("P1", datetime(2025, 1, 1), 99)), path)
    table = src.read_landed_readings(spark, path)
    assert sorted(r.heart_rate for r in dedup_readings(table).collect()) == [62, 99]
    recent = within_minutes(table, 60, datetime(2025, 1, 2, 0, 30))
    assert [r.heart_rate for r in recent.collect()] == [62]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_versions(spark, profiles_of, tmp_path):
    root = str(tmp_path / "profiles")
    assert src.current_version(spark, root) == (0, -1)
    with pytest.raises(ValueError):
        src.read_published(spark, root)
    src.publish_version(profiles_of(profile("P1")), root)
    # A writer that died before logging its version leaves a directory that nobody reads.
    profiles_of(profile("P8")).write.parquet(f"{root}/v=00000002-died")
    assert [r.patient_id for r in src.read_published(spark, root).collect()] == ["P1"]
    assert src.publish_version(profiles_of(profile("P2")), root, batch_id=4) == 2
    assert [r.patient_id for r in src.read_published(spark, root).collect()] == ["P2"]
    assert src.current_version(spark, root) == (2, 4)


def test_replace_and_land(spark, profiles_of, tmp_path):
    path = str(tmp_path / "table")
    src.replace_profiles(profiles_of(profile("P1"), profile("P2")), path)
    src.replace_profiles(profiles_of(profile("P3")), path)
    assert src.read_published(spark, path).count() == 1
    src.land_parquet(profiles_of(profile("P1", gender="M"), profile("P2")), str(tmp_path / "landed"), "gender")
    assert (tmp_path / "landed" / "gender=M").is_dir()


def test_scratch_is_below_the_shared_folder(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert scratch_path(spark, "x").startswith(before + "/")


def test_nested_pruning_and_pushdown(spark, profiles_of, tmp_path):
    path = str(tmp_path / "p")
    src.land_parquet(profiles_of(profile("P1")), path)
    profiles = src.read_profiles(spark, path, "parquet").filter("risk_score >= 7")
    plan = profiles.groupBy("contact.city").count()._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(risk_score,7)" in plan
    assert "contact:struct<city:string>" in plan and "notes" not in plan
