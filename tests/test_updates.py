from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import profile, tuples
from pulsegrid.operators import apply_profile_patches, apply_risk_updates, split_history, with_recent_history
from pulsegrid.operators.skew import NOT_SPLIT, with_parts
from pulsegrid.schemas import PATCH_SCHEMA, RISK_UPDATE_SCHEMA

T0 = datetime(2025, 1, 1)


@pytest.fixture
def updates_of(spark):
    """Updates from (patient, score, minute), numbered in the order given."""

    def make(*rows):
        data = [(p, score, T0 + timedelta(minutes=m), i) for i, (p, score, m) in enumerate(rows)]
        return spark.createDataFrame(data, RISK_UPDATE_SCHEMA)

    return make


@pytest.fixture
def patches_of(spark):
    return lambda *rows: spark.createDataFrame([(p, path, v, i) for i, (p, path, v) in enumerate(rows)], PATCH_SCHEMA)


def audit_of(result):
    return [tuple(r) for r in result.audit.orderBy("seq").select(
        "patient_id", "previous_score", "score", "delta", "direction", "old_level", "new_level", "status").collect()]


def test_risk_updates(profiles_of, updates_of):
    people = profiles_of(profile("P1", risk=5), profile("P2", risk=None), profile("P3", risk=2))
    result = apply_risk_updates(people, updates_of(("P1", 8, 1), ("P1", 8, 2), ("P2", 3, 1), ("P9", 4, 1), ("P1", None, 3), ("P1", 6, 4)))
    assert audit_of(result) == [
        ("P1", 5, 8, 3, "INCREASED", "MEDIUM", "HIGH", "updated"),
        ("P1", 8, 8, 0, "No change", "HIGH", "HIGH", "updated"),
        ("P2", 0, 3, 3, "INCREASED", "LOW", "LOW", "updated"),
        ("P9", None, 4, None, None, None, "MEDIUM", "not_found"),
        ("P1", 8, None, None, None, "HIGH", None, "invalid"),
        ("P1", 8, 6, -2, "DECREASED", "HIGH", "MEDIUM", "updated"),
    ]
    after = {r.patient_id: (r.risk_score, r.risk_score_updated) for r in result.profiles.collect()}
    assert after == {"P1": (6, T0 + timedelta(minutes=4)), "P2": (3, T0 + timedelta(minutes=1)), "P3": (2, None)}
    assert result.history.count() == 4


def test_skip_unchanged(profiles_of, updates_of):
    people = profiles_of(profile("P1", risk=5))
    updates = updates_of(("P1", 5, 1), ("P1", 7, 2), ("P1", 7, 3))
    result = apply_risk_updates(people, updates, skip_unchanged=True)
    assert [r[-1] for r in audit_of(result)] == ["unchanged", "updated", "unchanged"]
    row = result.profiles.first()
    assert (row.risk_score, row.risk_score_updated) == (7, T0 + timedelta(minutes=2))
    assert [(r.previous_score, r.score) for r in result.history.collect()] == [(5, 7)]


def test_updates_apply_in_time_order_not_arrival_order(profiles_of, updates_of):
    result = apply_risk_updates(profiles_of(profile("P1", risk=1)), updates_of(("P1", 9, 5), ("P1", 3, 2)))
    assert [(r[1], r[2]) for r in audit_of(result)] == [(3, 9), (1, 3)]
    assert result.profiles.first().risk_score == 9


def test_an_update_without_patient_is_not_found(profiles_of, updates_of):
    result = apply_risk_updates(profiles_of(profile("P1")), updates_of((None, 3, 1), (None, 4, 2)), parts=2)
    assert [r[-1] for r in audit_of(result)] == ["not_found", "not_found"]


@pytest.mark.parametrize("parts", [1, 2])
def test_an_update_without_time_comes_first(profiles_of, updates_of, parts):
    updates = updates_of(("P1", 3, 1), ("P1", 9, 2)).selectExpr(
        "patient_id", "score", "IF(score = 9, NULL, ts) AS ts", "seq")
    result = apply_risk_updates(profiles_of(profile("P1", risk=5)), updates, parts=parts)
    assert [(r[1], r[2]) for r in audit_of(result)] == [(9, 3), (5, 9)]
    assert result.profiles.first().risk_score == 3


def test_embedded_history_moves_to_the_table(profiles_of, updates_of):
    entries = [{"score": 4, "timestamp": T0 - timedelta(days=2), "previous_score": 2},
               {"score": 5, "timestamp": T0 - timedelta(days=1), "previous_score": 4}]
    people = profiles_of(profile("P1", risk=5, risk_score_history=entries))
    result = apply_risk_updates(people, updates_of(("P1", 6, 1), ("P1", 7, 2)))
    assert "risk_score_history" not in result.profiles.columns
    chain = [(r.previous_score, r.score) for r in result.history.orderBy("timestamp", "seq").collect()]
    assert chain == [(2, 4), (4, 5), (5, 6), (6, 7)]
    recent = with_recent_history(result.profiles, result.history, 3).first().risk_score_history
    assert [(e.previous_score, e.score) for e in recent] == [(4, 5), (5, 6), (6, 7)]
    assert split_history(people)[1].count() == 2


def chained(rows, start):
    """Brute force: previous scores of one patient's (score, minute) updates in time order."""
    out, current = [], start
    for score, minute, seq in sorted(((s, m, i) for i, (s, m) in enumerate(rows)), key=lambda r: r[1:]):
        out.append((seq, current, score))
        current = score
    return sorted(out)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 10), st.integers(0, 12)), min_size=1, max_size=25), st.booleans())
def test_previous_scores_against_brute_force(profiles_of, updates_of, rows, hot):
    """Both for an ordinary patient and for a hot one, which is cut into ranges."""
    options = {"parts": 6} if hot else {}
    result = apply_risk_updates(profiles_of(profile("P1", risk=5)), updates_of(*[("P1", s, m) for s, m in rows]), **options)
    got = sorted((r.seq, r.previous_score, r.score) for r in result.audit.collect())
    assert got == chained(rows, 5)
    history = result.history.orderBy("timestamp", "seq").collect()
    assert all(b.previous_score == a.score for a, b in zip(history, history[1:]))
    assert result.profiles.first().risk_score == history[-1].score


def statuses(result):
    return [(r.path, r.old, r.new, r.status) for r in result.audit.orderBy("seq").collect()]


def test_patches(profiles_of, patches_of):
    people = profiles_of(profile("P1", age=40, conditions=["Ague"], notes="a"), profile("P2", contact=None))
    result = apply_profile_patches(people, patches_of(
        ("P1", "contact.phone", "06"), ("P1", "contact.phone", "06"), ("P1", "age", "40"), ("P1", "age", "x"),
        ("P1", "notes", None), ("P9", "notes", "b"), ("P1", "contact.fax", "1"), ("P1", "patient_id", "P7"),
        ("P1", "medical_history.conditions", '["Ague", "Anglewort"]'), ("P2", "contact.city", "Oslen"),
        ("P2", "contact.email", None), ("P1", "admission_date", "2025-01-02T03:04:05.600")))
    assert statuses(result) == [
        ("contact.phone", "05", "06", "updated"), ("contact.phone", "06", "06", "unchanged"),
        ("age", "40", "40", "unchanged"), ("age", "40", "x", "invalid"), ("notes", "a", None, "updated"),
        ("notes", None, "b", "not_found"), ("contact.fax", None, "1", "invalid"), ("patient_id", None, "P7", "invalid"),
        ("medical_history.conditions", '["Ague"]', '["Ague","Anglewort"]', "updated"),
        ("contact.city", None, "Oslen", "updated"), ("contact.email", None, None, "unchanged"),
        ("admission_date", None, "2025-01-02 03:04:05.6", "updated"),
    ]
    after = {r.patient_id: r for r in result.profiles.collect()}
    p1, p2 = after["P1"], after["P2"]
    assert (p1.contact.phone, p1.contact.city, p1.age, p1.notes) == ("06", "Oslen", 40, None)
    assert p1.medical_history.conditions == ["Ague", "Anglewort"] and p1.medical_history.blood_type == "A+"
    assert p1.admission_date == datetime(2025, 1, 2, 3, 4, 5, 600_000)
    assert p2.contact.city == "Oslen" and p2.contact.phone is None
    assert result.profiles.schema.simpleString() == people.schema.simpleString()


def test_replaying_patches_changes_nothing(profiles_of, patches_of):
    patches = patches_of(("P1", "notes", "x"), ("P1", "age", "41"))
    once = apply_profile_patches(profiles_of(profile("P1"), profile("P2")), patches).profiles
    again = apply_profile_patches(once, patches)
    assert {s[-1] for s in statuses(again)} == {"unchanged"}
    assert sorted(tuples(again.profiles), key=str) == sorted(tuples(once), key=str)


def test_no_patches_leave_profiles_alone(profiles_of, patches_of):
    people = profiles_of(profile("P1"), profile("P2", contact=None, history=None))
    result = apply_profile_patches(people, patches_of())
    assert sorted(tuples(result.profiles)) == sorted(tuples(people)) and result.audit.count() == 0


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "b", None]), min_size=1, max_size=12))
def test_old_values_of_a_hot_patient(profiles_of, patches_of, values):
    result = apply_profile_patches(
        profiles_of(profile("P1", notes="start")), patches_of(*[("P1", "notes", v) for v in values]),
        parts=4)
    before = ["start", *values[:-1]]
    assert statuses(result) == [
        ("notes", old, new, "unchanged" if old == new else "updated") for old, new in zip(before, values)]
    assert result.profiles.first().notes == values[-1]


def test_equal_times_and_numbers_end_alike(spark, profiles_of):
    updates = spark.createDataFrame([("P1", score, T0, 7) for score in (3, 9, 6)], RISK_UPDATE_SCHEMA)
    result = apply_risk_updates(profiles_of(profile("P1", risk=5)), updates)
    assert sorted((r.previous_score, r.score) for r in result.audit.collect()) == [(3, 6), (5, 3), (6, 9)]
    assert result.profiles.first().risk_score == 9
    patches = spark.createDataFrame([("P1", "contact.city", v, 7) for v in ("Lima", "Oslo", "Bern")], PATCH_SCHEMA)
    result = apply_profile_patches(profiles_of(profile("P1", city="Oslen")), patches)
    assert sorted((r.old, r.new) for r in result.audit.collect()) == [("Bern", "Lima"), ("Lima", "Oslo"), ("Oslen", "Bern")]
    assert result.profiles.first().contact.city == "Oslo"


def test_a_patient_with_all_updates_at_one_time_is_cut_evenly(spark, profiles_of):
    updates = spark.range(4000).select(
        F.lit("P1").alias("patient_id"), (F.col("id") % 10).cast("int").alias("score"), F.lit(T0).alias("ts"), F.col("id").alias("seq"))
    parted = with_parts(updates, "patient_id", ["ts", "seq", "score"], 8)
    sizes = [r["count"] for r in parted.groupBy("part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000
    result = apply_risk_updates(profiles_of(profile("P1", risk=5)), updates, parts=8)
    rows = result.audit.orderBy("seq").collect()
    assert [r.previous_score for r in rows] == [5, *[r.score for r in rows[:-1]]]
    assert result.profiles.first().risk_score == 9


def test_only_patients_in_several_ranges_are_cut(spark):
    updates = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit("P0")).otherwise(F.concat(F.lit("P"), F.col("id"))).alias("patient_id"), "id")
    cut = with_parts(updates, "patient_id", ["id"], 6).filter(F.col("part") != NOT_SPLIT)
    assert [r[0] for r in cut.select("patient_id").distinct().collect()] == ["P0"] and cut.count() == 1000


def test_updates_are_not_sorted_for_aggregates(spark, profiles_of, updates_of, patches_of):
    people = profiles_of(profile("P1"))
    for result in (apply_risk_updates(people, updates_of(("P1", 3, 1))), apply_profile_patches(people, patches_of(("P1", "notes", "x")))):
        for df in (result.profiles, result.audit):
            assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_small_tables_are_one_range_and_large_ones_are_cut(spark, tmp_path, profiles_of, monkeypatch):
    """The same answers with the ranges written and without; only small tables do without."""
    from pulsegrid.operators import updates as module

    spark.range(300).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('P', id % 7)) AS patient_id", "CAST(id % 11 AS int) AS score",
        f"timestamp_ntz'{datetime(2025, 1, 1)}' + make_interval(0, 0, 0, 0, 0, CAST(id DIV 4 AS int)) AS ts", "id AS seq").write.parquet(str(tmp_path / "u"))
    asked = spark.read.parquet(str(tmp_path / "u")).repartition(4)
    people = profiles_of(profile("hot", risk=1), *[profile(f"P{i}", risk=2) for i in range(5)])
    seen = []
    for small in (module.SMALL_BYTES, 0):
        monkeypatch.setattr(module, "SMALL_BYTES", small)
        result = module.apply_risk_updates(people, asked, parts_path=str(tmp_path / f"parts{small}"))
        seen.append([sorted(map(str, df.collect())) for df in (result.audit, result.history, result.profiles)])
        assert (tmp_path / f"parts{small}").exists() == (small == 0)
    assert seen[0] == seen[1] and len(seen[0][0]) == 300
