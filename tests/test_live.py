"""Tables of the live feed: concurrent writers, bounded logs, sketches, totals, retractions, compaction, rejects."""

import glob
import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import profile, tuples
from pulsegrid import operators as ops
from pulsegrid import streaming as st
from pulsegrid.plans import batch, save_batch
from pulsegrid.sources import NumberedLog, current_version, parse_counts, publish_version, read_published, read_result, stream_readings
from pulsegrid.streaming import commits, ingest, sinks
from test_streaming import EVENT, T0, Feed, feed, paths, rows, run, three_batches  # noqa: F401


def as_stream(spark, monkeypatch, name):
    monkeypatch.setattr(commits, "stream_id", lambda _: name)


def test_two_writers_keep_all_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    frame = lambda *v: spark.createDataFrame([(x,) for x in v], "v string")
    as_stream(spark, monkeypatch, "two")
    seen = []

    def slow(last):
        """Stream two is at work on its commit when stream one makes one."""
        seen.append(last)
        if len(seen) == 1:
            as_stream(spark, monkeypatch, "one")
            assert commits.commit(spark, path, 0, lambda _: frame("A")) == 0
            as_stream(spark, monkeypatch, "two")
        return frame("B")

    assert commits.commit(spark, path, 0, slow) == 1 and seen == [-1, 0]
    as_stream(spark, monkeypatch, "one")
    assert commits.commit(spark, path, 1, lambda _: frame("C")) == 2
    assert commits.commit(spark, path, 0, lambda _: frame("again")) is None
    as_stream(spark, monkeypatch, "two")
    assert commits.commit(spark, path, 0, lambda _: frame("again")) is None
    assert rows(commits.read_commits(spark, path, -1), "v", "commit") == [("A", 0), ("B", 1), ("C", 2)]


def test_an_entry_without_content_is_void(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pulsegrid.sources.log.PATIENCE", 0.2)
    log = NumberedLog(spark, str(tmp_path / "log"))
    assert log.last() == (0, {}) and log.numbers() == []
    assert log.add(1, {"a": 1}) and not log.add(1, {"a": 2})
    (tmp_path / "log" / f"{2:012d}").write_text("")  # its writer died
    assert log.read(2) is None and log.last() == (2, {"a": 1})
    assert log.append({"a": 3}) == 3 and log.last() == (3, {"a": 3})


def test_logs_stay_short(spark, tmp_path, monkeypatch):
    """After 200 commits a micro-batch lists and opens the files of a few publications at most."""
    path = str(tmp_path / "t")
    as_stream(spark, monkeypatch, "s")
    opened = []
    read = NumberedLog.read
    monkeypatch.setattr(NumberedLog, "read", lambda log, n: opened.append(n) or read(log, n))
    for n in range(200):
        opened.clear()
        sinks.write_batch(spark, path, n, lambda _: spark.range(1).selectExpr(f"{n % 7} AS k", f"{n} AS v"), ["k"], 10)
    assert len(opened) <= 25
    assert len(NumberedLog(spark, f"{path}/changes/_commits").numbers()) <= 20 and len(glob.glob(f"{path}/changes/commit=*")) <= 20
    assert len(glob.glob(f"{path}/v=*")) == 2
    assert rows(st.latest_changes(spark, path, ["k"]), "k", "v") == sorted((n % 7, n) for n in range(193, 200))


def risk_feed(spark, tmp_path, name, *updates):
    folder = tmp_path / name
    folder.mkdir(exist_ok=True)
    for i, (patient, score) in enumerate(updates):
        n = len(list(folder.iterdir()))
        (folder / f"{n:03d}.json").write_text(
            f'{{"patient_id": "{patient}", "score": {score}, "ts": "2025-01-01T00:{n:02d}:00", "seq": {n}}}')
    return stream_readings(spark, str(folder), max_files=1, schema="patient_id string, score int, ts timestamp_ntz, seq long")


def test_a_load_beside_a_stream_replaces_what_it_did(spark, tmp_path, profiles_of):
    root, history, checkpoint = (str(tmp_path / d) for d in ("profiles", "history", "checkpoint"))
    publish_version(profiles_of(profile("A", risk=5), profile("B", risk=1)), root)
    run(st.start_risk_updates(risk_feed(spark, tmp_path, "in", ("A", 9), ("B", 8)), root, history, checkpoint))
    publish_version(profiles_of(profile("A", risk=2), profile("B", risk=1)), root)
    assert rows(st.read_live_profiles(spark, root, history), "patient_id", "risk_score") == [("A", 2), ("B", 1)]
    run(st.start_risk_updates(risk_feed(spark, tmp_path, "in", ("B", 7)), root, history, checkpoint))
    assert rows(st.read_live_profiles(spark, root, history), "patient_id", "risk_score") == [("A", 2), ("B", 7)]
    assert rows(st.read_risk_history(spark, history), "patient_id", "previous_score", "score") == [("A", 5, 9), ("B", 1, 7), ("B", 1, 8)]


@pytest.mark.parametrize("publish_every", [2, 100])
def test_live_overview_equals_overview(publish_every, spark, tmp_path, profiles_of):
    root, history, checkpoint = (str(tmp_path / d) for d in ("profiles", "history", "checkpoint"))
    people = [profile(p, age=a, risk=r, admitted=T0 - timedelta(days=d)) for p, a, r, d in
              (("A", 30, 5, 1), ("B", None, 9, 100), ("C", 71, None, 2), ("D", 40, 7, 3))]
    publish_version(profiles_of(*people), root)
    assert tuples(st.read_live_overview(spark, root, history, T0)) == tuples(ops.overview(profiles_of(*people), T0))
    updates = [("A", 9), ("A", 8), ("B", 1), ("C", 7), ("Z", 9), ("D", 7), ("A", 3)]
    run(st.start_risk_updates(risk_feed(spark, tmp_path, "in", *updates), root, history, checkpoint, publish_every=publish_every))
    live = st.read_live_profiles(spark, root, history)
    got = st.read_live_overview(spark, root, history, T0)
    assert tuples(got) == tuples(ops.overview(live, T0)) == [(4, 2, 47.0, 3)]
    assert "contact" not in got._jdf.queryExecution().executedPlan().toString()


def test_a_micro_batch_opens_its_buckets(spark, tmp_path, profiles_of):
    root = str(tmp_path / "p")
    publish_version(profiles_of(*[profile(f"P{i}") for i in range(64)]), root, bucket_by=("patient_id", 16))
    asked = spark.createDataFrame([("P3",), ("P4",)], "patient_id string")
    some = read_published(spark, root, asked)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan and len(some.inputFiles()) == 16
    assert {"P3", "P4"} <= {r.patient_id for r in some.collect()} and some.count() < 30
    assert read_published(spark, root).count() == 64 and "_bucket" not in some.columns


def test_patients_monitored(spark, feed, paths):
    three_batches(feed)
    go = lambda: run(st.start_patients_monitored(feed.stream(), *paths, width="5 seconds", publish_every=2))
    go()
    before = {r.window_start: r.patients for r in st.read_patients_monitored(spark, paths[0]).collect()}
    feed.send(("Q", 1, 70, "NORMAL"), (None, 1, 70, "NORMAL"))  # late: only its own window changes
    go()
    after = {r.window_start: r.patients for r in st.read_patients_monitored(spark, paths[0]).collect()}
    assert before == {T0: 2, T0 + timedelta(seconds=5): 2, T0 + timedelta(seconds=10): 1}
    assert after == {**before, T0: 3}
    whole = lambda **k: st.read_patients_monitored(spark, paths[0], whole=True, **k).first().patients
    assert (whole(), whole(since=T0 + timedelta(seconds=5)), whole(until=T0)) == (4, 2, 0)


def test_many_patients_are_counted_within_the_error(spark, tmp_path):
    spark.range(60_000).selectExpr("CAST(id % 30000 AS STRING) AS patient_id", f"timestamp'{T0}' AS timestamp").write.json(str(tmp_path / "in"))
    stream = stream_readings(spark, str(tmp_path / "in"), schema="patient_id string, timestamp timestamp")
    out = str(tmp_path / "out")
    run(st.start_patients_monitored(stream, out, str(tmp_path / "c"), lg_k=12))
    assert abs(st.read_patients_monitored(spark, out).first().patients / 30_000 - 1) < 4 * 1.04 / 64


@pytest.mark.parametrize("publish_every", [1, 100])
def test_running_totals_over_late_rows_and_a_restart(publish_every, spark, feed, paths):
    three_batches(feed)
    feed.send(("A", 90_000, 70, "NORMAL"), ("B", 200_000, 70, "ABNORMAL"))
    go = lambda: run(st.start_running_totals(feed.stream(), *paths, publish_every=publish_every))
    go()
    feed.send(("A", 90_001, 70, "ABNORMAL"), ("C", 2, 70, "ABNORMAL"))
    go()
    columns = ("window_start", "events", "abnormal", "total", "total_abnormal", "abnormal_pct")
    assert rows(st.read_running_totals(spark, paths[0]), *columns) == rows(ops.running_totals(feed.batch()), *columns)
    last = commits.read_commits(spark, f"{paths[0]}/changes", commits.last_commit(spark, f"{paths[0]}/changes") - 1)
    assert {r.day for r in last.collect()} == {date(2025, 1, 1), date(2025, 1, 2)}  # the third day is not written again


@pytest.mark.parametrize("publish_every", [1, 2, 100])
def test_abnormal_patients_come_and_go(publish_every, spark, feed, paths, profiles_of):
    people = profiles_of(profile("A", age=50, conditions=["Gout"]), profile("B"))
    columns = ("patient_id", "name", "age", "heart_rate", "systolic", "timestamp")

    def check():
        run(st.start_abnormal_patients(feed.stream(), *paths, n=2, publish_every=publish_every))
        got = rows(st.read_abnormal_patients(spark, paths[0], people), *columns)
        assert got == rows(ops.abnormal_patients(feed.batch(), people, 2), *columns)
        return {r[0] for r in got}

    three_batches(feed)
    assert check() == {"B", "C"}
    feed.send(("B", 20, 70, "NORMAL"), ("A", 20, 140, "ABNORMAL"))
    assert check() == {"A", "B", "C"}
    feed.send(("B", 21, 70, "NORMAL"), ("C", 1, 70, "NORMAL"))  # pushes B's abnormal one out; C's stays among the newest
    assert check() == {"A", "C"}
    feed.send(("B", 4, 150, "ABNORMAL"), ("C", 2, 70, "NORMAL"))  # late, not among the newest
    assert check() == {"A", "C"}
    answers = f"{paths[0]}/answers/changes"
    if publish_every == 100:
        gone = commits.read_commits(spark, answers, -1).filter("deleted")
        assert sorted(r.patient_id for r in gone.collect()) == ["A", "B"]
        assert commits.read_commits(spark, answers, commits.last_commit(spark, answers) - 1).count() == 0


def test_alerts_take_the_profiles_in_force(spark, feed, paths, tmp_path, profiles_of):
    root, history = str(tmp_path / "profiles"), str(tmp_path / "history")
    publish_version(profiles_of(profile("A", name="first")), root)
    feed.send(("A", 1, 130, "ABNORMAL"))
    go = lambda: run(st.start_alerts(feed.stream(), root, *paths, history_path=history, fold_every=2))
    go()
    publish_version(profiles_of(profile("A", name="second")), root)
    feed.send(("A", 2, 130, "ABNORMAL"), ("A", 3, 70, "NORMAL"))
    feed.send(("B", 2, 130, "ABNORMAL"))
    go()
    assert rows(st.read_alerts(spark, paths[0]), "event_id", "name") == [(0, "first"), (1, "second"), (3, "Unknown")]


def test_compaction_keeps_answers_and_readers(spark, feed, paths, monkeypatch):
    monkeypatch.setattr(ingest, "FILE_ROWS", 10)
    for n in range(6):
        feed.send(*[("A", n * 10 + i, 70 + i, "NORMAL") for i in range(4)], ("B", 5, 80 + n, "NORMAL"), ("C", 86_400, n, "NORMAL"))
    go = lambda: run(st.start_ingest(feed.stream(), *paths))
    go()
    columns = ("patient_id", "timestamp", "event_id", "heart_rate")
    answer = lambda df: rows(ops.dedup_readings(df), *columns)
    reader = st.read_ingested(spark, paths[0])
    want = answer(reader)
    assert reader.count() == 36 and len(reader.inputFiles()) >= 6
    assert st.compact_ingested(spark, paths[0]) == 2
    assert answer(reader) == want  # one that began before
    compacted = st.read_ingested(spark, paths[0])
    assert answer(compacted) == want and compacted.count() == 24 + 1 + 1
    sizes = {d: len(list(f)) for d, f in _files_by_date(compacted.inputFiles())}
    assert sizes["2025-01-01"] <= 36 // 10 + 1 and sizes["2025-01-02"] == 1
    assert st.compact_ingested(spark, paths[0]) == 0
    feed.send(("B", 5, 99, "NORMAL"), ("D", 7, 60, "NORMAL"))
    go()
    want = answer(st.read_ingested(spark, paths[0]))
    assert ("B", T0 + timedelta(seconds=5), 36, 99.0) in want
    second = st.read_ingested(spark, paths[0], since=date(2025, 1, 2))
    assert all("event_date=2025-01-01" not in f for f in second.inputFiles()) and [r.patient_id for r in second.collect()] == ["C"]
    assert st.compact_ingested(spark, paths[0]) == 1  # one date is written again
    assert answer(st.read_ingested(spark, paths[0])) == want
    assert st.read_ingested(spark, paths[0], until=date(2025, 1, 1)).count() == 26


def _files_by_date(files):
    dates = sorted(f.split("event_date=")[1].split("/")[0] for f in files)
    return [(d, [x for x in dates if x == d]) for d in set(dates)]


def test_rejects_come_from_the_same_read(spark, feed, paths):
    three_batches(feed)  # each file ends in a broken line
    (feed.path / "0003.json").write_text('{"patient_id": "E", "event_id": 9, "heart_rate": "fast"}')
    stream = stream_readings(spark, str(feed.path), max_files=1, schema=EVENT, with_rejects=True)
    query = run(st.start_ingest(stream, *paths))
    assert st.read_ingested(spark, paths[0]).count() == 8
    assert sorted(r.line for r in st.read_rejected(spark, paths[0]).collect()) == sorted(
        ["{broken"] * 3 + ['{"patient_id": "E", "event_id": 9, "heart_rate": "fast"}'])
    seen = parse_counts(query)
    assert sum(c["rejects"] for c in seen) == 4 and sum(c["lines"] for c in seen) == 11


def test_a_run_that_dies_leaves_the_last_whole_set(spark, tmp_path, profiles_of, monkeypatch):
    path = str(tmp_path / "results")
    assert tuples(read_result(spark, path, name="risk_summary"))[0][0] == "no_results"
    save_batch(profiles_of(profile("A", risk=9)), path, T0)
    write, done = batch.write_result, []

    def dies(df, folder, name, *rest):
        done.append(name)
        if len(done) == 4:
            raise OSError("the job is killed")
        return write(df, folder, name, *rest)

    monkeypatch.setattr(batch, "write_result", dies)
    with pytest.raises(OSError):
        save_batch(profiles_of(profile("A", risk=1), profile("B", risk=2)), path, T0)
    summary = lambda: tuples(read_result(spark, path, name="risk_summary"))
    assert summary() == [(9.0, 1, 0, 0)] and read_result(spark, path, name="age_groups").count() > 0
    monkeypatch.setattr(batch, "write_result", write)
    for risk in (4, 5, 6):
        save_batch(profiles_of(profile("A", risk=risk)), path, T0)
    assert summary() == [(6.0, 0, 1, 0)]
    assert tuples(read_result(spark, path, name="unheard_of"))[0][0] == "no_results"
    kept = [f for f in os.listdir(path) if f.startswith("set=")]
    assert len(kept) == 3  # the last two, and what the killed run left


def test_a_profile_table_is_replaced_as_a_whole(spark, tmp_path, profiles_of):
    from pulsegrid.sources import replace_profiles
    root = str(tmp_path / "p")
    replace_profiles(profiles_of(profile("A")), root)
    reader = read_published(spark, root)
    with pytest.raises(Exception):
        replace_profiles(reader.withColumn("x", F.raise_error(F.lit("dies"))), root)
    assert current_version(spark, root)[0] == 1 and read_published(spark, root).count() == 1
    replace_profiles(reader.unionByName(profiles_of(profile("B"))), root)  # read from the table itself
    assert reader.count() == 1 and read_published(spark, root).count() == 2
