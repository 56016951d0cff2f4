"""Streams over files that arrive one after another: batch results, restarts and late rows."""

import json
import os
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import profile
from pulsegrid import operators as ops
from pulsegrid import streaming as st
from pulsegrid.schemas import RISK_UPDATE_SCHEMA
from pulsegrid.catalog import QUERIES, stream_queries
from pulsegrid.sources import current_version, publish_version, read_published, stream_readings
from pulsegrid.sources.star import TABLES
from pulsegrid.streaming import feeds, sinks

T0 = datetime(2025, 1, 1, 10)
EVENT = "patient_id string, event_id long, timestamp timestamp, heart_rate double, blood_pressure struct<systolic:int,diastolic:int>, status string"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Feed:
    """A folder of JSON files, each one micro-batch."""

    def __init__(self, spark, root):
        self.spark, self.path, self.files, self.next_id, self.sent = spark, root / "in", 0, 0, []
        self.path.mkdir()

    def send(self, *rows):
        """Rows of (patient, seconds, heart rate, status) as the next file."""
        data = []
        for patient, seconds, rate, status in rows:
            data.append((patient, self.next_id, T0 + timedelta(seconds=seconds), float(rate), (100, 70), status))
            self.next_id += 1
        self.sent += data
        df = self.spark.createDataFrame(data, EVENT)
        lines = [r.value for r in df.select(F.to_json(F.struct(*df.columns)).alias("value")).collect()]
        (self.path / f"{self.files:04d}.json").write_text("\n".join([*lines, "{broken"]))
        self.files += 1

    def stream(self):
        return stream_readings(self.spark, str(self.path), max_files=1, schema=EVENT)

    def batch(self):
        return self.spark.createDataFrame(self.sent, EVENT)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.fixture
def paths(tmp_path):
    return str(tmp_path / "out"), str(tmp_path / "checkpoint")


def run(query):
    query.awaitTermination()
    return query


def three_batches(feed):
    feed.send(("A", 0, 70, "NORMAL"), ("A", 1, 130, "ABNORMAL"), ("B", 2, 80, "NORMAL"))
    feed.send(("A", 6, 71, "NORMAL"), ("C", 7, 125, "ABNORMAL"))
    feed.send(("B", 3, 90, "ABNORMAL"), ("A", 12, 72, "NORMAL"))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_ingest_restarts_and_last_write_wins(feed, paths, spark):
    three_batches(feed)
    query = run(st.start_ingest(feed.stream(), *paths))
    durations = st.batch_durations(query)
    assert sum(d["rows"] for d in durations) == 7 + 3 and all(d["ms"] > 0 for d in durations)
    feed.send(("A", 0, 99, "NORMAL"))  # the key of the first reading again
    run(st.start_ingest(feed.stream(), *paths))
    landed = st.read_ingested(spark, paths[0])
    assert landed.count() == 8
    current = ops.dedup_readings(landed)
    assert current.count() == 7
    assert [r.heart_rate for r in current.filter("patient_id = 'A'").orderBy("timestamp").collect()] == [99, 130, 71, 72]


def test_dedup_within_the_watermark(feed, paths, spark):
    feed.send(("A", 0, 70, "NORMAL"), ("A", 0, 71, "NORMAL"))
    feed.send(("A", 0, 72, "NORMAL"), ("A", 5, 73, "NORMAL"))
    run(st.append_stream(st.stream_dedup(feed.stream()), *paths))
    assert sorted(r.heart_rate for r in spark.read.parquet(paths[0]).collect())[1:] == [73]


def test_alerts_equal_batch(feed, paths, spark, profiles_of):
    three_batches(feed)
    people = profiles_of(profile("A", age=50, conditions=["Ague"]))
    run(st.append_stream(st.stream_alerts(feed.stream(), people), *paths))
    got = rows(spark.read.parquet(paths[0]), "patient_id", "event_id", "severity", "name", "age", "conditions")
    assert got == [("A", 1, "High", "name A", 50, ["Ague"]), ("B", 5, "Medium", "Unknown", None, []),
                   ("C", 4, "High", "Unknown", None, [])]


def test_cycle_counts_equal_batch(feed, paths, spark):
    three_batches(feed)
    run(st.write_changes(st.stream_cycle_counts(feed.stream()), *paths, ["window_start"], publish_every=2))
    columns = ("window_start", "events", "abnormal")
    assert rows(st.latest_changes(spark, paths[0], ["window_start"]), *columns) == rows(ops.cycle_counts(feed.batch()), *columns)


def test_append_mode_drops_late_rows(feed, paths, spark):
    feed.send(("A", 1, 70, "NORMAL"))
    feed.send(("A", 100, 70, "NORMAL"))
    feed.send(("A", 101, 70, "NORMAL"))  # the rows that are late are known one batch later
    feed.send(("A", 2, 70, "ABNORMAL"))
    feed.send(("A", 300, 70, "NORMAL"))
    counts = st.stream_cycle_counts(feed.stream(), "5 seconds", lateness="10 seconds")
    run(st.append_stream(counts, *paths))
    assert rows(spark.read.parquet(paths[0]), "window_start", "events", "abnormal") == [
        (T0, 1, 0), (T0 + timedelta(seconds=100), 2, 0)]


def test_latest_equals_batch(feed, paths, spark):
    three_batches(feed)
    run(st.write_changes(st.stream_latest(feed.stream()), *paths, ["patient_id"]))
    columns = ("patient_id", "event_id", "heart_rate", "status")
    assert rows(st.latest_changes(spark, paths[0], ["patient_id"]), *columns) == rows(ops.latest_readings(feed.batch(), 1), *columns)


@pytest.mark.parametrize("buffer_rows", [1, 1000])
def test_latest_n_equals_batch_over_a_restart(buffer_rows, feed, paths, spark, monkeypatch):
    monkeypatch.setattr("pulsegrid.streaming.feeds.BUFFER_ROWS", buffer_rows)
    columns = ("patient_id", "rn", "event_id", "heart_rate", "status")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        three_batches(feed)
        run(st.write_changes(st.stream_latest_n(feed.stream(), 2), *paths, ["patient_id"], publish_every=2))
        feed.send(("A", 11, 73, "NORMAL"), ("D", 0, 60, "NORMAL"), ("B", 1, 81, "NORMAL"))
        run(st.write_changes(st.stream_latest_n(feed.stream(), 2), *paths, ["patient_id"], publish_every=2))
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    got = rows(st.latest_changes(spark, paths[0], ["patient_id"]), *columns)
    assert got == rows(ops.latest_readings(feed.batch(), 2), *columns)


@pytest.mark.parametrize("publish_every", [1, 2, 100])
def test_latest_n_table_equals_batch_over_a_restart(publish_every, feed, paths, spark):
    three_batches(feed)
    run(st.start_latest_n(feed.stream(), *paths, n=2, publish_every=publish_every))
    feed.send(("A", 11, 73, "NORMAL"), ("D", 0, 60, "NORMAL"), ("B", 1, 81, "NORMAL"))
    run(st.start_latest_n(feed.stream(), *paths, n=2, publish_every=publish_every))
    columns = ("patient_id", "rn", "event_id", "heart_rate", "status")
    got = rows(st.latest_changes(spark, paths[0], ["patient_id"]), *columns)
    assert got == rows(ops.latest_readings(feed.batch(), 2), *columns)


@pytest.mark.parametrize("publish_every", [1, 2, 100])
def test_risk_updates_chain_over_batches_and_restarts(publish_every, spark, tmp_path, profiles_of):
    root, history, checkpoint = (str(tmp_path / d) for d in ("profiles", "history", "checkpoint"))
    publish_version(profiles_of(profile("A", risk=5), profile("B", risk=1)), root)
    incoming = tmp_path / "in"
    incoming.mkdir()

    def send(n, *updates):
        data = [(p, s, T0 + timedelta(minutes=n), n * 10 + i) for i, (p, s) in enumerate(updates)]
        df = spark.createDataFrame(data, RISK_UPDATE_SCHEMA)
        lines = [r.value for r in df.select(F.to_json(F.struct(*df.columns)).alias("value")).collect()]
        (incoming / f"{n:04d}.json").write_text("\n".join(lines))

    def go():
        stream = stream_readings(spark, str(incoming), max_files=1, schema=RISK_UPDATE_SCHEMA)
        run(st.start_risk_updates(stream, root, history, checkpoint, publish_every=publish_every))

    send(1, ("A", 7), ("A", 9), ("Z", 4))
    send(2, ("B", 2))
    go()
    send(3, ("A", 3))
    go()
    after = {r.patient_id: (r.risk_score, r.risk_score_updated) for r in st.read_live_profiles(spark, root, history).collect()}
    assert after == {"A": (3, T0 + timedelta(minutes=3)), "B": (2, T0 + timedelta(minutes=2))}
    assert current_version(spark, root)[0] == 1 + 3 // publish_every
    chain = st.read_risk_history(spark, history).filter("patient_id = 'A'").orderBy("seq").collect()
    assert [(r.previous_score, r.score) for r in chain] == [(5, 7), (7, 9), (9, 3)]


@pytest.mark.parametrize("publish_every", [1, 100])
def test_a_new_checkpoint_goes_on_after_the_old_one(publish_every, spark, tmp_path, profiles_of):
    root, history = str(tmp_path / "profiles"), str(tmp_path / "history")
    publish_version(profiles_of(profile("A", risk=5), profile("B", risk=1)), root)
    for n, (patient, score) in enumerate([("A", 9), ("B", 4)]):
        incoming = tmp_path / f"in{n}"
        incoming.mkdir()
        (incoming / "0.json").write_text(
            json.dumps({"patient_id": patient, "score": score, "ts": f"2025-01-0{n + 1}T00:00:00", "seq": n}))
        stream = stream_readings(spark, str(incoming), schema=RISK_UPDATE_SCHEMA)
        for _ in range(2):  # the second run of a checkpoint has nothing to do
            run(st.start_risk_updates(stream, root, history, str(tmp_path / f"checkpoint{n}"), publish_every=publish_every))
    live = {r.patient_id: r.risk_score for r in st.read_live_profiles(spark, root, history).collect()}
    assert live == {"A": 9, "B": 4}
    assert st.read_risk_history(spark, history).count() == 2


def test_changes_of_two_checkpoints(feed, paths, spark, tmp_path):
    three_batches(feed)
    for checkpoint in ("one", "two"):  # the second reads all files again: the same rows, as later commits
        run(st.write_changes(st.stream_latest(feed.stream()), paths[0], str(tmp_path / checkpoint), ["patient_id"], publish_every=2))
    columns = ("patient_id", "event_id", "heart_rate", "status")
    assert rows(st.latest_changes(spark, paths[0], ["patient_id"]), *columns) == rows(ops.latest_readings(feed.batch(), 1), *columns)


def test_a_replayed_batch_is_applied_once(spark, tmp_path, profiles_of):
    """A micro-batch whose commit is in the log, but not in its checkpoint, is not applied again."""
    root, history, checkpoint = (str(tmp_path / d) for d in ("profiles", "history", "checkpoint"))
    publish_version(profiles_of(profile("A", risk=5)), root)
    incoming = tmp_path / "in"
    incoming.mkdir()
    (incoming / "0.json").write_text('{"patient_id": "A", "score": 9, "ts": "2025-01-01T00:00:00", "seq": 1}')
    for _ in range(2):
        stream = stream_readings(spark, str(incoming), schema=RISK_UPDATE_SCHEMA)
        run(st.start_risk_updates(stream, root, history, checkpoint, publish_every=1))
        for name in os.listdir(f"{checkpoint}/commits"):  # as if the stream had died before it noted the end
            os.remove(f"{checkpoint}/commits/{name}")
    assert read_published(spark, root).first().risk_score == 9 and current_version(spark, root) == (2, 0)
    assert [(r.previous_score, r.score) for r in st.read_risk_history(spark, history).collect()] == [(5, 9)]


@pytest.mark.parametrize("writers", [1, 6])
def test_the_feeds_micro_batches_do_not_grow_in_number_with_its_writers(spark, tmp_path, writers):
    events = spark.range(480).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(int(id % 16)) AS ts", "id % 7 AS user_id",
        "'error' AS event_type", "1.0D AS value", "'{\"k\": 5}' AS props")
    events.repartition(writers).write.parquet(f"{tmp_path}/sf/events.parquet")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream_queries._run_feed(spark, str(tmp_path / "sf"), str(tmp_path / "feed"), lambda feed: st.append_stream(feed, out, checkpoint))
    assert spark.read.parquet(out).count() == 480
    assert sum(1 for f in (tmp_path / "checkpoint" / "commits").iterdir() if f.name.isdigit()) <= len(stream_queries.PHASES) * stream_queries.SLICES


def test_a_micro_batch_broadcasts_by_the_size_of_rows_and_not_of_files(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    session = spark.newSession()
    largest = session.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for _ in range(2):
        sinks.batch_session(session.range(1))
        table = session.read.parquet(str(tmp_path / "t"))
        assert "Broadcast" not in table.join(table, "id", "left")._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert session.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold") == largest


def test_a_stream_of_alerts_never_broadcasts_the_profiles(spark, tmp_path, feed, profiles_of):
    feed.send(("a", 0, 130, "ABNORMAL"))
    publish_version(profiles_of(profile("a"), profile("b")), str(tmp_path / "profiles"))
    people = read_published(spark, str(tmp_path / "profiles"))
    query = st.append_stream(st.stream_alerts(feed.stream(), people), str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    assert "Join" in plan and "Broadcast" not in plan
    assert spark.read.parquet(str(tmp_path / "out")).first().name == "name a"


def test_the_query_of_alerts_makes_the_profiles_once(spark, tmp_path, monkeypatch):
    rows = {"customer": [(1, "a", 1, 9000.0, "x")], "nation": [(1, "n", 1)], "orders": [],
            "events": [(n, T0, 1, "error", 130.0, '{"k": 5}') for n in range(20)]}
    for name, data in rows.items():
        spark.createDataFrame(data, TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    seen, made = [], stream_queries.feeds.stream_alerts
    monkeypatch.setattr(stream_queries.feeds, "stream_alerts", lambda r, profiles: seen.append(profiles.inputFiles()) or made(r, profiles))
    assert QUERIES["stream_alerts"](spark, str(tmp_path)).filter("name = 'a'").count() == 20
    assert seen and not any(str(tmp_path) in file for files in seen for file in files)


def test_latest_n_sends_a_patients_newest_readings_to_the_state_as_one_row():
    parts = [pa.RecordBatch.from_pydict({"patient_id": pa.array(p, pa.int64()), "line": line})
             for p, line in (([2, 1, None, 2], ["b", "d", "x", "c"]), ([2, None, 1, None], ["c", "z", "a", "y"]))]
    got = feeds._row_a_patient(*feeds._newest_of(parts, 2)).to_pydict()
    assert dict(zip(got["patient_id"], got["readings"])) == {1: "d\na", 2: "c\nc", None: "z\ny"}


def committed(spark, path):
    """Rows by commit in the files of a table's changes."""
    return {r["commit"]: r["count"] for r in spark.read.parquet(f"{path}/changes").groupBy("commit").count().collect()}


def test_a_micro_batch_of_latest_n_commits_its_own_readings_only(feed, paths, spark):
    feed.send(*[("A", i, 70 + i, "NORMAL") for i in range(4)], ("B", 0, 60, "NORMAL"))
    feed.send(("A", 9, 90, "NORMAL"))
    feed.send(("A", -5, 91, "NORMAL"), ("B", 1, 61, "NORMAL"))
    run(st.start_latest_n(feed.stream(), *paths, n=3))
    assert committed(spark, paths[0]) == {0: 4, 1: 1, 2: 2}
    columns = ("patient_id", "rn", "event_id", "heart_rate")
    got = st.latest_changes(spark, paths[0], ["patient_id"])
    assert rows(got, *columns) == rows(ops.latest_readings(feed.batch(), 3), *columns)
    assert got.columns == ops.latest_readings(feed.batch(), 3).columns
    only = st.latest_changes(spark, paths[0], ["patient_id"], until=1).filter("patient_id = 'B'")
    assert [r.event_id for r in only.collect()] == [4]


@pytest.mark.parametrize("published", [False, True])
def test_added_readings_are_merged_with_rows_that_were_written_whole(published, feed, paths, spark):
    """Tables of commits that held all newest readings of their patients go on with commits that add to them."""
    for sent in ((("A", 5, 70, "NORMAL"), ("B", 5, 71, "NORMAL"), ("A", 6, 72, "NORMAL")), (("A", 7, 73, "NORMAL"),)):
        feed.send(*sent)
        whole = ops.latest_readings(feed.batch(), 2).filter(F.col("patient_id").isin([r[0] for r in sent]))
        run(sinks.start(feed.stream().writeStream.foreachBatch(lambda batch, n: sinks.write_batch(
            batch.sparkSession, paths[0], n, lambda last: whole, ["patient_id"], 1 if published else 100)), paths[1], None))
    assert bool(current_version(spark, paths[0])[0]) == published
    feed.send(("A", 3, 74, "NORMAL"), ("B", 8, 75, "NORMAL"), ("C", 0, 76, "NORMAL"))
    run(st.start_latest_n(feed.stream(), *paths, n=2))
    columns = ("patient_id", "rn", "heart_rate")
    got = rows(st.latest_changes(spark, paths[0], ["patient_id"]), *columns)
    assert got == rows(ops.latest_readings(feed.batch(), 2), *columns)
    assert got == [("A", 1, 73.0), ("A", 2, 72.0), ("B", 1, 75.0), ("B", 2, 71.0), ("C", 1, 76.0)]


@pytest.mark.parametrize("publish_every", [1, 100])
def test_readings_without_patient_are_those_of_the_last_commit(publish_every, feed, paths, spark):
    for n in range(3):
        feed.send((None, 10 - n, 70 + n, "NORMAL"), ("A", n, 80 + n, "NORMAL"))
    run(st.start_latest_n(feed.stream(), *paths, n=2, publish_every=publish_every))
    assert rows(st.latest_changes(spark, paths[0], ["patient_id"]), "patient_id", "rn", "heart_rate") == [
        ("A", 1, 82.0), ("A", 2, 81.0), (None, 1, 72.0)]


def test_a_version_is_laid_out_by_the_shuffle_that_merges_it(feed, paths, spark):
    three_batches(feed)
    run(st.start_latest_n(feed.stream(), *paths, n=2, publish_every=2))
    merged = sinks.latest_changes(spark, paths[0], ["patient_id"], buckets=sinks.BUCKETS)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Window" in plan and "_bucket" in merged.columns
    columns = ("patient_id", "rn", "event_id")
    assert rows(merged, *columns) == rows(ops.latest_readings(feed.batch(), 2), *columns)
