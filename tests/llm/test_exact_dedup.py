"""The cuckoo-filter index against plain dictionaries."""

import hashlib
import random

import numpy as np

from pulsegrid.llm import exact_dedup as ed
from pulsegrid.llm.queries import op13_exact_dedup

SCHEMA = "doc_id long, text string"


def digest(n):
    return np.frombuffer(hashlib.sha256(str(n).encode()).digest(), np.uint64)


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def plain(rows):
    sizes, keeps = {}, {}
    for doc_id, text in rows:
        key = lowered(text)
        sizes[key] = sizes.get(key, 0) + 1
        if doc_id is not None:
            keeps[key] = max(doc_id, keeps.get(key, doc_id))
    return sorted(
        ((i, keeps.get(lowered(t)), sizes[lowered(t)], i == keeps.get(lowered(t)), hashlib.sha256(lowered(t).encode()).hexdigest())
         for i, t in rows), key=repr)


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_shard_inserts_counts_deletes_and_resizes():
    rng = random.Random(3)
    shard, live = ed.Shard(), {}
    for _ in range(60):
        batch = [(rng.randint(0, 3000), rng.randint(0, 10**6)) for _ in range(rng.randint(1, 400))]
        shard.absorb(np.array([digest(n) for n, _ in batch]), np.array([i for _, i in batch]), np.ones(len(batch), np.int64))
        for n, i in batch:
            keep, size = live.get(n, (i, 0))
            live[n] = max(keep, i), size + 1
        gone = rng.sample(sorted(live), len(live) // 5)
        if gone:
            shard.set(np.array([digest(n) for n in gone]), np.zeros(len(gone), np.int64), np.zeros(len(gone), np.int64))
            for n in gone:
                del live[n]
        assert shard.n_live == len(live) == len(shard.live())
        everything = np.array([digest(n) for n in range(3001)])
        found = shard.find(everything)
        assert {n for n in range(3001) if found[n] >= 0} == set(live)
        assert all((shard.keep[found[n]], shard.size[found[n]]) == live[n] for n in live)
    assert shard.resized > 3
    assert (shard.prints > 0).sum() == len(live)


def test_equal_prints_and_buckets_are_no_hit():
    """Digests that agree in print and bucket but not in content stay apart; those beyond their two buckets are stashed."""
    digests = np.zeros((30, 4), np.uint64)
    digests[:, 0], digests[:, 1], digests[:, 3] = 5, 7, np.arange(30)
    shard = ed.Shard()
    shard.absorb(digests[:20], np.arange(20), np.ones(20, np.int64))
    shard.absorb(digests[5:25], np.arange(20), np.ones(20, np.int64))
    assert shard.n_live == 25 and len(set(shard.find(digests[:25]).tolist())) == 25 and (shard.find(digests[25:]) < 0).all()
    assert len(shard.stash) == 17 and len(shard.prints) < 2 * ed.SPARSE * 25
    shard.set(digests[:10], np.zeros(10, np.int64), np.zeros(10, np.int64))
    assert shard.n_live == 15 and (shard.find(digests[:10]) < 0).all() and (shard.find(digests[10:25]) >= 0).all()
    assert len(shard.stash) == 7


ROWS = [(1, "A b"), (2, "a B"), (3, None), (4, ""), (5, "é"), (6, "É"), (7, " a b"), (None, "a b"), (None, "lone"), (8, "x" * 200_000),
        (9, "X" * 200_000), (10, "twice"), (10, "twice"), (11, "twice")]


def test_groups_equal_plain(spark):
    assert answer(ed.exact_groups(spark.createDataFrame(ROWS, SCHEMA))) == plain_with_nulls(ROWS)
    assert ed.exact_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def plain_with_nulls(rows):
    return sorted(((i, k, n, i == k, s) for i, k, n, _, s in plain(rows)), key=repr)


def test_many_copies_and_small_buffers(spark, monkeypatch):
    monkeypatch.setattr(ed, "TASK_KEYS", 50)
    rng = random.Random(2)
    rows = [(i, "Hot" if i % 3 == 0 else f"text {rng.randint(0, 900)}") for i in range(3000)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7).selectExpr("doc_id", "text", "1 AS digest", "2 AS shard", "3 AS keep", "4 AS size")
    assert answer(ed.exact_groups(docs)) == plain(rows)


def test_insert_delete_and_lookup(spark):
    rows = [(i, f"t{i % 40}") for i in range(300)]
    index = ed.insert(spark.createDataFrame(rows[:200], SCHEMA))
    index = ed.insert(spark.createDataFrame(rows[200:], SCHEMA), index)
    assert answer(ed.groups(index, spark)) == plain(rows)
    gone = {i for i in range(300) if i % 40 in (3, 5) or i >= 270}
    fewer = ed.delete(spark.createDataFrame([(i,) for i in gone] + [(None,), (9999,)], "doc_id long"), index)
    left = [r for r in rows if r[0] not in gone]
    assert answer(ed.groups(fewer, spark)) == plain(left)
    assert fewer.records(spark).count() == 38
    asked = spark.createDataFrame([(1, "T3"), (2, "T4"), (3, "new"), (4, "t4")], SCHEMA)
    assert [(r.keep, r["size"]) for r in ed.lookup(asked, fewer).collect()] == [
        (max(i for i, t in left if t == "t4"), sum(t == "t4" for _, t in left))]
    assert ed.lookup(asked, index).count() == 2
    again = ed.insert(spark.createDataFrame([(1000, "t3")], SCHEMA), fewer)
    assert answer(ed.groups(again, spark)) == plain([*left, (1000, "t3")])


def test_query(spark):
    got = op13_exact_dedup(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert answer(got) == plain([tuple(r) for r in docs])
