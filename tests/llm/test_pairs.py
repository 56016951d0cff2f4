"""Near-duplicates by fingerprint and by vector, against all pairs."""

import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pulsegrid.llm import embeddings, simhash
from pulsegrid.llm.graph import by_weight, components

SCHEMA = "doc_id long, text string"


def classes(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in pairs:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(20, 40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (3, 9), (9, 3), (159, 160)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 20 for i in range(20, 41)}, **{i: 100 for i in range(100, 161)}, 3: 3, 9: 3}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_block_masks_meet_every_close_pair():
    rng = random.Random(1)
    for blocks in (5, 6, 8):
        masks = simhash.block_masks(blocks, 4)
        for _ in range(200):
            diff = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(diff & m == 0 for m in masks)


@pytest.mark.parametrize("n_blocks", [None, 5, 7])
def test_simhash_equals_all_pairs(spark, n_blocks):
    rng = random.Random(5)
    texts = [None, "", "  ", "One", "one", "a b c", "A b\tc"]
    for _ in range(12):
        base = [rng.choice("ab cd ef gh ij kl mn op qr st".split()) + str(rng.randint(0, 99)) for _ in range(rng.randint(5, 300))]
        for _ in range(6):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "edit"
            texts.append(" ".join(rng.choice([base, copy])))
    texts.append("long word " * 30_000)
    prints = [plain_fingerprint(t) for t in texts]
    root = classes(len(texts), [(i, j) for i in range(len(texts)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    rows = spark.createDataFrame(list(enumerate(texts)), SCHEMA).withColumn("fp", F.lit("other"))
    got = {r["id"]: (r["fp"] % 2**64, r["component_id"]) for r in simhash.simhash_groups(rows, n_blocks=n_blocks).collect()}
    assert got == {i: (prints[i], root[i]) for i in range(len(texts))}


def test_keep_first_with_repeated_and_null_ids(spark):
    rows = [(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (None, "x y z q"), (None, "x y z q"), (2, None), (3, ""),
            (5, "foo bar baz qux"), (5, "a b c d e"), (7, "foo bar baz qux")]
    kept = simhash.keep_first(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted(
        [(1, "a b c d e"), (None, "x y z q"), (2, None), (5, "foo bar baz qux")], key=str)
    assert simhash.keep_first(spark.createDataFrame([], SCHEMA)).count() == 0


def vectors(seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(60):
        base = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 7))):
            out.append((base + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.2, 0.35])).tolist())
    return out


@pytest.mark.parametrize("part", [embeddings.PART, 3])
def test_vectors_equal_all_pairs(spark, monkeypatch, part):
    monkeypatch.setattr(embeddings, "PART", part)  # small parts: cells dealt to several tasks
    rows = [*vectors(), None, [], [0.0] * 16, [math.nan] * 16, [1.0, None], [1.0, 2.0], [2.0, 4.0]]
    good = [i for i, v in enumerate(rows) if v and None not in v and any(v) and not any(map(math.isnan, v))]
    unit = {i: np.array(rows[i]) / np.linalg.norm(rows[i]) for i in good}
    pairs = [(i, j) for i in good for j in good if j < i and len(rows[i]) == len(rows[j]) and unit[i] @ unit[j] >= 0.95]
    root = classes(len(rows), pairs)
    table = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = {r["id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_duplicates(table).collect()}
    want = {i: (sum(i in p for p in pairs), root[i]) for i in range(len(rows))}
    missed = sum(abs(got[i][0] - want[i][0]) for i in want)
    assert all(got[i][0] <= want[i][0] for i in want) and missed <= 0.01 * 2 * len(pairs)
    if not missed:
        assert got == want


def test_equal_vectors_and_empty_table(spark):
    table = spark.createDataFrame([(i, [1.0, 0.5]) for i in (4, 4, 9, 2)], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in embeddings.near_duplicates(table).collect()} == {(4, 3, 2), (9, 3, 2), (2, 3, 2)}
    assert embeddings.near_duplicates(table.limit(0)).count() == 0


def test_calibration_reaches_its_recall():
    plan = embeddings.calibrate(50_000, 64, 0.95)
    rng = np.random.default_rng(0)
    x = rng.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    y = 0.951 * x + math.sqrt(1 - 0.951**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    a, offset = embeddings._directions(64, plan)
    px, py = x @ a, y @ a
    cells = np.floor((px + offset) / plan.cell) == np.floor((py + offset) / plan.cell)
    met = cells.reshape(len(x), plan.groups, plan.per_group).all(axis=2).any(axis=1)
    counted = (np.abs(px - py)[:, :plan.counted] <= plan.half).sum(axis=1) >= plan.least
    assert (met & counted).mean() > 0.99


def test_a_longer_vector_costs_no_links_of_others(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((150, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    y = 0.951 * x + math.sqrt(1 - 0.951**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    rows = [*x.tolist(), *y.tolist(), rng.standard_normal(1024).tolist()]
    table = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = {r["id"]: r["n_links"] for r in embeddings.near_duplicates(table).collect()}
    assert sum(got.values()) >= 0.98 * 300 and got[300] == 0


def rows_a_task(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


@pytest.fixture
def partitions_of_a_cluster(spark):
    held = {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_the_edges_of_a_hub_stay_spread(spark, partitions_of_a_cluster):
    """A star of 100,000 edges beside 200,000 others."""
    star = spark.range(100_000, numPartitions=211).selectExpr("0L AS a", "id + 1 AS b")
    rest = spark.range(200_000, numPartitions=211).selectExpr("1000000 + id AS a", "2000000 + id AS b")
    edges = star.union(rest)
    low = edges.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
    joined = by_weight(edges, low, ["a"], "n", 300_000)
    sizes = rows_a_task(joined)
    assert sum(sizes) == 300_000 and sizes[-1] <= 4 * sizes[len(sizes) // 2]
    assert joined.where("low > b").count() == 0


def test_a_star_is_one_component(spark):
    star = spark.range(100_000).selectExpr("7L AS a", "id + 8 AS b").union(spark.range(10).selectExpr("200000 + id AS a", "200001 + id AS b"))
    found = components(star)
    assert found.where("root = 7").count() == 100_001 and found.where("root = 200000").count() == 11


def test_the_prints_of_a_hot_block_key_stay_spread(spark, partitions_of_a_cluster):
    """100,000 prints that share a block among 100,000 others: no pair of parts is a large group, and any two prints meet."""
    masks = simhash.block_masks(5, 4)
    hot = spark.range(100_000, numPartitions=211).selectExpr("(xxhash64(id) & ~8191L) | 5 AS fp")
    rest = spark.range(100_000, numPartitions=211).selectExpr("xxhash64(id + 1000000) AS fp")
    dealt = simhash._dealt(hot.union(rest).distinct(), masks, simhash.PART)
    keys = ["choice", "key", "low", "high"]
    assert dealt.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 2 * simhash.PART * 1.1
    sizes = rows_a_task(dealt.repartition(*keys))
    assert sizes[-1] <= 4 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("part", [2, 7, 1000])
def test_parts_of_block_keys_lose_no_link(spark, part):
    rng = random.Random(part)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = sorted({b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 5))) for b in base for _ in range(25)})
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    roots = dict(components(simhash.near_edges(df, 4, 5, part)).collect())
    want = classes(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    got = [roots.get(signed(p), signed(p)) for p in prints]
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(len(prints)) for j in range(i))


def test_vectors_of_any_magnitude_link(spark):
    rows = [(1, [1e200, 0.0]), (2, [1.0, 0.0]), (3, [1e-200, 0.0]), (4, [2e-200, 1e-210]), (5, [0.0, 1e300]), (6, [0.0, 5e-324]), (7, [0.0, 0.0])]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert sorted((r["id"], r["n_links"], r["component_id"]) for r in got.collect()) == [
        (1, 3, 1), (2, 3, 1), (3, 3, 1), (4, 3, 1), (5, 1, 5), (6, 1, 5), (7, 0, 7)]
