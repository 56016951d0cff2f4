"""The prefix trie against a plain dictionary of prefixes."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from pulsegrid.llm import prefix_trie as pt
from pulsegrid.llm.queries import OP12_SQL, op12_prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain_rebuilt(rows):
    def digest(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]

    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - int(math.fmod(c, 5)), [])[:heads[c]] + own[c][heads[c]:] for c in own}


def plain(sequences):
    nodes = defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, members in nodes.items():
        own = (len(members) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += own
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(sequences[c]) == len(path)))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members), children[path], leaves[path],
                    saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def answer(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def built(spark, rows):
    return pt.trie(*pt.rebuilt(pt.numbered(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS pos", "2 AS part", "3 AS bytes").repartition(5))))


def drawn(n, longest, seed, words=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        c = c if c % 7 else 1000 + c
        for turn in range(rng.choice([1, 2, 5, 15, 16, 17, longest])):
            rows.append((c, turn, rng.choice(["user", "é", None]) if turn % 9 == 8 else "user",
                         rng.choice(["", None, "héllo", "A" * 30][:words]) if turn % 5 == 4 else f"t{turn}"))
    rng.shuffle(rows)
    return rows


def test_trie_equals_plain(spark):
    rows = drawn(120, 70, 1) + [(None, 1, "user", "nobody's"), (5001, None, "user", "b"), (5001, None, "user", "a"), (5001, 3, "x", None)]
    rows += [(6000, 0, "r", "same")] * 40 + [(6001, t, "user", "x" * 50_000) for t in range(3)] + [(-3, 0, "user", "t0"), (-5, 0, "user", "t0")]
    assert answer(built(spark, rows)) == plain(plain_rebuilt(rows))


@pytest.mark.parametrize("height", [1, 2, 8])
def test_any_height_of_the_small_tries(spark, monkeypatch, height):
    monkeypatch.setattr(pt, "HEIGHT", height)
    monkeypatch.setattr(pt, "LISTED", 3)
    monkeypatch.setattr(pt, "SLICE", 4)
    rows = drawn(40, 23, height)
    assert answer(built(spark, rows)) == plain(plain_rebuilt(rows))


def test_one_conversation_with_most_rows_and_many_copies(spark):
    rows = [(0, t, "user", f"t{t % 3}") for t in range(700)]
    rows += [(c, t, "user", f"t{t}") for c in range(10, 600) for t in range(2)]
    assert answer(built(spark, rows)) == plain(plain_rebuilt(rows))


def test_empty_table_and_turnless_conversations(spark):
    assert built(spark, []).count() == 0
    rows = [(c, 0, "user", "alone") for c in (1, 2, 3, 4, 6, 7, 8, 9)]
    assert any(not turns for turns in plain_rebuilt(rows).values())
    assert answer(built(spark, rows)) == plain(plain_rebuilt(rows))


def test_sql_and_query(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations AS SELECT * FROM '/root/testdata/sf0.001/conversations.parquet'")
    rows = con.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    expected = plain(plain_rebuilt(rows))
    assert sorted(con.execute(OP12_SQL).fetchall(), key=repr) == expected
    assert answer(op12_prefix_trie(spark, "/root/testdata/sf0.001")) == expected
