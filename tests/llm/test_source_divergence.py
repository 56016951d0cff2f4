"""The divergence audit against plain integer arithmetic over all terms and pairs."""

import random
import re
import subprocess
import sys
from collections import Counter, defaultdict

import duckdb
import pyarrow as pa
import pytest

from pulsegrid.llm import source_divergence as sd
from pulsegrid.llm.queries import OP11_SQL

SCHEMA = "text string, lang string, source string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least_docs=3, top=200):
    counts, docs, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        terms = TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
        lang, source = lang or "", source or ""
        sources[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, names in sources.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least_docs)

        def shares(of):
            total = sum(of[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (of[t] + 1) // total for t in kept}

        whole = shares(sum((counts[lang, s] for s in names), Counter()))
        share = {s: shares(counts[lang, s]) for s in names}
        f = lambda p, q: (p - q) ** 2 // q
        for s in names:
            pairs = [(sum(f(share[s][t], share[o][t]) for t in kept), o) for o in names if o != s]
            terms = [(f(share[s][t], whole[t]), t) for t in kept if counts[lang, s][t] and share[s][t] > whole[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, i, v, r) for r, (v, i) in enumerate(found, 1) if part == "pair" or r <= top]
    return sorted(out)


def answer(df):
    return sorted(tuple(r) for r in df.collect())


def drawn(n, seed, vocabulary=120):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "Ab é ñ xyZ ß q Œ".split() for b in "abcdefghijklmnopqr"][:vocabulary]
    joins = [" ", "1", "-", "\n", "_", "\x00", "\x7f", "["]
    rows = []
    for _ in range(n):
        k = rng.choice([0, 1, 5, 40])
        text = "".join(rng.choice(words[:rng.randint(1, len(words))]) + rng.choice(joins) for _ in range(k))
        rows.append((text, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", "É", "z9", None])))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_divergences_equal_plain(spark, monkeypatch, small):
    if small:
        for name, value in {"CHUNK_BYTES": 50, "HELD_ROWS": 40, "BLOCK_ROWS": 30, "PAIRS": 12}.items():
            monkeypatch.setattr(sd, name, value)
    rows = drawn(300, 4) + [(None, "xx", "only"), ("word", "xx", "other"), ("", "yy", None), ("Aa " * 30_000, "en", "a")]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "'t' AS term", "2 AS docs", "3 AS p").repartition(5)
    got = sd.divergences(docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert answer(got) == plain(rows)


def test_many_sources_ranks_and_ties(spark):
    rng = random.Random(8)
    rows = [(" ".join("abcdefgh"[rng.randint(0, 7)] * rng.randint(1, 60) for _ in range(60)), "en", f"s{i % 37}") for i in range(400)]
    rows += [("same words here", "en", s) for s in ("t1", "t2", "t3")] * 3
    assert answer(sd.divergences(spark.createDataFrame(rows, SCHEMA), top=5)) == plain(rows, top=5)


def test_empty_and_single_term(spark):
    assert sd.divergences(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [("one", "en", "a")] * 4 + [("one one", "en", "b")]
    assert answer(sd.divergences(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_large_counts_do_not_overflow(spark):
    row = spark.sql(f"SELECT {2 * 10**15}L AS n, {3 * 10**15}L AS total")
    from pyspark.sql import functions as F
    assert row.select(sd._share("n", F.col("total"))).first()[0] == 1 + 10**9 * (2 * 10**15 + 1) // (3 * 10**15)


def test_sql_equals_plain():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    rows = con.execute("SELECT text, lang, source FROM documents").fetchall()
    assert sorted(con.execute(OP11_SQL).fetchall()) == plain(rows)


COUNT = """
import resource, sys
import pyarrow as pa
from pulsegrid.llm import source_divergence as sd
pa.set_cpu_count(16)
letters = lambda n: "".join(chr(97 + n // 26**k % 26) for k in range(5))
texts = [" ".join(letters((i * 7919 + d * 104729) % 26**5) for i in range(1000)) for d in range(3000)]
batch = pa.RecordBatch.from_pydict({c: pa.array(v, pa.large_string()) for c, v in
                                    (("lang", ["en"] * 3000), ("source", [f"s{d % 20}" for d in range(3000)]), ("text", texts))})
peak = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10
before, held = peak(), []
for chunk in sd._chunks(batch):
    held.append(sd._counted(chunk))
    if sum(t.num_rows for t in held) > sd.HELD_ROWS:
        held = [sd._merged(held)]
        if held[0].num_rows > sd.HELD_ROWS // 2:
            held.clear()
print(peak() - before)
"""


def test_counting_holds_its_groups_once_whatever_the_cores():
    """MB that a worker's counts take beside its texts, where nearly all terms are distinct."""
    done = subprocess.run([sys.executable, "-c", COUNT], capture_output=True, text=True, env={"PYTHONPATH": ":".join(sys.path)})
    assert int(done.stdout or 10**6) < 500, done.stderr


def test_small_batches_are_joined_and_all_rows_stay(monkeypatch):
    monkeypatch.setattr(sd, "CHUNK_BYTES", 200)
    texts = ["a" * n for n in (10, 0, 30, 500, 1, 2, 3, 60)] * 3
    batches = [pa.RecordBatch.from_pydict({"lang": [t], "source": ["s"], "text": [t]}) for t in texts]
    got = list(sd._joined(iter([batches[0].slice(0, 0), *batches])))
    assert [t for b in got for t in b.column("text").to_pylist()] == texts and len(got) < len(batches)
    assert {f.type for b in got for f in b.schema} == {pa.large_string()}
    assert list(sd._joined(iter([]))) == list(sd._joined(iter([batches[0].slice(0, 0)]))) == []
