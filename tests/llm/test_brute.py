"""Decontamination, language ID and the pipeline against plain programs; edge cases that several operators share."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from test_pairs import classes, plain_fingerprint
from test_texts import plain_best_fit, plain_secrets
from tokenizers import Tokenizer

import corpus_pipeline
from pulsegrid.llm import decontamination as dc
from pulsegrid.llm import language, packing, secrets, token_counts
from pulsegrid.llm.queries import tokenizer_path

DOCS = "doc_id long, text string"
FIND = re.compile(r"[.!?:;\n]+|\d[\d.,]*\d|\d|[^\W\d_]+(?:['’][^\W\d_]+)*|[%°€$£¥]")


def kind_of(token):
    low = token.lower()
    if token[0].isdigit() or low in dc.NUMBERS:
        return "number"
    if low in dc.UNITS:
        return "unit"
    if not token[0].isalnum():
        return "end"
    return "title" if len(token) > 1 and token[0].isupper() and token[1:].islower() else "word"


def readings(text):
    """Lists of (what is compared, slot) for the literal reading and the three templates."""
    found = [(t.lower(), kind_of(t)) for t in FIND.findall((text or "").replace("\0", " "))]
    literal = [(w, None) for w, k in found if k != "end"]
    out = [literal]
    for first_is_name, rows_too in ((False, False), (True, False), (True, True)):
        tokens, i = [], 0
        name = [k == "title" and (first_is_name or (i > 0 and found[i - 1][1] != "end")) for i, (_, k) in enumerate(found)]
        follows = [k == "title" and (rows_too or (i > 0 and found[i - 1][1] != "end")) for i, (_, k) in enumerate(found)]
        while i < len(found):
            word, kind = found[i]
            near = {found[j][1] for j in (i - 1, i + 1) if 0 <= j < len(found)}
            stop = i + 1
            while stop < len(found) and follows[stop] and follows[stop - 1]:
                stop += 1
            text = " ".join(w for w, _ in found[i:stop])
            if name[i]:
                tokens.append(("<name>", f"name:{text}", word))
            elif kind == "number":
                tokens.append(("<number>", f"number:{text}", word))
            elif kind == "unit" and "number" in near:
                tokens.append(("<unit>", f"unit:{text}", word))
            elif kind != "end":
                tokens.append((word, None, word))
            i = stop
        out.append(tokens)
    return out


def windows(tokens, size, least):
    for at in range(len(tokens) - size + 1):
        part = tokens[at:at + size]
        if sum(t[1] is None for t in part) >= least:
            yield at, tuple(t[0] for t in part), [t[1] for t in part if t[1]]


def item_windows(text, window=13):
    literal, words, names, rows = readings(text)
    if literal:
        size = min(len(literal), window)
        yield from ((size, 0, *w) for w in windows(literal, size, 0))
    size_of = lambda n: window if n >= window else n if n >= 8 else 0
    if size := size_of(len(words)):
        either = [i for i in range(len(words)) if words[i][:2] != names[i][:2]]
        least = min(7, size)
        for at in range(len(words) - size + 1):
            here = [i for i in either if at <= i < at + size]
            for k in range(len(here) + 1):
                for chosen in itertools.combinations(here, k):
                    own = [names[i] if i in chosen else words[i] for i in range(at, at + size)]
                    if sum(t[1] is None for t in own) >= least:
                        yield size, 1, at, tuple(t[0] for t in own), [t[1] for t in own if t[1]]
    if len(rows) != len(words) and (size := size_of(len(rows))):
        yield from ((size, 3, *w) for w in windows(rows, size, min(7, size)))


def plain_matches(docs, items):
    wanted, sizes = defaultdict(list), (set(), set())
    for item, text in items:
        for size, reading, at, key, slots in item_windows(text):
            wanted[reading == 0, size, key].append((item, reading, at, slots))
            sizes[reading == 0].add(size)
    hits = defaultdict(dict)
    for doc, text in docs:
        for reading, tokens in enumerate(readings(text)):
            for size in sizes[reading == 0]:
                for at, key, slots in windows(tokens, size, min(7, size) if reading else 0):
                    for item, item_reading, item_at, item_slots in wanted.get((reading == 0, size, key), ()):
                        hits[doc, item, reading, item_reading, size, at - item_at].setdefault(item_at, (at, list(zip(item_slots, slots))))
    found = {}
    for (doc, item, _, _, size, shift), places in hits.items():
        runs, last = [], None
        for at in sorted(places):
            if last is None or at - last >= size:
                runs.append([])
            runs[-1].append(at)
            last = at
        for run in runs:
            pairs = {p for at in run for p in places[at][1]}
            names = [p for p in pairs if p[0].startswith("name")]
            if len({a for a, _ in pairs}) == len(pairs) and len({b for _, b in names}) == len(names):
                own = (len(run), run[-1] + size - run[0], len(pairs), all(a == b for a, b in pairs))
                found[doc, item] = tuple(map(max, own, found.get((doc, item), own)))
    return found


PLAIN = "the old house by a wide river was painted green in summer and then again before winter came to all of us".split()


def drawn_text(rng, n):
    parts = PLAIN + ["Tom", "Ann", "Mary", "12", "30", "5", "kg", "miles", "three", "$", "don't", "COAST", "é"]
    out = []
    for i in range(n):
        word = rng.choice(parts)
        out.append(word.capitalize() if i == 0 or out[-1].endswith((".", "?")) else word)
        if rng.random() < 0.1:
            out[-1] += rng.choice([".", "?", ",", ":"])
    return " ".join(out)


def changed(rng, text):
    swap = {"Tom": "Jim", "Ann": "Sue", "12": "44", "30": "12", "5": "7", "kg": "lb", "miles": "km"}
    how = rng.choice(["same", "lower", "upper", "swap", "cut", "word"])
    if how in ("lower", "upper"):
        return getattr(text, how)()
    words = text.split(" ")
    if how == "swap":
        return " ".join(re.sub(r"\w+", lambda m: swap.get(m[0], m[0]), w) for w in words)
    if how == "cut":
        return " ".join(words[len(words) // 4:])
    if how == "word":
        words[rng.randrange(len(words))] = "elsewhere"
    return " ".join(words)


@pytest.mark.parametrize("seed, shared, run", [(1, 4_000_000, 1 << 20), (2, 0, 200), (3, 4_000_000, 1)])
def test_decontamination_equals_a_plain_search(spark, monkeypatch, seed, shared, run):
    monkeypatch.setattr(dc, "SHARED_HASHES", shared)
    monkeypatch.setattr(dc, "RUN_CHARS", run)
    rng = random.Random(seed)
    items = [(i, drawn_text(rng, rng.choice([1, 2, 5, 8, 9, 12, 13, 14, 25, 40]))) for i in range(14)] + [(90, None), (91, "  ?!"), (92, "")]
    docs = [(-1, None), (-2, ""), (-3, ". \0 ."), (-4, " ".join(["Tom", "old house"] * 400))]
    for i in range(60):
        _, item = rng.choice(items[:14])
        docs.append((i, " ".join([drawn_text(rng, rng.randint(0, 20)), changed(rng, item), drawn_text(rng, rng.randint(0, 20))])))
    docs += docs[10:14]
    rows = spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS item", "2 AS doc", "3 AS hash", "4 AS tokens", "'x' AS item_id").repartition(3)
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS id", "2 AS hash")
    got = {(r["doc_id"], r["item_id"]): (r["windows"], r["tokens"], r["n_slots"], r["exact"]) for r in dc.matches(rows, table).collect()}
    want = plain_matches(docs, items)
    assert got.keys() == want.keys() and len(got) > 40
    assert got == want
    kept = dc.keep_uncontaminated(rows, table)
    assert kept.columns == rows.columns
    gone = {d for (d, _), w in want.items() if w[1] >= dc.LEAST_TOKENS}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _ in docs if d not in gone)


def plain_grams(text, features=1 << 13):
    data = b" " + bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in text.lower().encode()) + b" "
    data = re.sub(rb" +", b" ", data)
    return Counter(((int.from_bytes(data[i:i + 3], "big") * 2654435761) % 2**32) >> (32 - 13) for i in range(len(data) - 2))


def plain_languages(rows, modulus=4, remainder=2):
    """The answers of output codes over all splits of up to seven languages, number by number."""
    counts = defaultdict(Counter)
    for doc, text, lang in rows:
        if lang is not None and text and zlib.crc32(b"" if doc is None else str(doc).encode()) % modulus != remainder:
            counts[lang].update(plain_grams(text))
    names = sorted(counts)
    splits = [s for k in range(len(names)) for s in itertools.combinations(range(1, len(names)), k) if k < len(names) - 1] or [()]
    code = [[c == 0 or c in s for s in splits] for c in range(len(names))]
    share = [{g: n / max(1, sum(counts[name].values())) for g, n in counts[name].items()} for name in names]
    weights = []
    for b in range(len(splits)):
        sides = [[share[c] for c in range(len(names)) if code[c][b] == bit] for bit in (True, False)]
        mean = lambda side, g: sum(s.get(g, 0) for s in side) / max(1, len(side)) + 1e-6
        weights.append({g: math.log(mean(sides[0], g)) - math.log(mean(sides[1], g)) for s in share for g in s})
    certainty = [max(1e-6, sum(abs(sum(p * w.get(g, 0) for g, p in s.items())) for s in share) / len(names)) for w in weights]
    out = []
    for _, text, _ in rows:
        if not text or not names or not any(map(str.isalpha, text)):
            out.append(("und", 0.0))
            continue
        grams = plain_grams(text)
        margins = [sum(n * w.get(g, 0) for g, n in grams.items()) / sum(grams.values()) for w in weights]
        losses = [sum(math.log1p(math.exp(-4 * (1 if bit else -1) * m / c)) * c for bit, m, c in zip(own, margins, certainty)) / sum(certainty) for own in code]
        best = min(range(len(names)), key=lambda i: (losses[i], i))
        out.append((names[best], 1 / sum(math.exp(-6 * (x - losses[best])) for x in losses)))
    return out


def spoken(rng, lang, n):
    sounds = {"aa": "ba ka lo mi nu".split(), "bb": "schu tzen gro pfa".split(), "cc": "éa oie ux que".split(), "dd": "ль да не по".split()}
    return " ".join("".join(rng.choice(sounds[lang]) for _ in range(3)) for _ in range(n))


@pytest.mark.parametrize("langs", [["aa"], ["aa", "bb"], ["aa", "bb", "cc", "dd"]])
def test_languages_equal_plain_codes(spark, langs):
    rng = random.Random(len(langs))
    rows = [(i, spoken(rng, lang, rng.randint(1, 30)), lang) for i in range(80) for lang in [rng.choice(langs)]]
    rows += [(100, None, "aa"), (101, "", None), (102, "12 !", "aa"), (103, spoken(rng, langs[-1], 40_000), None), (None, "ba ka", None)] + [rows[3]] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "*", "1 AS lang_pred", "2 AS lang_score", "3 AS lang_ambiguous", "4 AS n", "5 AS feature").repartition(3)
    got = language.identify(docs, language.fit(docs))
    assert got.columns == ["doc_id", "text", "lang", "n", "feature", "lang_pred", "lang_score", "lang_ambiguous"]
    want = sorted(((r, *a) for r, a in zip(rows, plain_languages(rows))), key=repr)
    have = sorted((((r["doc_id"], r["text"], r["lang"]), r["lang_pred"], r["lang_score"]) for r in got.collect()), key=repr)
    assert [(r, p) for r, p, _ in have] == [(r, p) for r, p, _ in want]
    assert [s for _, _, s in have] == pytest.approx([s for _, _, s in want], abs=1e-9)
    assert language.identify(docs.limit(0), language.fit(docs.limit(0))).count() == 0


def test_a_tie_goes_to_the_first_language(spark):
    rows = [(i, "same text here", lang) for i in range(40) for lang in ("zz", "mm", "aa")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in language.identify(docs, language.fit(docs)).collect()} == {"aa"}


def test_empty_and_repeated_rows(spark):
    empty = spark.createDataFrame([], DOCS)
    assert secrets.scan(empty).count() == 0 and secrets.redact(empty).columns == ["doc_id", "text"]
    vocabulary = token_counts.Vocabulary((("▁a", -1.0), ("b", -2.0)))
    assert token_counts.count_tokens(empty, vocabulary).count() == 0
    twice = spark.createDataFrame([(1, "ab token=abcdefgh")] * 2 + [(2, None)], DOCS)
    assert sorted(r[0] for r in secrets.scan(twice).select(secrets.listed(F.col("secrets"))).collect()) == ["", "assign:3:17", "assign:3:17"]
    assert sorted(tuple(r) for r in token_counts.count_tokens(twice.selectExpr("doc_id", "'ab' AS text"), vocabulary).collect()) == [
        (1, 2, -3.0, 0), (1, 2, -3.0, 0), (2, 2, -3.0, 0)]
    none = token_counts.count_tokens(twice, token_counts.Vocabulary((), byte_fallback=False)).collect()
    assert all(r["n_unknown"] > 0 for r in none if r["id"] == 1) and [r["n_tokens"] for r in none if r["id"] == 2] == [0]


def test_packing_rows_of_one_id(spark):
    rows = [(1, "same words"), (1, "same words"), (1, "other words here"), (2, None), (None, "no id")]
    got = packing.pack(spark.createDataFrame(rows, DOCS), tokenizer_path("word_bpe_49k.json")).collect()
    assert sorted(str(r["doc_id"]) for r in got) == ["1", "1", "1", "2", "None"]
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in got)
    assert all(a[0] == b[0] and a[1] + a[2] == b[1] for a, b in zip(places, places[1:]))
    assert packing.pack(spark.createDataFrame([], DOCS), tokenizer_path("word_bpe_49k.json")).count() == 0


def test_pipeline_equals_plain_stages(spark, tmp_path):
    rng = random.Random(12)
    items = [(i, drawn_text(rng, 30)) for i in range(4)]
    rows = []
    for i in range(90):
        lang = rng.choice(["aa", "bb", "cc"])
        text = spoken(rng, lang, rng.randint(12, 60))
        if i % 9 == 1:
            text += " token = 'abcd1234efgh' " + spoken(rng, lang, 8)
        if i % 11 == 2:
            text = f"{text} {items[i % 4][1]} {text}"
        rows.append((i, text, lang, "s", len(text)))
    rows += [(200 + i, rows[i][1].upper() if i % 2 else rows[i][1], "aa", "s", 1) for i in range(0, 20, 3)]
    rows += [(300, None, "aa", None, None), (301, "", None, "s", 0), (302, "123 456", "bb", "s", 7), (303, rows[5][1], None, None, 3), (None, rows[6][1] + " ba", "aa", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn(
        "tokens", F.lit(1)).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    named = language.keep_identified(docs).select("doc_id").collect()
    answers = dict(zip([r[0] for r in rows], plain_languages([r[:3] for r in rows])))
    kept = [r for r in rows if (r[0],) in {tuple(n) for n in named}]
    assert {r[0] for r in rows} - {r[0] for r in kept} == {300, 301, 302} and all(answers[r[0]][0] != "und" for r in kept)
    prints = [plain_fingerprint(r[1]) for r in kept]
    root = classes(len(kept), [(i, j) for i in range(len(kept)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    groups = defaultdict(list)
    for i, r in enumerate(kept):
        groups[root[i]].append(r)
    kept = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    hits = plain_matches([(r[0], r[1]) for r in kept], items)
    kept = [r for r in kept if not any(d == r[0] and w[1] >= dc.LEAST_TOKENS for (d, _), w in hits.items())]
    assert 60 < len(kept) < 90
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = {}
    for r in kept:
        spans = [tuple(map(int, s.split(":")[1:])) for s in filter(None, plain_secrets(r[1])[1].split(","))]
        text = r[1]
        for a, b in sorted(spans, reverse=True):
            text = text[:a] + "[SECRET]" + text[b:]
        ids = library.encode(text, add_special_tokens=False).ids + [1]
        want[r[0]] = (len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: (r["doc_tokens"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    left = plain_best_fit([n for n, _ in want.values()], packing.WINDOW)
    used = Counter()
    for r in got:
        used[r["sequence_id"]] += r["length"]
    assert sorted(packing.WINDOW - n for n in used.values()) == left


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
