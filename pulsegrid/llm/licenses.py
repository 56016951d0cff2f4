"""License scans: ordered signature rules with keyword gates; containment and priority resolve overlaps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.license_rules import rules
from pulsegrid.llm.spans import match_spans

BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: The base phrases: label and words.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
#: A text without any of these, in lower case, holds no match of a rule and no base phrase. Beside some literals that are
#: common in other words stands the pattern that must hold, too.
GATE = (
    ("licen", None), ("spdx", None), ("copyright", None), ("apache", None), ("bsd", None), ("gpl", None),
    ("general", rf"general{BREAK}+public"), ("documentation", None), ("mozilla", None), ("mpl", r"\bmpl"), ("eclipse", None),
    ("common", rf"common{BREAK}+"), ("cddl", None), ("cecill", None), ("permission", None), ("redistribution", None),
    ("misrepresented", None), ("libpng", None), ("public", rf"public{BREAK}+domain"), ("wtfpl", None), ("want", rf"want{BREAK}+to"),
    ("eupl", None), ("python", None), ("ruby", None), ("perl", None), ("postgresql", None), ("gfdl", None), ("mulan", None), ("cc0", None),
    ("cc", rf"cc{BREAK}+by"), ("creative", rf"creative{BREAK}*commons"), ("rights", rf"rights{BREAK}+reserved"), ("proprietary", None),
    ("personal", rf"personal{BREAK}+(?:use|non)"), ("endorse", None), ("zlib", None), ("isc", rf"isc(?:{BREAK}|$)"), ("x11", None),
    ("ofl", None), ("psf", None), ("jpeg", None), ("unauthorized", None), ("unicode", None), ("attribution", None))
#: Detections are compared within stretches of so many characters, or the longest detection's.
STRETCH = 512
FOUND = "array<struct<start:int,stop:int,label:string,priority:int,confidence:double>>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def passes_gate(text: Column) -> Column:
    """Whether a text in lower case holds any of GATE."""
    held = F.lit(False)
    for literal, pattern in GATE:
        here = F.contains(text, F.lit(literal))
        held = held | (here & text.rlike(pattern) if pattern else here)
    return held


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _numbered(text: Column, spans: Column) -> Column:
    """``spans`` (start, stop, …) in order of their start, each beside the numbers of its first word and of the word after
    its last, in a text whose words each follow one space. Spaces are counted from one span to the next, once."""

    def step(acc: Column, s: Column) -> Column:
        word = acc["word"] + _spaces(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]))
        return _let(word, lambda w: F.struct(
            s["start"].alias("at"), w.alias("word"), F.concat(acc["out"], F.array(w)).alias("out")))

    def joined(ordered: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("word"), F.array().cast("array<int>").alias("out"))
        return _let(F.aggregate(ordered, start, step, lambda acc: acc["out"]), lambda words: F.transform(ordered, lambda s, i: F.struct(
            s.alias("span"), words[i].cast("long").alias("first"),
            (words[i] + 1 + _spaces(F.substring(text, s["start"] + 1, s["stop"] - s["start"]))).cast("long").alias("end"))))

    return _let(F.array_sort(spans), joined)


def _detections(text: Column) -> Column:
    """Matches of all rules: keywords are looked for once each, those of identifiers only behind their common word, and
    the patterns of a keyword only where it is found."""
    of_keyword: dict[str, list[Column]] = {}
    for label, priority, keyword, pattern, confidence in rules():
        of_keyword.setdefault(keyword, []).append(F.struct(
            F.lit(label).alias("label"), F.lit(priority).alias("priority"), F.lit(pattern).alias("pattern"), F.lit(confidence).alias("confidence")))
    tables: dict[str, list[Column]] = {"": [], "identifier": []}
    for keyword, patterns in of_keyword.items():
        tables["identifier" if keyword.startswith("identifier ") else ""].append(
            F.struct(F.lit(keyword).alias("keyword"), F.array(*patterns).alias("patterns")))

    def matched(rule: Column) -> Column:
        return F.transform(match_spans(text, rule["pattern"]), lambda s: F.struct(
            s["start"].alias("start"), s["stop"].alias("stop"), rule["label"].alias("label"),
            rule["priority"].alias("priority"), rule["confidence"].alias("confidence")))

    def found(table: list[Column]) -> Column:
        held = F.filter(F.array(*table), lambda k: F.contains(text, k["keyword"]))
        return F.flatten(F.transform(F.flatten(F.transform(held, lambda k: k["patterns"])), matched))

    named = F.when(F.contains(text, F.lit("identifier")), found(tables["identifier"])).otherwise(F.array().cast(FOUND))
    return F.array_distinct(F.concat(found(tables[""]), named))


def _resolved(found: Column) -> Column:
    """Detections that no other one suppresses: not contained in a longer or, if equal, a better one; and not overlapping
    a better one. Better: lower priority, then longer, then the earlier start, then the label.

    Each is compared with those that begin in its own stretch of the text or the ones beside it, as no detection is longer
    than a stretch.
    """

    def beaten(d: Column, near: Column) -> Column:
        def by(e: Column) -> Column:
            contains = (e["start"] <= d["start"]) & (e["stop"] >= d["stop"])
            longer = e["stop"] - e["start"] > d["stop"] - d["start"]
            shorter = e["stop"] - e["start"] < d["stop"] - d["start"]
            first = (e["start"] < d["start"]) | ((e["start"] == d["start"]) & (e["label"] < d["label"]))
            better = (e["priority"] < d["priority"]) | ((e["priority"] == d["priority"]) & (longer | (~shorter & first)))
            contained = (d["start"] <= e["start"]) & (d["stop"] >= e["stop"])
            overlap = (e["start"] < d["stop"]) & (d["start"] < e["stop"])
            return F.when(contains, longer | better).when(contained, F.lit(False)).otherwise(overlap & better)

        return F.exists(near, by)

    def by_stretch(width: Column) -> Column:
        def stretch(x: Column) -> Column:
            return F.floor(x["start"] / width)

        def kept(at: Column) -> Column:
            return _let(F.filter(found, lambda e: F.abs(stretch(e) - at) <= 1),
                        lambda near: F.filter(near, lambda d: (stretch(d) == at) & ~beaten(d, near)))

        return F.flatten(F.transform(F.array_distinct(F.transform(found, stretch)), kept))

    longest = F.array_max(F.transform(found, lambda x: x["stop"] - x["start"]))
    return F.when(F.size(found) > 1, _let(F.greatest(longest, F.lit(STRETCH)), by_stretch)).otherwise(found)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``licenses``: a struct of n_words, base (label, word) places and found (label, first and end word,
    confidence) detections.

    Words are runs of ASCII letters and digits and of all other characters above ASCII, A-Z lower-cased. Null and empty
    texts have no words and no detections; repeated rows repeat; a column named licenses is replaced. Rules run on texts
    that pass the gate and hold the rule's keyword; base phrases are detections whatever the rules say. Only DataFrame
    functions.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    low = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    normal = F.concat(F.lit(" "), F.trim(F.regexp_replace(low, rf"{BREAK}+", " ")), F.lit(" "))
    flat, all_, base_ = (_unused(docs, name) for name in ("flat", "all", "base"))
    gated = docs.withColumn(flat, F.when(_let(F.lower(text), passes_gate), normal))

    def places(label: str, phrase: str) -> Column:
        return F.when(F.contains(F.col(flat), F.lit(phrase)), F.transform(
            _numbered(F.col(flat), match_spans(F.col(flat), F.lit(rf"(?<= ){phrase}(?= )"))),
            lambda n: F.struct(F.lit(label).alias("label"), n["first"].alias("word")))).otherwise(empty_base)

    empty_base = F.array().cast("array<struct<label:string,word:bigint>>")
    empty_found = F.array().cast("array<struct<label:string,first_word:bigint,end_word:bigint,confidence:double>>")
    base = F.flatten(F.array(*[places(label, phrase) for label, phrase in BASE]))
    some = F.col(flat).isNotNull()
    marked = gated.withColumn(base_, F.when(some, base)).withColumn(all_, F.when(some, _detections(F.col(flat))))
    found = F.transform(_numbered(F.col(flat), _resolved(F.col(all_))), lambda n: F.struct(
        n["span"]["label"].alias("label"), n["first"].alias("first_word"), n["end"].alias("end_word"),
        n["span"]["confidence"].alias("confidence")))
    return marked.withColumn("licenses", F.struct(
        _let(F.split(text, rf"{BREAK}+", -1), _n_words).alias("n_words"),
        F.coalesce(F.col(base_), empty_base).alias("base"),
        F.coalesce(F.when(F.size(all_) > 0, found), empty_found).alias("found"))).drop(flat, all_, base_)


def _n_words(parts: Column) -> Column:
    """How many of the parts between breaks are words: all but an empty first or last one."""
    outer = (parts[0] == "").cast("long") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("long")
    return F.size(parts).cast("long") - outer


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name
