"""Secret scans: key patterns, and sliding-window entropy of candidate strings with an allow-list."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.spans import match_spans

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "entropy")

#: Longer candidates are read in pieces that overlap by a window less one, as a place in a text is found by counting from its start.
PIECE = 512
#: Window of the entropy scan, and the least entropy in bits that a window of each character class must reach:
#: random text of 20 characters has about 3.4 (16 symbols), 3.7 (26), 4.0 (36 and 52) and 4.2 (64).
WINDOW = 20
#: What sums of logarithms may lose.
ROUNDING = 1e-9
CLASSES = ((r"^(?:[0-9a-f]+|[0-9A-F]+)$", 3.1), (r"^(?:[0-9a-z]+|[0-9A-Z]+)$", 3.6), (r"^[A-Za-z0-9+/_=-]+$", 3.8))
#: A candidate: a maximal run of key characters. No pattern here repeats a group, which Java matches by recursion.
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Allowed parts of a candidate, blanked before the scan so that the rest of it is still read: placeholders, runs of the
#: keyboard or alphabet, UUIDs.
BLANK = "-"
BLANKED = ("example", "sample", "dummy", "placeholder", "changeme", "redacted", "your-", "your_", "0123456789", "1234567890",
           "01234567", "12345678", "abcdefgh", "qwerty")
UUID = r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])"
#: Windows that are no keys, each rule a pair of patterns: the one holds and the other does not. Repeated characters;
#: numbers; paths, slugs and identifiers of words, whose parts are all letters or all digits; words in one, which begin
#: with a capital and go on in small letters; small letters of which a quarter are vowels, as in long words.
ALLOWED = (
    (r"(.)\1{5}", None),
    (r"^[0-9/=_+-]+$", None),
    (r"[-_/=+]", r"[A-Za-z][0-9]|[0-9][A-Za-z]"),
    (r"^[A-Za-z]*[A-Z][A-Za-z]*$", r"[A-Z][a-z]?[A-Z]|[A-Z]$"),
    ("^(?=[a-z]+$)" + "[^aeiouy]*[aeiouy]" * 5, None),
)


def _any_window(text: Column, entropy: Column) -> Column:
    return F.lit(True)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.transform(F.array(value), use)[0]


def window_entropy(value: Column, window: int = WINDOW, counts: Callable[[Column, Column], Column] = _any_window) -> Column:
    """The highest Shannon entropy, in bits a character, of any ``window`` characters in a row of ``value`` for which
    ``counts(characters, entropy)`` holds, 0 if none; null if the value is shorter."""
    firsts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(value) - (window - 1)), F.lit(PIECE))
    return F.when(F.length(value) >= window, _let(value, lambda v: F.array_max(F.transform(
        firsts, lambda first: _let(F.substring(v, first, F.lit(PIECE + window - 1)), lambda piece: _piece_entropy(piece, window, counts))))))


def _piece_entropy(piece: Column, window: int, counted: Callable[[Column, Column], Column]) -> Column:
    """``window_entropy`` of a text that has ``window`` characters at least.

    One pass: each step takes the character that enters the window and the one that leaves it, and corrects the counts and
    the sum of c log c for these two. A text of few different characters has no entropy to look for.
    """
    weights = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(window + 1)])
    few = 2 ** (CLASSES[0][1] - ROUNDING) if counted is not _any_window else 0

    def scan(env: Column) -> Column:
        start = F.transform(env["signs"], lambda sign: F.size(F.filter(
            F.slice(env["codes"], 1, window), lambda c: c == F.array_position(env["signs"], sign) - 1)))

        def judged(counts: Column, total: Column, best: Column, last: Column) -> Column:
            entropy = F.lit(math.log2(window)) - total / window
            higher = F.when(entropy > best, F.when(
                counted(F.substring(piece, last - (window - 2), F.lit(window)), entropy), entropy).otherwise(best)).otherwise(best)
            return F.struct(counts.alias("counts"), total.alias("total"), higher.alias("best"))

        def slide(acc: Column, i: Column) -> Column:
            moved = F.struct(env["codes"][i].alias("in"), env["codes"][i - window].alias("out"), acc.alias("acc"))

            def move(m: Column) -> Column:
                old = m["acc"]["counts"]
                more, less = old[m["in"]], old[m["out"]]
                change = F.when(m["in"] == m["out"], F.lit(0.0)).otherwise(
                    weights[more + 1] - weights[more] + weights[less - 1] - weights[less])
                counts = F.when(m["in"] == m["out"], old).otherwise(F.transform(old, lambda c, j: F.when(j == m["in"], c + 1).when(
                    j == m["out"], c - 1).otherwise(c)))
                return _let(F.struct(counts.alias("counts"), (m["acc"]["total"] + change).alias("total"), m["acc"]["best"].alias("best")),
                            lambda now: judged(now["counts"], now["total"], now["best"], i))

            return _let(moved, move)

        first = _let(start, lambda counts: _let(
            F.aggregate(counts, F.lit(0.0), lambda sum_, c: sum_ + weights[c]),
            lambda total: judged(counts, total, F.lit(0.0), F.lit(window - 1))))
        return F.aggregate(
            F.when(F.length(piece) > window, F.sequence(F.lit(window), F.length(piece) - 1)).otherwise(F.array().cast("array<int>")),
            first, slide, lambda acc: acc["best"])

    def coded(signs: Column) -> Column:
        codes = F.transform(F.split(piece, ""), lambda c: (F.array_position(signs, c) - 1).cast("int"))
        return F.when(F.size(signs) >= few, _let(F.struct(signs.alias("signs"), codes.alias("codes")), scan)).otherwise(F.lit(0.0))

    return _let(F.array_distinct(F.split(piece, "")), coded)


def blanked(value: Column) -> Column:
    """A candidate with its allowed parts overwritten: as long as before, so that places stay."""
    value = F.regexp_replace(value, UUID, BLANK * 36)
    for part in BLANKED:
        value = F.regexp_replace(value, f"(?i){part}", BLANK * len(part))
    return value


def like_a_key(window: Column, entropy: Column) -> Column:
    """Whether a window reaches the entropy of keys of its character class and no allow-list rule holds."""
    (hex_like, a), (one_case, b), (_, c) = CLASSES
    least = F.when(window.rlike(hex_like), a).when(window.rlike(one_case), b).otherwise(c)
    allowed = F.lit(False)
    for has, lacks in ALLOWED:
        allowed = allowed | (window.rlike(has) & ~window.rlike(lacks) if lacks else window.rlike(has))
    return (entropy >= CLASSES[0][1] - ROUNDING) & (entropy >= least - ROUNDING) & ~allowed


def _tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["stop"].alias("stop"), F.lit(KINDS.index(kind)).alias("kind"), s["value"].alias("value")))


TAGGED = "array<struct<start:int,stop:int,kind:int,value:string>>"


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``secrets``: an array of (start, stop, kind, value) by start, then kind.

    Kinds (indexes into KINDS): assignments to key words, access keys, long hex runs, and runs of key characters with a
    window whose entropy is that of keys, apart from parts that the allow-list names, if no other span contains them. Places are code points of the whole text, end
    exclusive. Null texts count as empty and have none; repeated rows repeat; a column named secrets is replaced.
    Only DataFrame functions; texts without a key word, ``AKIA``, hex run or candidate pay for the search alone.
    """
    none = F.array().cast(TAGGED)
    text = F.coalesce(F.col(text_col), F.lit(""))
    low = F.lower(text)
    has_word = F.lit(False)
    for word in ASSIGN_WORDS:
        has_word = has_word | F.contains(low, F.lit(word))
    assign = F.filter(match_spans(text, F.lit(ASSIGN)), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= 6)
    access = F.filter(match_spans(text, F.lit(ACCESS)), lambda s: F.length(s["value"]) >= 20)
    hexes = match_spans(text, F.lit(r"[0-9a-f]{24,}"))
    base = F.concat(
        F.when(has_word, _tagged(assign, "assign")).otherwise(none),
        F.when(F.contains(text, F.lit("AKIA")), _tagged(access, "access")).otherwise(none),
        F.when(text.rlike(r"[0-9a-f]{24}"), _tagged(hexes, "hex")).otherwise(none))
    keys = F.filter(match_spans(text, F.lit(CANDIDATE)), lambda s: window_entropy(blanked(s["value"]), WINDOW, like_a_key) > 0)
    found = docs.withColumn("__base", base).withColumn(
        "__keys", F.when(text.rlike(CANDIDATE), _tagged(keys, "entropy")).otherwise(none))
    inside = lambda k: F.exists("__base", lambda b: (b["start"] <= k["start"]) & (b["stop"] >= k["stop"]))
    spans = F.concat("__base", F.filter("__keys", lambda k: ~inside(k)))
    ordered = F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["kind"], s["stop"], s["value"]))),
        lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"), s["value"].alias("value")))
    return found.withColumn("secrets", F.when(F.size(spans) > 0, ordered).otherwise(none)).drop("__base", "__keys")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents (columns as they are) with each secret, or overlapping secrets together, replaced by ``mark``.

    n_chars, if there, becomes the length of a changed text. Texts without secrets, null ones too, stay as they are.
    """
    found = scan(docs)
    start = F.struct(F.lit(0).alias("at"), F.col("text").alias("text"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        part = F.substring(acc["text"], acc["at"] + 1, s["start"] - acc["at"])
        fresh = (s["start"] >= acc["at"]) & ~((s["start"] == acc["at"]) & (acc["at"] > 0))
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["text"].alias("text"),
                        F.when(fresh, F.concat(acc["out"], F.array(part, F.lit(mark)))).otherwise(acc["out"]).alias("out"))

    clean = F.aggregate("secrets", start, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(acc["text"], acc["at"] + 1, F.length(acc["text"]))))
    some = F.size("secrets") > 0
    out = found.withColumn("text", F.when(some, clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(some, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)
