"""Benchmark decontamination: literal windows, and template windows with typed placeholders, hash-joined, then checked for
consistent slots."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.graph import landed, slices, small_batches

WINDOW = 13
#: Template windows with fewer plain words than this say too little to be compared; literal ones need none.
LEAST_PLAIN = 7
#: Items with fewer tokens than this have no template window, but a literal one.
LEAST_TOKENS = 8
#: Above this many different benchmark windows their hashes are not sent to every task (8 bytes each).
SHARED_HASHES = 4_000_000
CACHED_TOKENS = 200_000
#: Characters of text read in a row.
RUN_CHARS = 1 << 20

#: Ends of texts that are read in a row, sentence ends, numbers, words and the signs of units.
END_OF_TEXT = "\x00"
TOKEN = re.compile(r"\x00|[.!?:;\n]+|\d[\d.,]*\d|\d|[^\W\d_]+(?:['’][^\W\d_]+)*|[%°€$£¥]")
NUMBERS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen
eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split())
UNITS = frozenset("""mm cm m km inch inches foot feet ft yard yards mile miles mg g kg gram grams kilogram kilograms ton tons tonne tonnes
ounce ounces oz pound pounds lb lbs ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours h day
days week weeks month months year years cent cents dollar dollars usd euro euros eur percent degrees degree celsius fahrenheit meter
meters metre metres centimeter centimeters kilometer kilometers mph kmh watt watts volt volts joule joules % ° € $ £ ¥""".split())

WORD, TITLE, NUMBER, UNIT, END = range(5)
SMALL = {**{w: UNIT for w in UNITS if w.isalpha()}, **{w: NUMBER for w in NUMBERS}}
PLACEHOLDERS = {TITLE: "<name>", NUMBER: "<number>", UNIT: "<unit>"}
SLOT_HASH = {k: xxhash.xxh64_intdigest(v, 1) for k, v in PLACEHOLDERS.items()}
SLOT_HASHES = np.array([SLOT_HASH.get(k, 0) for k in range(END + 1)], np.uint64)
BASE = 0x9E3779B97F4A7C15
ALL_BITS = (1 << 64) - 1
#: What literal windows differ by from templates without slots.
LITERAL_SEED = 0x5851F42D4C957F2D


#: Readings: of the tokens as they are; as a template whose sentences begin with words, with names if capitalised, or with
#: names that are one slot with the names after them. The first two templates number their tokens alike.
LITERAL, WORDS, NAMES, ROWS = range(4)


class Tokens(NamedTuple):
    """One reading of texts in a row: hashes of their tokens, which of them are slots (0, or the kind), the number of the
    text that each is of, and their places among what was found; where ``again``, a found token belongs to the one before it."""

    hashes: np.ndarray
    slots: np.ndarray
    texts: np.ndarray
    places: np.ndarray
    found: list[str]
    again: np.ndarray

    def text(self, i: int) -> str:
        at = stop = int(self.places[i])
        while stop + 1 < len(self.found) and self.again[stop + 1]:
            stop += 1
        return " ".join(self.found[at:stop + 1]).lower()


class Reader:
    """Canonicalises texts, with a bounded memory of tokens."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}  # a token's place in the two arrays
        self.kinds, self.hashes = np.zeros(1 << 12, np.int8), np.zeros(1 << 12, np.uint64)

    def _learn(self, tokens: set[str]) -> None:
        at, end = len(self.known), len(self.known) + len(tokens)
        if end > len(self.kinds):
            room = max(end, 2 * len(self.kinds))
            self.kinds, self.hashes = np.resize(self.kinds, room), np.resize(self.hashes, room)
        kinds = [SMALL.get(t, WORD) if t.islower() and t.isalpha() else self._kind(t) for t in tokens]
        self.kinds[at:end] = kinds
        self.hashes[at:end] = [xxhash.xxh64_intdigest(t.lower(), 0) for t in tokens]
        self.known.update(zip(tokens, range(at, end)))

    def _kind(self, token: str) -> int:
        low = token.lower()
        first = token[0]
        if not (first.isalnum() or token in UNITS):
            return END
        if first.isdigit() or low in NUMBERS:
            return NUMBER
        if low in UNITS:
            return UNIT
        return TITLE if len(token) > 1 and first.isupper() and token[1:].islower() else WORD

    def read(self, texts: list[str]) -> dict[int, Tokens]:
        """The readings of texts in a row. In templates numbers, units after numbers (or signs before them) and names become
        slots; names in a row are one slot.

        A name is a capitalised word; one that begins a sentence is a word in the first template and a name in the others.
        """
        found, known = TOKEN.findall(END_OF_TEXT.join([t.replace(END_OF_TEXT, " ") for t in texts])), self.known
        if len(known) > CACHED_TOKENS:
            known.clear()
        new = set(found).difference(known)
        if new:
            self._learn(new)
        places = np.fromiter(map(known.__getitem__, found), np.int64, len(found))
        kinds, literal = self.kinds[places], self.hashes[places]
        if not len(found):
            none = np.zeros(0, bool)
            return {reading: Tokens(literal, kinds, places, places, found, none) for reading in range(4)}
        numbers = np.cumsum(places == known.get(END_OF_TEXT, -1))
        before = np.concatenate(([END], kinds[:-1]))
        after = np.concatenate((kinds[1:], [END]))
        slots = np.where(kinds == NUMBER, NUMBER, 0)
        slots = np.where((kinds == UNIT) & ((before == NUMBER) | (after == NUMBER)), UNIT, slots)
        title = kinds == TITLE
        inner = title & (before != END)
        kept = kinds != END
        at = np.flatnonzero(kept)
        out = {LITERAL: Tokens(literal[at], np.zeros(len(at), slots.dtype), numbers[at], at, found, np.zeros(len(found), bool))}
        for reading, name, row in ((WORDS, inner, inner), (NAMES, title, inner), (ROWS, title, title)):
            own = np.where(name, TITLE, slots)
            hashes = np.where(own == 0, literal, SLOT_HASHES[own])
            if reading != NAMES:
                again = row & np.concatenate(([False], row[:-1]))
                at = np.flatnonzero(kept & ~again)
            out[reading] = Tokens(hashes[at], own[at], numbers[at], at, found, again)
        return out


def _power(n: int) -> int:
    return pow(BASE, n, 1 << 64)


def _polynomials(hashes: np.ndarray, size: int) -> np.ndarray:
    """The sum of hash * BASE**(tokens after it) of every window of ``size`` tokens, by doubling."""
    n = len(hashes) - size + 1
    value, width, part, part_width = None, 0, hashes, 1
    while True:
        if size & part_width:  # the windows so far, followed by the next ``part_width`` tokens
            value = part[:n] if value is None else value[:n] * np.uint64(_power(part_width)) + part[width:width + n]
            width += part_width
        if 2 * part_width > size:
            return value
        part = part[:-part_width] * np.uint64(_power(part_width)) + part[part_width:]
        part_width *= 2


def _mixed(value: np.ndarray, size: int, reading: int) -> np.ndarray:
    seed = size * _power(size) + (LITERAL_SEED if reading == LITERAL else 0)
    value = value + np.uint64(seed & ALL_BITS)
    return value ^ (value >> np.uint64(29))


def window_hashes(tokens: Tokens, size: int, reading: int, least_plain: int = LEAST_PLAIN) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the windows of ``size`` tokens within a text; of templates, of those that hold enough plain words."""
    n = len(tokens.hashes) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    value = _mixed(_polynomials(tokens.hashes, size), size, reading)
    within = tokens.texts[:n] == tokens.texts[size - 1:]
    if reading != LITERAL:
        plain = np.concatenate(([0], np.cumsum(tokens.slots == 0)))
        within &= plain[size:] - plain[:-size] >= min(least_plain, size)
    at = np.flatnonzero(within)
    return at, value[at]


def _slots(tokens: Tokens, at: int, size: int) -> list[str]:
    return [f"{tokens.slots[i]}:{tokens.text(i)}" for i in (at + np.flatnonzero(tokens.slots[at:at + size])).tolist()]


def _item_windows(read: dict[int, Tokens], size_of, literal_size_of) -> Iterator[tuple[int, int, int, int, list[str]]]:
    """(hash, size, reading, start, slots) of an item, read alone: its literal windows, its templates with every choice between word and
    name at the beginnings of sentences, and those in which such a name is one slot with the names after it."""
    literal, words, names, rows = (read[r] for r in range(4))
    if size := literal_size_of(len(literal.hashes)):
        for a, h in zip(*(x.tolist() for x in window_hashes(literal, size, LITERAL))):
            yield h, size, LITERAL, a, []
    if size := size_of(len(words.hashes)):
        either = np.flatnonzero(words.slots != names.slots)
        for a, value in enumerate(_polynomials(words.hashes, size).tolist()):
            here = either[(either >= a) & (either < a + size)].tolist()
            spare = int((words.slots[a:a + size] == 0).sum()) - min(LEAST_PLAIN, size)
            for k in range(min(len(here), spare) + 1):
                for chosen in combinations(here, k):
                    more = sum((int(names.hashes[i]) - int(words.hashes[i])) * _power(a + size - 1 - i) for i in chosen)
                    h = int(_mixed(np.array([(value + more) & ALL_BITS], np.uint64), size, WORDS)[0])
                    slots = np.where(np.isin(np.arange(a, a + size), chosen), TITLE, words.slots[a:a + size])
                    yield h, size, WORDS, a, [f"{slots[i]}:{words.text(a + i)}" for i in np.flatnonzero(slots).tolist()]
    if len(rows.hashes) != len(words.hashes) and (size := size_of(len(rows.hashes))):
        for a, h in zip(*(x.tolist() for x in window_hashes(rows, size, ROWS))):
            yield h, size, ROWS, a, _slots(rows, a, size)


HIT = "hash long, size long, {0}_reading long, {0}_at long, {0}_slots array<string>, {0} long"


def _runs(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """The texts in runs of about RUN_CHARS characters, each with the number of its first text."""
    first = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= RUN_CHARS or i + 1 == len(texts):
            yield first, texts[first:i + 1]
            first, size = i + 1, 0


def _windows(rows: DataFrame, prefix: str, windows_of, prepare=lambda: None) -> DataFrame:
    """The windows of ``rows(id, text)``: (number of the text, window) as ``windows_of(reader, texts, prepare())`` gives them."""
    names = [c.split()[0] for c in HIT.format(prefix).split(", ")]
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, prepared = Reader(), prepare()
        for batch in slices(batches):
            keys = batch.column(0).to_pylist()
            for first, texts in _runs([t or "" for t in batch.column(1).to_pylist()]):
                out = [(h - (1 << 64) if h >> 63 else h, size, reading, at, slots, keys[first + i])
                       for i, (h, size, reading, at, slots) in windows_of(reader, texts, prepared)]
                if out:
                    kinds = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return rows.mapInArrow(run, HIT.format(prefix))


def matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """``(doc_id, item_id, windows, tokens, n_slots, exact)``: the documents that hold a benchmark item or its template.

    A document matches an item if they share a literal window: ``window`` tokens, or the whole of a shorter item, that are
    equal but for case; or a run of template windows whose slots agree. A run is of overlapping windows at one offset
    between both texts; in it each of the item's names, numbers and units stands for one of the document's, and for
    names also the other way round. ``exact`` says that a literal window is shared or all slots of a run are the same.

    Of templates, windows with LEAST_PLAIN plain words at least are compared, and items of ``least_tokens`` at least. A
    capitalised word that begins a sentence may be word or name: each on its own in items, all alike in a document.
    Windows of either side are joined on their hash; documents' windows that no item has are dropped in the tasks by the
    items' hashes as long as these are at most SHARED_HASHES, and by the join alone beyond. Null texts and those without
    a token match nothing; repeated rows count once; null ids are kept as one id; empty tables give no rows.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    size_of = lambda n: window if n >= window else n if n >= least_tokens else 0
    literal_size_of = lambda n: min(n, window)
    alone = lambda reader, texts, _: (
        (i, found) for i, text in enumerate(texts) for found in _item_windows(reader.read([text]), size_of, literal_size_of))
    of_items = landed(_windows(items, "item", alone), "benchmark-windows")
    literal = F.col("item_reading") == LITERAL
    bounds = of_items.agg(F.countDistinct("hash").alias("n"), F.collect_set(F.when(~literal, F.col("size"))).alias("sizes"),
                          F.collect_set(F.when(literal, F.col("size"))).alias("literal_sizes")).first()
    shared = None
    if 0 < bounds["n"] <= SHARED_HASHES:
        hashes = of_items.select("hash").distinct().toArrow().column("hash").to_numpy()
        shared = docs.sparkSession.sparkContext.broadcast(np.sort(hashes.astype(np.int64).view(np.uint64)))
    lengths = {r: sorted(bounds["literal_sizes" if r == LITERAL else "sizes"]) for r in range(4)}

    def prepare():
        if shared is None:
            return None
        wanted = shared.value  # a bitmap of the low bits spares most searches in the sorted hashes
        mask = np.uint64((1 << max(16, int(len(wanted)).bit_length() + 5)) - 1)
        bitmap = np.zeros(int(mask) + 1, bool)
        bitmap[wanted & mask] = True
        return wanted, mask, bitmap

    def of_documents(reader: Reader, texts: list[str], prepared) -> Iterator[tuple[int, tuple[int, int, int, int, list[str]]]]:
        read = reader.read(texts)
        for size in sorted({s for r in lengths.values() for s in r}):
            seen: dict[int, list] = {}
            for reading, tokens in read.items():
                if size not in lengths[reading] or size > len(tokens.hashes):
                    continue
                at, value = window_hashes(tokens, size, reading)
                if prepared and len(at):
                    wanted, mask, bitmap = prepared
                    some = np.flatnonzero(bitmap[value & mask])
                    some = some[wanted[np.minimum(np.searchsorted(wanted, value[some]), len(wanted) - 1)] == value[some]]
                    at, value = at[some], value[some]
                numbers = tokens.texts[at]
                begins = np.searchsorted(tokens.texts, numbers)  # a text's first token
                hits = zip(numbers.tolist(), value.tolist(), at.tolist(), (at - begins).tolist())
                for number, group in groupby(hits, lambda hit: hit[0]):
                    if reading == LITERAL and size < window:  # a whole item: that it is there says all
                        group = {h: hit for hit in reversed(list(group)) for h in hit[1:2]}.values()
                    found = [(h, a, _slots(tokens, i, size)) for _, h, i, a in group]
                    plain = [(h, slots) for h, _, slots in found]
                    if plain not in seen.setdefault(number, []):  # another reading may have the same windows
                        seen[number].append(plain)
                        yield from ((number, (h, size, reading, a, slots)) for h, a, slots in found)

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    hits = _windows(rows, "doc", of_documents, prepare)
    met = (hits.join(of_items, ["hash", "size"]).where((F.col("doc_reading") == LITERAL) == literal)
           .withColumn("shift", F.col("doc_at") - F.col("item_at"))
           .dropDuplicates(["doc", "item", "doc_reading", "item_reading", "doc_at", "item_at", "size"]))
    side = ["doc", "item", "doc_reading", "item_reading", "size", "shift"]
    order = Window.partitionBy(*side).orderBy("item_at")
    parted = F.coalesce(F.col("item_at") - F.lag("item_at").over(order) >= F.col("size"), F.lit(False))
    runs = met.withColumn("parted", parted.cast("long")).withColumn("run", F.sum("parted").over(order))
    pairs = F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("item_slots", "doc_slots"))))
    aligned = runs.groupBy(*side, "run").agg(
        F.count("*").alias("windows"), (F.max(F.col("doc_at") + F.col("size")) - F.min("doc_at")).alias("tokens"), pairs.alias("pairs"))
    of_names = F.filter("pairs", lambda p: p["item_slots"].startswith(f"{TITLE}:"))
    function = lambda pairs, of: F.size(F.array_distinct(F.transform(pairs, lambda p: p[of]))) == F.size(pairs)
    same = F.forall("pairs", lambda p: p["item_slots"] == p["doc_slots"])
    return (aligned.where(function(F.col("pairs"), "item_slots") & function(of_names, "doc_slots"))
            .groupBy(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))
            .agg(F.max("windows").alias("windows"), F.max("tokens").alias("tokens"),
                 F.max(F.size("pairs")).cast("long").alias("n_slots"), F.max(same).alias("exact")))


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, least_shared: int = LEAST_TOKENS) -> DataFrame:
    """The documents (columns as they are) that share no ``least_shared`` tokens in a row, or a template of as many, with a
    benchmark item: a document is not dropped for saying the two words of a two-word item."""
    found = matches(docs, benchmark).where(F.col("tokens") >= least_shared)
    found = landed(found.select(F.col("doc_id").alias("__doc")).distinct(), "contaminated")
    return docs.join(found, docs["doc_id"].eqNullSafe(found["__doc"]), "left_anti").select(docs.columns)
