"""Packing token sequences: best-fit decreasing over windows, on counts of lengths."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.graph import landed, slices, small_batches

WINDOW = 2048
CACHED_WORDS, CACHED_LENGTH = 600_000, 64
#: Bytes of text whose words are learned together, and pre-tokens encoded in a row.
LEARNED_BYTES, PARTS_A_ROW = 1 << 20, 500
PIECES_PER_BUCKET = 50_000


class CapacityTree:
    """A segment tree over the remaining capacities 0..size: which of them some open window has."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.some = [False] * (2 * self.leaves)

    def put(self, capacity: int, there: bool) -> None:
        at = self.leaves + capacity
        self.some[at] = there
        while at > 1:
            at //= 2
            self.some[at] = self.some[2 * at] or self.some[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        """The least capacity of an open window that holds ``need``."""
        at = self.leaves + need
        if self.some[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.some[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.some[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def best_fit_plan(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing for ``counts[length]`` pieces of each length up to the window.

    Pieces of one length and windows of one remaining capacity are alike, so whole runs of them are placed at once;
    the result is that of placing the pieces one by one. Rows (length, first rank, end rank, first window,
    pieces a window, offset): ranks [first, end) go to consecutive windows, so many in each, from that offset on.
    The work depends on the window's size, not on the number of pieces.
    """
    plan, tree = [], CapacityTree(window)
    opened: dict[int, list[tuple[int, int]]] = {}
    used = 0

    def add(capacity: int, first: int, n: int) -> None:
        if capacity and n:
            opened.setdefault(capacity, []).append((first, n))
            tree.put(capacity, True)

    for length in sorted((k for k, n in counts.items() if n and k > 0), reverse=True):
        rank, end = 0, counts[length]
        while rank < end:
            capacity = tree.tightest(length)
            if capacity is None:  # open as many windows as the rest of this length fills, the last one in part
                each = window // length
                capacity, first, n = window, used, -(-(end - rank) // each)
                used += n
            else:
                each = capacity // length
                first, n = opened[capacity].pop()
                if not opened[capacity]:
                    tree.put(capacity, False)
            whole = min(n, (end - rank) // each)
            if whole:
                plan.append((length, rank, rank + whole * each, first, each, window - capacity))
                add(capacity - each * length, first, whole)
                rank += whole * each
            if whole < n:
                if rank < end:  # fewer pieces are left than one window takes
                    plan.append((length, rank, end, first + whole, end - rank, window - capacity))
                    add(capacity - (end - rank) * length, first + whole, 1)
                    rank, whole = end, whole + 1
                if capacity < window:
                    add(capacity, first + whole, n - whole)
    return plan


class WordEncoder:
    """Token ids of texts by a tokenizer that drops white space, one word at a time and with a bounded memory of words.

    White space of ASCII never lies inside a token or changes its neighbours, so a text's ids are those of its words in turn.
    For the tokenizer's own pre-tokens the same holds; words up to U+00FF, whose normal form is lower case alone, are put
    together from these, since words differ far more than their parts do.
    """

    SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
    #: The tokenizer's pre-tokens of words up to U+00FF in small letters, and the space between words.
    LETTERS, DIGITS = "a-zª\xb5ºß-öø-ÿ", "0-9²³¹¼-¾"
    PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{DIGITS}]|[^\\s{LETTERS}{DIGITS}]+| ")
    PLAIN = re.compile("[\x21-\x7e\xa1-\xff]+")
    #: Between the ids of words: no id is as large.
    END_OF_WORD = b"\xff" * 4

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.known_parts: dict[str, bytes] = {}
        kept = json.loads(self.tokenizer.to_str())
        steps = [n.get("type") for n in (kept["normalizer"] or {}).get("normalizers", [])]
        splits = [t.get("pattern", {}).get("Regex") for t in (kept["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.special = tuple(t["content"] for t in kept["added_tokens"])
        suffix = kept["model"].get("end_of_word_suffix")
        vocabulary = kept["model"]["vocab"]
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        self.in_parts = bool(suffix) and steps == ["NFC", "Replace", "Lowercase"] and splits == [self.SPLIT, None]

    def _encode(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """The ids of each pre-token: encoded in rows, and cut after each id that ends a pre-token."""
        rows = [" ".join(parts[i:i + PARTS_A_ROW]) for i in range(0, len(parts), PARTS_A_ROW)]
        ids = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)]
        ids = np.concatenate(ids)
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(parts):
            return self._encode(parts)
        data = ids.tobytes()
        return [data[4 * a:4 * b] for a, b in zip([0, *cuts[:-1].tolist()], cuts.tolist())]

    def _plain(self, words: list[str], text: str) -> list[bool]:
        """Which words of a text, all of its words in a row, are put together from their pre-tokens."""
        if not self.in_parts:
            return [False] * len(words)
        plain = [match is not None for match in map(self.PLAIN.fullmatch, words)]
        special = [t for t in self.special if t in text]
        return [p and not any(t in w for t in special) for w, p in zip(words, plain)] if special else plain

    def _learn(self, words: list[bytes]) -> None:
        text = b" ".join(words).decode()
        texts = text.split(" ")
        plain = self._plain(texts, text)
        whole = [i for i, p in enumerate(plain) if not p]
        self.known.update(zip([words[i] for i in whole], self._encode([texts[i] for i in whole])))
        if len(whole) == len(words):
            return
        if whole:
            words, texts = ([x for x, p in zip(xs, plain) if p] for xs in (words, texts))
        found, parts = self.PARTS.findall(" ".join(texts).lower()), self.known_parts
        needed = set(found)
        missing = needed.difference(parts, " ")
        if len(parts) + len(missing) > CACHED_WORDS:
            parts.clear()
            missing = needed.difference(" ")
        if missing:
            missing = list(missing)
            parts.update(zip(missing, self._encode_parts(missing)))
        parts[" "] = self.END_OF_WORD
        self.known.update(zip(words, b"".join(map(parts.__getitem__, found)).split(self.END_OF_WORD)))

    def ids_of(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of UTF-8 texts as little-endian unsigned 32-bit numbers; what is new in a run of texts is learned at once."""
        run: list[list[bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            run.append(text.split())
            size += len(text)
            if size < LEARNED_BYTES and i + 1 < len(texts):
                continue
            known = self.known
            new = set().union(*run).difference(known)
            if len(known) + len(new) > CACHED_WORDS:
                known.clear()
                new = set().union(*run)
            if new:
                self._learn(list(new))
            for words in run:
                yield b"".join(map(known.__getitem__, words))
            for w in new:
                if len(w) > CACHED_LENGTH:
                    del known[w]
            run, size = [], 0


    def forget(self) -> None:
        """Give back the memory of words."""
        self.known, self.known_parts = {}, {}


@cache
def encoder(path: str) -> WordEncoder:
    """A process's encoder; what it learns is kept for a task, as the next stage's workers are the same processes."""
    return WordEncoder(path)


def cut_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """The pieces of every document: full windows first, then what is left; (doc_id, start, length, ids_crc32, doc_tokens).

    A document's ids are its text's (null: empty) and ``end_id``, so every row has a piece.
    """
    end = np.array([end_id], "<u4").tobytes()
    small_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        try:
            for batch in slices(batches):
                rows = []
                texts = batch.column(1).fill_null("").cast(pa.binary()).to_pylist()
                for doc_id, ids in zip(batch.column(0).to_pylist(), words.ids_of(texts)):
                    ids += end
                    for at in range(0, len(ids), 4 * window):
                        piece = ids[at:at + 4 * window]
                        rows.append((doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                if rows:
                    columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        finally:
            words.forget()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """Every piece of every document with its sequence_id and offset there (from 0, without gaps).

    Best-fit decreasing over all pieces of the corpus. What meets on the driver is the number of pieces of each length,
    ``window`` numbers at most; the pieces are numbered within their length by Spark, in buckets, so that a length that
    most pieces have is no hot group. Null texts are documents of the end id alone; repeated rows are documents of their
    own; an empty table has no pieces.
    """
    spark = docs.sparkSession
    pieces = landed(cut_documents(docs, tokenizer, end_id, window), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = 1 + sum(counts.values()) // PIECES_PER_BUCKET
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    dealt = pieces.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("length", "__bucket").orderBy(*order)) - 1
    ranked = dealt.withColumn("__place", place).join(sizes, ["length", "__bucket"]).withColumn("__rank", F.col("__place") + F.col("__before"))
    plan = spark.createDataFrame(
        best_fit_plan(counts, window), "length long, __from long, __to long, __window long, __each long, __offset long")
    nth = F.col("__rank") - F.col("__from")
    return (ranked.join(plan, "length").where((F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to")))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    (F.col("__window") + F.expr("(__rank - __from) div __each")).alias("sequence_id"),
                    (F.col("__offset") + nth % F.col("__each") * F.col("length")).alias("offset")))
