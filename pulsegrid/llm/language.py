"""Language ID by error-correcting output codes: binary n-gram classifiers predict the bits of language codewords."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.graph import small_batches

UNKNOWN = "und"
CHUNK = 1 << 20
SPACES = re.compile(rb" +")
#: Bytes that are no part of a letter become spaces; those of non-ASCII characters stay.
LETTERS = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def held_out(doc_id: int | None, modulus: int, remainder: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus == remainder


def profile(text: str, features: int) -> np.ndarray:
    """Counts of the hashed byte 3-grams of the lower-cased letters of a whole text, words set apart by one space."""
    data = SPACES.sub(b" ", b" " + text.lower().encode().translate(LETTERS) + b" ")
    counts = np.zeros(features, np.int64)
    for at in range(0, len(data) - 2, CHUNK):
        b = np.frombuffer(data, np.uint8, min(CHUNK + 2, len(data) - at), at).astype(np.uint32)
        code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
        counts += np.bincount((code * np.uint32(2654435761)) >> np.uint32(32 - (features.bit_length() - 1)), minlength=features)
    return counts


def codewords(n_classes: int, seed: int = 7) -> np.ndarray:
    """A row of bits per class: every split of up to 7 classes into two sides, else the best of random dense codes."""
    if n_classes == 1:
        return np.ones((1, 1), np.int8)
    if n_classes <= 7:
        sides = [s for k in range(n_classes) for s in combinations(range(1, n_classes), k) if k < n_classes - 1]
        return np.array([[c == 0 or c in s for s in sides] for c in range(n_classes)], np.int8)
    rng, best, spread = np.random.default_rng(seed), None, -1
    for _ in range(200):
        code = rng.integers(0, 2, (n_classes, 15 * (n_classes - 1).bit_length()), np.int8)
        code = code[:, (code.sum(0) > 0) & (code.sum(0) < n_classes)]
        gap = min(int((code[i] != code[j]).sum()) for i, j in combinations(range(n_classes), 2))
        if gap > spread:
            best, spread = code, gap
    return best


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray       # languages x bits
    weights: np.ndarray    # features x bits: log odds of a bit, given an n-gram
    certainty: np.ndarray  # bits: mean size of the training classes' own margins; weighs the losses

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, ambiguous). ``und``, 0 and True without letters or without a learned language."""
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0, True
        counts = profile(text, len(self.weights))
        margin = counts @ self.weights / counts.sum()
        scaled = margin / self.certainty
        signs = 2.0 * self.code - 1
        loss = (np.log1p(np.exp(-4 * signs * scaled)) * self.certainty).sum(1) / self.certainty.sum()
        order = np.argsort(loss, kind="stable")
        weight = np.exp(-6 * (loss - loss[order[0]]))
        score = float(weight[order[0]] / weight.sum())
        return self.languages[order[0]], score, bool(len(order) > 1 and loss[order[1]] - loss[order[0]] < AMBIGUOUS)


#: Two codewords whose mean losses differ by less than this are both plausible.
AMBIGUOUS = 0.02


def fit(docs: DataFrame, features: int = 1 << 13, modulus: int = 4, remainder: int = 2) -> LanguageModel:
    """A model from all rows whose lang is not null and whose crc32(doc_id) leaves another remainder.

    Counts of hashed 3-grams are summed by language in the tasks and then by Spark; the driver gets one row of
    ``features`` numbers a language, whatever the corpus. Each bit's classifier is the log odds of the n-grams'
    mean frequencies on its two sides. No labelled row: a model that answers ``und``.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for doc_id, text, lang in zip(*(c.to_pylist() for c in batch.columns)):
                if lang is not None and text and not held_out(doc_id, modulus, remainder):
                    counts = profile(text, features)
                    sums[lang] = counts if lang not in sums else sums[lang] + counts
        for lang, counts in sums.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at), pa.array(counts[at])], ["lang", "feature", "n"])

    small_batches(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    rows = (narrow.mapInArrow(counted, "lang string, feature long, n long")
            .groupBy("lang", "feature").agg(F.sum("n").alias("n")).groupBy("lang")
            .agg(F.collect_list(F.struct("feature", "n")).alias("counts")).collect())
    languages = tuple(sorted(r["lang"] for r in rows))
    share = np.zeros((len(languages), features))
    for r in rows:
        for feature, n in r["counts"]:
            share[languages.index(r["lang"]), feature] = n
    share /= np.maximum(1, share.sum(1, keepdims=True))
    if not languages:
        return LanguageModel((), np.zeros((0, 1), np.int8), np.zeros((features, 1)), np.ones(1))
    code = codewords(len(languages))
    sides = [(code == b).astype(float) / np.maximum(1, (code == b).sum(0)) for b in (1, 0)]
    ones, zeros = ((side.T @ share).T + 1e-6 for side in sides)
    weights = np.log(ones) - np.log(zeros)
    certainty = np.maximum(1e-6, np.abs(share @ weights).mean(0))
    return LanguageModel(languages, code, weights, certainty)


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``docs`` with lang_pred, lang_score and lang_ambiguous (columns of those names are replaced).

    Only the text is looked at. Null, empty and letterless texts are ``und`` with score 0 and ambiguous; a tie goes to the
    first language by name; repeated rows get the same answer; the model is bounded by languages x features.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, lang_score double, lang_ambiguous boolean")
    def predicted(texts):
        import pandas as pd

        return pd.DataFrame([shared.value.predict(t) for t in texts], columns=["lang_pred", "lang_score", "lang_ambiguous"])

    out = [c for c in docs.columns if c not in ("lang_pred", "lang_score", "lang_ambiguous")]
    return docs.withColumn("__lang", predicted(F.col("text").cast("string"))).select(*out, "__lang.*")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (columns as they are) with a language that the model knows and does not doubt."""
    return identify(docs, fit(docs)).where((F.col("lang_pred") != UNKNOWN) & ~F.col("lang_ambiguous")).select(docs.columns)
