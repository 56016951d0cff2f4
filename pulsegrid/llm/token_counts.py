"""Token counts of a unigram vocabulary: Aho-Corasick finds the pieces, Viterbi keeps the best score and its piece count."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

META = "▁"
UNKNOWN_PENALTY = 10.0
#: White space of the library; Python's also has these separators.
SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
SEPARATORS = re.compile("[\x1c-\x1f]")
CACHED_WORDS, CACHED_LENGTH = 400_000, 64


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores, and whether characters that no piece covers count as their UTF-8 bytes."""

    pieces: tuple[tuple[str, float], ...]
    byte_fallback: bool = True

    @staticmethod
    def from_sentencepiece(path: str) -> Vocabulary:
        """The pieces and scores of a SentencePiece model file; its bytes and control pieces match no text."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return Vocabulary(tuple(
            (model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))),
            any(model.is_byte(i) for i in range(model.get_piece_size())))


class Counter:
    """Counts the pieces of the best segmentation of texts, a word at a time, with a bounded memory of words.

    The rules of the unigram model of the ``tokenizers`` library: each word starts with U+2581, put before it where it is not there; a character that is no piece
    scores 10 below the lowest score; of paths that score the same, the one whose last piece starts first stays; runs of
    unknown characters are one piece, or their bytes.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.byte_fallback = vocabulary.byte_fallback
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces:
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary.pieces:
            self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary.pieces), default=0.0) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, float, int]] = {}
        self.some = bool(vocabulary.pieces)

    def word(self, word: str) -> tuple[int, float, int]:
        """(pieces, score, unknown characters) of the best path over a word without white space."""
        n = len(word)
        matches: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if self.some:
            for end, (size, score) in self.automaton.iter(word):
                matches[end].append((size, score))
        best, last = [0.0] * (n + 1), [(0, True)] * (n + 1)
        for end in range(1, n + 1):
            found = sorted(matches[end - 1], reverse=True)  # the earliest start first
            if not found or found[-1][0] != 1:
                found.append((1, self.unknown))
                single = False
            else:
                single = True
            top = None
            for size, score in found:
                total = best[end - size] + score
                if top is None or total > top:
                    top, last[end] = total, (size, size > 1 or single)
            best[end] = top
        pieces = unknown = 0
        at, run = n, False
        while at:
            size, known = last[at]
            if known:
                pieces += 1
            else:
                unknown += 1
                pieces += len(word[at - 1].encode()) if self.byte_fallback else not run
            run = not known
            at -= size
        return pieces, best[n], unknown

    def text(self, text: str) -> tuple[int, float, int]:
        known, total, score, unknown = self.known, 0, 0.0, 0
        for raw in filter(None, SPACE.split(text)) if SEPARATORS.search(text) else text.split():
            got = known.get(raw)
            if got is None:
                got = self.word(raw if raw.startswith(META) else META + raw)
                if len(raw) <= CACHED_LENGTH:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    known[raw] = got
            total += got[0]
            score += got[1]
            unknown += got[2]
        return total, score, unknown


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_tokens, token_score, n_unknown)`` of every row: pieces, score and unknown characters of the best segmentation.

    Words are runs without white space. Null and empty texts have no tokens and score 0; repeated rows repeat; an empty
    vocabulary leaves only unknown characters. Texts are read whole; only the count and score are kept, not the pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary)
        for batch in batches:
            rows = [counter.text(t or "") for t in batch.column(1).to_pylist()]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n_tokens", "token_score", "n_unknown"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "id long, n_tokens long, token_score double, n_unknown long")
