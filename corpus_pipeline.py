"""The corpus pipeline: language ID, near-duplicates, benchmark items, secrets, packing.

Each stage works on what the one before kept, which is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import decontamination, language, packing, secrets, simhash
from pulsegrid.llm.graph import landed, read
from pulsegrid.llm.queries import tokenizer_path


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows: those that it cannot name or doubts go."""
    return language.keep_identified(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: shingles of 4 words, at most 4 bits apart."""
    return simhash.keep_first(docs, words=4, distance=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.keep_uncontaminated(docs, read(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, each with its place in a sequence of 2048 tokens."""
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language", identified),
    ("near_duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("secrets", redacted),
    ("packing", packed),
]

#: The stages' models, fingerprints and tokenizer are beyond SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
