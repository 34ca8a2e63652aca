"""Corpus pipeline: quality classifier, near-duplicates, mixing, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kitwise.llm import mixing, neardup, pieces, quality
from kitwise.llm.queries import MODEL, TOKENIZERS, graded_labels, table
from kitwise.llm.scratch import Scratch

#: The chance of the highest grade from which a document is kept.
LEAST_TAIL = 0.5
#: Near-duplicates: words in a shingle, Jaccard similarity.
SHINGLE, SIMILARITY = 5, "0.8"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier expects to be good; the others go."""
    model = quality.train(docs, graded_labels(table(spark, sf_dir, "labels")), 3)
    return quality.select(docs, model, least=LEAST_TAIL)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.without_near_duplicates(docs, k=SHINGLE, threshold=SIMILARITY)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents of all sources at their target weights, repeated where a source takes another pass."""
    return mixing.mixed(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of each document of the mix, checked by decoding."""
    return pieces.encode(docs, f"{TOKENIZERS}/{MODEL}")


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", minhash_near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", sentencepiece),
]

#: A trained classifier and a tokenizer can't be expressed in SQL; tests/llm tests the operators of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"stage-{i}")
    scratch.keep_only(f"stage-{len(STAGES) - 1}")
    return docs
