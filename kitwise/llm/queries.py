"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kitwise.llm import dialogs, hmm, html_text, idfile, imatch, lexical, licenses, mixing, neardup, pieces, quality, topk, urls

#: Where the public tokenizers' vocabulary files are.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
MODEL = "piece_bpe_32k.model"
BYTE_BPE = "byte_bpe_50k.json"

URL_RULES = (
    ("com/", urls.ALLOW),
    ("example.com/en/", urls.BLOCK),
    ("www.example.com/en/", urls.ALLOW),
    ("net/es/", urls.BLOCK),
    ("net/fr/", urls.BLOCK),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def graded_labels(labels: DataFrame) -> DataFrame:
    """Grades from the two labels: 0 low quality, 1 toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) > 0, 1).when(F.col("quality") > 0, 2)
    return labels.select("doc_id", grade.alias("grade"))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/{MODEL}", parity=True)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=3, threshold="0.85")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, graded_labels(table(spark, sf_dir, "labels")), 3)
    out = quality.grade(docs, model)
    return out.withColumn("selected", F.col("tail_prob") >= 0.5)


def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_fingerprints(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_documents(table(spark, sf_dir, "documents"))


def op11_idfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfile.write_and_check(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/{BYTE_BPE}", end_id=2)


def op12_dialogs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogs.repair_damaged(table(spark, sf_dir, "conversations"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_sentencepiece, op2_url_filter, op3_topk, op4_minhash, op5_license_scan,
        op6_quality, op7_imatch, op8_mixing, op9_html_text, op10_hmm,
        op11_idfile, op12_dialogs, op13_lexical,
    )
    return {f.__name__: f for f in own}
