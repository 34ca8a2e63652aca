"""URL filter: longest matching rule, else gradient-boosted trees on lexical features.

A rule is a host and a path prefix ("example.com/en/"); it fits that host and
all its subdomains if the URL's path starts with the rule's, and the longest
fitting rule decides. The URLs that a rule decides are the labelled URLs: trees
are boosted on them and judge the rest.

Features: lengths of URL, host and path, path depth, host labels, digit ratio,
entropy of the characters, number of parameters, fragment, scheme, and smoothed
block rates of the host's last label, its last two labels, the path's first
segment and its file ending ("suffix statistics", from the training rows).

Training reads a bounded sample: the ``max_train`` labelled URLs with the
smallest hashes. The suffix tables have at most that many rows, which bounds
their broadcast.

Edge cases: a null URL, or one without ``://``, has an empty host and path; no
rule fits it and the trees judge it by its other features. If the labelled
URLs have one verdict only, every other URL gets it; without any, ``default``.
Rows that repeat are judged alike, and count once in training. Other columns
are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kitwise.llm.scratch import Scratch

ALLOW, BLOCK = "allow", "block"
NUMBERS = (
    "url_length", "host_length", "path_length", "depth", "labels", "digits", "entropy", "params", "fragment", "secure",
)
SUFFIXES = ("last_label", "last_two_labels", "first_segment", "ending")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    after = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null without one."""
    rule = verdict = F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # a longer rule is asked first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def with_features(df: DataFrame, url_col: str, host: str, path: str) -> DataFrame:
    """``df`` with the number features and the four suffix keys."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    n = F.greatest(F.length(url), F.lit(1))
    share = lambda c: (F.length(url) - F.length(F.replace(url, c, F.lit("")))) / n
    letters = F.array_distinct(F.split(url, ""))
    shares = F.filter(F.transform(F.filter(letters, lambda c: c != ""), share), lambda p: p > 0)
    labels = F.split(F.col(host), r"\.")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    values = {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.length(path) - F.length(F.replace(F.col(path), F.lit("/"), F.lit(""))),
        "labels": F.size(labels),
        "digits": F.length(F.regexp_replace(url, "[^0-9]", "")) / n,
        "entropy": -F.aggregate(shares, F.lit(0.0), lambda s, p: s + p * F.log2(p)),
        "params": F.when(query == "", 0).otherwise(F.size(F.split(query, "&"))),
        "fragment": F.contains(url, F.lit("#")),
        "secure": F.startswith(url, F.lit("https://")),
        "last_label": F.element_at(labels, -1),
        "last_two_labels": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2))),
        "first_segment": F.regexp_extract(path, r"^/([^/]*)/", 1),
        "ending": F.regexp_extract(path, r"(\.[A-Za-z0-9]{1,8}|/)$", 1),
    }
    return df.withColumns({k: v.cast("double") if k in NUMBERS else v for k, v in values.items()})


def suffix_tables(sample: DataFrame, prior: float) -> dict[str, DataFrame]:
    """For each suffix key its smoothed block rate in the sample: at most as many rows as the sample has."""
    rate = (F.sum("label") + 2 * prior) / (F.count("*") + 2)
    return {k: sample.groupBy(k).agg(rate.alias(f"{k}_rate")) for k in SUFFIXES}


def with_rates(df: DataFrame, tables: dict[str, DataFrame], prior: float) -> DataFrame:
    """``df`` with the block rates of its suffixes; one that the sample doesn't have gets the sample's rate."""
    for k, t in tables.items():
        df = df.join(F.broadcast(t), k, "left").fillna({f"{k}_rate": prior})
    return df


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    max_train: int = 10000,
    trees: int = 20,
    depth: int = 4,
    default: str = ALLOW,
    seed: int = 3,
    hold_out: Column | None = None,
) -> DataFrame:
    """(id, host, path, rule, verdict, block_score) for each row of ``pages``.

    ``block_score`` is the trees' probability of a block, null where a rule
    decides. Rules don't decide rows of ``hold_out``, to measure the trees.
    """
    scratch = Scratch(pages.sparkSession)
    host, path = host_and_path(F.col(url_col))
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"), *([hold_out.alias("hold_out")] if hold_out is not None else []))
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    if hold_out is not None:
        rule, says = (F.when(~F.col("hold_out"), c) for c in (rule, says))
    base = base.withColumns({"rule": rule, "says": says})
    labelled = base.where("says is not null").groupBy("url", "host", "path").agg(F.max("says").alias("says"))
    sample = labelled.orderBy(F.xxhash64("url"), "url").limit(max_train)
    sample = with_features(sample.withColumn("label", (F.col("says") == BLOCK).cast("double")), "url", "host", "path")
    sample = scratch.save(sample.coalesce(1), "sample")
    verdicts = sorted(r[0] for r in sample.select("says").distinct().collect())  # two at most
    if len(verdicts) < 2:
        verdict = F.coalesce("says", F.lit(verdicts[0] if verdicts else default))
        scratch.keep_only()
        return base.select(
            F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), F.lit(None).cast("double").alias("block_score")
        )
    prior = sample.agg(F.avg("label")).first()[0]
    tables = suffix_tables(sample, prior)
    tables = {k: scratch.save(t.coalesce(1), k) for k, t in tables.items()}
    columns = [*NUMBERS, *(f"{k}_rate" for k in SUFFIXES)]
    vectors = VectorAssembler(inputCols=columns, outputCol="features")
    gbt = GBTClassifier(labelCol="label", featuresCol="features", maxIter=trees, maxDepth=depth, seed=seed, maxBins=32)
    model = gbt.fit(vectors.transform(with_rates(sample, tables, prior)).select("features", "label"))
    scored = model.transform(vectors.transform(with_rates(with_features(base, "url", "host", "path"), tables, prior)))
    block = vector_to_array("probability")[1]
    trees_say = F.when(F.col("prediction") > 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("says", trees_say).alias("verdict"),
        F.when(F.col("says").isNull(), block).alias("block_score"),
    )
