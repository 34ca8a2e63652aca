"""Mix sources to target weights by hash-random order and distributed prefix sums.

A document's size is its number of words. Sources in code point order (null
last) have the given weights in turn and share ``share`` of all words; no
source gets more than ``max_epochs`` times its own words, and what is cut off
is shared anew by weight until no source is above. That is one level L with
target = min(weight * L, cap): with sources in order of cap / weight, L is the
largest of (budget - caps before) / (weights from here on).

Within a source, documents lie in the order of a hash of their id. The prefix
sum of sizes in this order is made in two steps: sums of the hash's leading
digits (``DIGITS``) give each bucket its offset, and a running sum within a
bucket does the rest, so a source with a third of all rows is still spread
over all tasks. A source takes whole passes while its budget lasts and cuts the
last pass at its exact budget: documents before the cut count once more, the
document at the cut gives its first words.

Edge cases: a null text has size 0 and takes nothing; a null source is a source
of its own; a null id is ordered by the hash of ''. Rows that repeat an id
are separate documents, ordered by size. Without words every target is 0.
Other columns are not read by ``mix_plan``. The number of sources is taken to
be small against the number of documents: their table is sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kitwise.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
#: Leading hex digits of the random key that make a bucket of the prefix sum.
DIGITS = 3


def words_in(text) -> F.Column:
    """The number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, max_epochs: int) -> DataFrame:
    """(source, source_size, target) from (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(place - 1, F.lit(len(weights))) + 1)
    per = per.withColumn("place", place).withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(max_epochs))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onwards = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    per = per.withColumn("level", left / F.sum("weight").over(onwards))
    per = per.withColumn("level", F.max("level").over(everything))
    return per.select("source", "source_size", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")).alias("target"))


def mix_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    max_epochs: int = 2,
) -> DataFrame:
    """(id, source, text_hash, size, source_size, target, passes, taken) for each row of ``docs``.

    ``passes`` is the number of whole passes of the row's source; ``taken`` the
    words the mix takes from the row, repeats counted, ``max_epochs`` times its
    size at most. The words taken from a source are its target's whole part.
    """
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.xxhash64(text_col).alias("text_hash"),
        words_in(F.col(text_col)).alias("size"),
        digest.alias("key"),
    ).withColumn("bucket", F.substring("key", 1, DIGITS))
    rows = Scratch(docs.sparkSession).save(rows, "sizes")  # the texts are read once
    targets = source_targets(rows, weights, share, max_epochs)
    buckets = rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("offset", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    same = F.col("b.source").eqNullSafe(F.col("t.source"))
    buckets = buckets.alias("b").join(targets.alias("t"), same).select("b.source", "bucket", "offset", "source_size", "target")
    within = Window.partitionBy("source", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.withColumn("end", F.sum("size").over(within))
    on = F.col("r.source").eqNullSafe(F.col("b.source")) & (F.col("r.bucket") == F.col("b.bucket"))
    placed = ends.alias("r").join(buckets.alias("b"), on)
    budget = F.floor("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - passes * F.col("source_size")
    begin = F.col("offset") + F.col("end") - F.col("size")
    part = F.least(F.greatest(rest - begin, F.lit(0)), F.col("size"))
    return placed.select(
        F.col("r.id").alias(id_col),
        F.col("r.source").alias(source_col),
        "text_hash",
        "size",
        "source_size",
        "target",
        passes.alias("passes"),
        (passes * F.col("size") + part).cast("long").alias("taken"),
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **params) -> DataFrame:
    """The mix as rows: each row of ``docs`` once a pass.

    Of the one document at a source's cut, whole rows are made: it counts as
    taken in the last pass if at least half of its words are. Documents without
    words are in no pass.
    """
    plan = mix_plan(docs, id_col, text_col, source_col, **params)
    part = F.col("taken") - F.col("passes") * F.col("size")
    copies = F.when(F.col("size") > 0, F.col("passes") + (2 * part >= F.col("size")).cast("long")).otherwise(0)
    # rows that repeat in every respect share their copies
    copies = (
        plan.withColumn("copies", copies)
        .groupBy(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), F.col("text_hash").alias("_hash"))
        .agg(F.sum("copies").alias("_copies"))
        .where("_copies > 0")
    )
    own = docs.withColumn("_own", F.xxhash64(text_col))
    same = own[id_col].eqNullSafe(copies["_id"]) & own[source_col].eqNullSafe(copies["_source"]) & (own["_own"] == copies["_hash"])
    first = Window.partitionBy("_id", "_source", "_hash").orderBy("_own")
    rows = own.join(copies, same).withColumn("_nth", F.row_number().over(first)).where("_nth = 1")
    return rows.withColumn("_pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*docs.columns)
