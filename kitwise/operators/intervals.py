"""Prefix ancestors by interval encoding.

All paths of all groups are sorted once, by a range exchange. Each ancestor adds
two marks to the order: one after the rows of its own path, one after
everything that begins with its path (the path's bytes and 0xFF, a byte that
no text has). The rows between the two marks are its descendants, so from here
on ancestry is a comparison of row numbers and no path text is moved.

The numbers meet in bins. An interval goes to the bins of the smallest of
``LEVELS`` (bits of a bin's width) that is not shorter than itself, two at
most; intervals longer than the widest bin go to every bin they touch. A row
is in one bin of each level. So a bin holds at most ``1 << LEVELS[-1]`` rows
however many lines a group has, and paths that share no ancestor seldom meet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kitwise.plans.scratch import Folder

LEVELS = (4, 8, 12, 16)


def _numbered(marks: DataFrame, order: Sequence[str], folder: Folder) -> DataFrame:
    """``marks`` with ``pos``, the row's number in the order (from 0, without gaps)."""
    partitions = int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parted = marks.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    # the part in the upper bits, the row's number in the part in the lower 33
    parted = folder.write(parted.withColumn("at", F.monotonically_increasing_id()), "sorted")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = parted.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    offsets = folder.write(sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "offsets")
    numbered = parted.withColumn("part", part).join(offsets, "part")
    return numbered.withColumn("pos", F.col("offset") + place).drop("part", "offset", "at")


def _level(length: Column, levels: Sequence[int]) -> Column:
    out = F.lit(levels[-1])
    for k in reversed(levels[:-1]):
        out = F.when(length < (1 << k), F.lit(k)).otherwise(out)
    return out


def prefix_pairs(rows: DataFrame, ancestors: DataFrame, group: Sequence[str], path: str, levels: Sequence[int] = LEVELS) -> DataFrame:
    """Each pair of a row and an ancestor of its group whose path is a proper prefix of the row's.

    ``rows`` and ``ancestors`` have the columns ``group`` and ``path`` and
    others of their own names. Returns the other columns of both and ``group``.
    Rows that repeat make pairs of their own; a NULL group or path makes none.
    """
    own = [c for c in rows.columns if c not in (*group, path)]
    theirs = [c for c in ancestors.columns if c not in (*group, path)]
    key = [*group, path]
    folder = Folder(rows.sparkSession, "kitwise-intervals")
    some = lambda df: df.where(F.expr(" AND ".join(f"{c} IS NOT NULL" for c in key)))
    text = F.col(path).cast("binary")
    row_marks = some(rows).select(*group, text.alias("bytes"), F.lit(0).alias("kind"), F.struct(*own).alias("row"))
    counted = some(ancestors).groupBy(*ancestors.columns).agg(F.count("*").alias("n"))
    # two 64-bit hashes tell ancestors apart
    ident = F.struct(*[F.xxhash64(F.lit(i), *ancestors.columns).alias(f"h{i}") for i in range(2)])
    ends = F.explode(F.array(F.struct(text.alias("bytes"), F.lit(1).alias("kind")), F.struct(F.concat(text, F.lit(b"\xff")).alias("bytes"), F.lit(2).alias("kind"))))
    marks = counted.select(*group, ends.alias("mark"), ident.alias("ident"), F.struct(*theirs, "n").alias("ancestor"))
    marks = marks.select(*group, "mark.bytes", "mark.kind", "ident", F.when(F.col("mark.kind") == 1, F.col("ancestor")).alias("ancestor"))
    numbered = _numbered(row_marks.unionByName(marks, allowMissingColumns=True), [*group, "bytes", "kind"], folder)

    members = numbered.where("kind = 0").select("pos", *group, "row.*")
    spans = numbered.where("kind > 0").groupBy("ident").agg(
        F.max(F.when(F.col("kind") == 1, F.col("pos"))).alias("begin"),
        F.max(F.when(F.col("kind") == 2, F.col("pos"))).alias("end"),
        F.first("ancestor", ignorenulls=True).alias("ancestor"),
    )
    spans = spans.where(F.col("end") - F.col("begin") > 1).select("begin", "end", "ancestor.*")
    spans = spans.withColumn("level", _level(F.col("end") - F.col("begin"), levels))
    bins = F.expr("sequence(shiftright(begin, level), shiftright(end, level))")
    spans = spans.withColumn("bin", F.explode(bins)).withColumnRenamed("level", "span_level").withColumnRenamed("bin", "span_bin")
    seats = F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("pos", k).alias("bin")) for k in levels]))
    seated = members.select("pos", seats.alias("seat")).select("pos", "seat.level", "seat.bin")
    pairs = seated.join(
        spans,
        (F.col("level") == F.col("span_level")) & (F.col("bin") == F.col("span_bin")) & (F.col("pos") > F.col("begin")) & (F.col("pos") < F.col("end")),
    ).select("pos", *theirs, F.explode(F.expr("sequence(1, n)")).alias("copy"))
    return pairs.drop("copy").join(members, "pos").select(*own, *theirs, *group)
