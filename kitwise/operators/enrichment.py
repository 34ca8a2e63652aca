"""Line enrichment (stages C1-C3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_structure(lines: DataFrame, structured: DataFrame) -> DataFrame:
    """Product, variant, system, subsystem by plain path (may multiply rows)."""
    s = structured.select(
        F.col("path_without_rev").alias("_s_path"),
        F.col("product"),
        F.col("variant"),
        F.col("system"),
        F.col("subsystem"),
    )
    return lines.join(s, lines["path_without_revision"] == s["_s_path"], "left").drop("_s_path")


def with_commodity(lines: DataFrame, flat: DataFrame) -> DataFrame:
    """Commodity by part (may multiply rows). This is the report's spine."""
    f = flat.select(F.col("part_number").alias("_f_part"), F.col("new_commodity").alias("commodity"))
    return lines.join(f, lines["part_number"] == f["_f_part"], "left").drop("_f_part")


def report_parts(spine: DataFrame) -> DataFrame:
    """Distinct non-NULL parts of the report."""
    return spine.where(F.col("part_number").isNotNull()).select("part_number").distinct()
