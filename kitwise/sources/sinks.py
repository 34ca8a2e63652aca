"""The CSV sink (the report as a file); ``publish`` has the dataset sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame


def default_output_name(as_of: dt.date) -> str:
    """``bom_capacity_report_YYYYMMDD`` for the as-of date."""
    return f"bom_capacity_report_{as_of.strftime('%Y%m%d')}"


def write_csv(
    df: DataFrame,
    path: str,
    overwrite: bool = False,
    header: bool = True,
    delimiter: str = ",",
    single_file: bool = False,
) -> None:
    """Write CSV; an existing target is refused unless ``overwrite``.

    NULL is written as nothing and '' as ``""``, so the two stay apart.
    ``single_file`` funnels the rows through one task; use it only for
    report-sized output.
    """
    out = df.coalesce(1) if single_file else df
    (
        out.write.mode("overwrite" if overwrite else "error")
        .option("header", str(header).lower())
        .option("sep", delimiter)
        .option("emptyValue", '""')
        .csv(path)
    )

