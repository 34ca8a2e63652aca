"""The report job: inputs in, the published report out.

``run_report`` builds the stage graph, materializes the stages many others
read on first use, runs the sink and deletes what it wrote. ``main`` is a small
command line over Parquet files or catalog tables, with CSV or Parquet output.
"""

from __future__ import annotations

import argparse
import csv
import dataclasses
import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kitwise.params import REVISION_SEGMENT_PATTERN, LocationRule, ReportParams, ShipmentFields, SourceColumns
from kitwise.plans.stages import ReportStages
from kitwise.sources.publish import publish_folder, publish_table
from kitwise.sources.sinks import default_output_name, write_csv
from kitwise.sources.tables import INPUT_NAMES, ReportInputs, from_tables


def run_report(
    inputs: ReportInputs,
    params: ReportParams,
    sink: Callable[[DataFrame], None],
    published: bool = True,
    materialize: str = "table",
    sort_by_path: bool = True,
) -> None:
    """Build the report and hand it to ``sink``.

    The stages many others read are written once as tables under the
    session's checkpoint directory (``materialize="table"``) and deleted when
    the sink is done. Rows are ordered by path, as the report is published
    (a range-partitioned sort at the sink only).
    """
    stages = ReportStages(inputs, params, materialize=materialize)
    try:
        df = stages.report_final if published else stages.report_raw
        if sort_by_path:
            df = df.orderBy(df.columns[0])
        sink(df)
    finally:
        stages.release()


def with_names(base, pairs: list[str]):
    """``base`` (a dataclass of column names) with the FIELD=NAME pairs put in; a tuple field takes NAME,NAME,..."""
    known = {f.name: getattr(base, f.name) for f in dataclasses.fields(base)}
    new = {}
    for pair in pairs:
        name, equals, value = pair.partition("=")
        if not equals or name not in known:
            raise SystemExit(f"{pair!r} is not one of {', '.join(sorted(known))} with =NAME")
        new[name] = tuple(value.split(",")) if isinstance(known[name], tuple) else value
    return dataclasses.replace(base, **new)


def read_inputs(spark: SparkSession, input_dir: str | None, tables: str | None) -> ReportInputs:
    """Inputs from catalog tables (a JSON file of {input: table}) or from one Parquet path per input."""
    if tables:
        with open(tables) as f:
            return from_tables(spark, json.load(f))
    return from_tables(spark, {n: f"{input_dir}/{n}.parquet" for n in INPUT_NAMES}, fmt="parquet")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Supply coverage report over Parquet files or catalog tables.")
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--input-dir", help="directory with one <name>.parquet per input")
    source.add_argument("--tables", help="JSON file that maps each input to a catalog table")
    ap.add_argument("--column", action="append", default=[], metavar="FIELD=NAME", help="name of a source column")
    ap.add_argument(
        "--shipment-column",
        action="append",
        default=[],
        metavar="FIELD=NAME[,NAME...]",
        help="column names of the shipment sources, first choice first",
    )
    ap.add_argument("--revision-pattern", default=REVISION_SEGMENT_PATTERN, help="pattern of a revision in a path")
    ap.add_argument("--po-cost-label", default=ReportParams.po_cost_label)
    ap.add_argument("--forecast-cost-label", default=ReportParams.forecast_cost_label)
    ap.add_argument("--as-of", default=None, help="as-of date YYYY-MM-DD (default: today)")
    ap.add_argument("--output", default=None, help="output directory, or table name (default: dated name)")
    ap.add_argument("--format", choices=("csv", "parquet", "table"), default="csv")
    ap.add_argument("--table-folder", default=None, help="with --format table: folder of the table's versions")
    ap.add_argument("--overwrite", action="store_true", help="replace an existing output")
    ap.add_argument("--no-header", action="store_true")
    ap.add_argument("--delimiter", default=",")
    ap.add_argument("--single-file", action="store_true", help="write one CSV part file")
    ap.add_argument("--raw", action="store_true", help="write the raw report instead of the published one")
    ap.add_argument("--since", default="2025-01-01", help="first day of stock movements counted")
    ap.add_argument("--buy-intent", default="company_buy", help="procurement intent of bought lines")
    ap.add_argument(
        "--location-rules",
        default=None,
        help="CSV file of ordered 'pattern,category' rows (SQL LIKE patterns, first match wins)",
    )
    args = ap.parse_args(argv)
    if (args.format == "table") != (args.table_folder is not None):
        ap.error("--format table and --table-folder go together")

    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else dt.date.today()
    rules: tuple[LocationRule, ...] = ()
    if args.location_rules:
        with open(args.location_rules, newline="") as f:
            rules = tuple(LocationRule(r[0], r[1]) for r in csv.reader(f) if r)
    params = ReportParams(
        as_of=as_of,
        since=dt.date.fromisoformat(args.since),
        buy_intent=args.buy_intent,
        location_rules=rules,
        revision_pattern=args.revision_pattern,
        columns=with_names(SourceColumns(), args.column),
        shipments=with_names(ShipmentFields(), args.shipment_column),
        po_cost_label=args.po_cost_label,
        forecast_cost_label=args.forecast_cost_label,
    )
    spark = SparkSession.builder.appName("kitwise-report").getOrCreate()
    inputs = read_inputs(spark, args.input_dir, args.tables)
    out = args.output or default_output_name(as_of)

    def sink(df: DataFrame) -> None:
        if args.format == "csv":
            write_csv(
                df,
                out,
                overwrite=args.overwrite,
                header=not args.no_header,
                delimiter=args.delimiter,
                single_file=args.single_file,
            )
        elif args.format == "table":
            publish_table(df, out, args.table_folder, overwrite=args.overwrite)
        else:
            publish_folder(df, out, overwrite=args.overwrite)

    run_report(inputs, params, sink, published=not args.raw)


if __name__ == "__main__":
    main()
