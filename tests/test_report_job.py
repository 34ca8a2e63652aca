"""The report job's command line, and sources whose column names differ."""

import json
from dataclasses import replace

import helpers as h
import pytest
from pyspark.sql import functions as F

from kitwise.operators.transit import latest_shipments, shipment_lines
from kitwise.params import ShipmentFields, SourceColumns
from kitwise.plans.report_job import main, with_names
from kitwise.sources.drift import first_parsed, first_text
from kitwise.sources.tables import INPUT_NAMES

BOM = [
    h.bom_row("|CART|", "CART", "CART", 1, indent=0),
    h.bom_row("|CART|WHEEL|", "WHEEL", "CART", 4),
]


def test_job_from_renamed_tables_and_columns(spark, empty_inputs, tmp_path):
    inputs = h.make_inputs(
        spark, empty_inputs, bom=BOM, demand=h.demand_rows([("CART", "R1")]),
        inventory=h.inventory_rows({"WHEEL": 12}), stock_location=h.locations(),
    )
    names = {n: f"job_{n}" for n in INPUT_NAMES}
    for n, table in names.items():
        df = getattr(inputs, n)
        if n == "inventory":
            df = df.withColumnsRenamed({"default_code": "sku", "quantity": "pieces", "stock_location_id": "place"})
        df.createOrReplaceTempView(table)
    (tmp_path / "tables.json").write_text(json.dumps(names))
    (tmp_path / "rules.csv").write_text("WH%,Warehouse\nRCV%,Receiving & Pre-IQC\n")
    columns = [x for c in ("inventory_part=sku", "inventory_quantity=pieces", "inventory_location=place") for x in ("--column", c)]
    main([
        "--tables", str(tmp_path / "tables.json"), "--location-rules", str(tmp_path / "rules.csv"), "--as-of", h.AS_OF.isoformat(),
        "--buy-intent", "buy", "--output", str(tmp_path / "out"), "--format", "parquet", "--raw", *columns,
    ])
    got = {r["path"]: (r["on_hand"], r["total_rolled_up_quantity"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"|CART|": (None, 1.0), "|CART|WHEEL|": (12.0, 4.0)}


def test_names_are_checked():
    assert with_names(SourceColumns(), ["plan_date=day"]).plan_date == "day"
    assert with_names(ShipmentFields(), ["part_candidates=a,b"]).part_candidates == ("a", "b")
    with pytest.raises(SystemExit):
        with_names(SourceColumns(), ["no_such_field=x"])


FIELDS = ShipmentFields()


@pytest.mark.parametrize("candidates", [FIELDS.part_candidates, FIELDS.status_candidates, FIELDS.id_candidates])
def test_first_text_candidate_that_has_a_value_wins(spark, candidates):
    for i in range(len(candidates)):
        row = [None if k < i else f"value {k}" for k in range(len(candidates))]
        df = spark.createDataFrame([tuple(row)], ", ".join(f"{c} string" for c in candidates))
        assert df.select(first_text(df, candidates).alias("x")).first()["x"] == f"value {i}"


@pytest.mark.parametrize(
    "candidates,kind,good",
    [(FIELDS.updated_candidates, "timestamp_ntz", "2026-01-0{}"), (FIELDS.quantity_candidates, "double", "{}.5")],
)
def test_first_candidate_that_parses_wins(spark, candidates, kind, good):
    for i in range(len(candidates)):
        row = ["junk" if k < i else good.format(k + 1) for k in range(len(candidates))]
        df = spark.createDataFrame([tuple(row)], ", ".join(f"{c} string" for c in candidates))
        got = df.select(first_parsed(df, candidates, kind).cast("string").alias("x")).first()["x"]
        assert got.startswith(good.format(i + 1))


def test_shipments_with_drifting_columns(spark):
    ships = spark.createDataFrame(
        [("7", None, "moving", "junk", "2026-01-02"), ("7", "done", None, "2026-01-01", None)],
        "id string, state string, status string, updated_at string, created_at string",
    )
    lines = spark.createDataFrame([("7", "P1", "n/a", 3.0)], "shipment_id string, part_number string, quantity string, product_qty double")
    got = shipment_lines(lines, latest_shipments(ships, h.PARAMS), h.PARAMS).collect()
    assert [tuple(r) for r in got] == [("P1", 3.0, "MOVING")]


def test_shipments_as_row_objects_with_fields_that_differ_by_row(spark):
    """JSON text, VARIANT and plain columns give the same; junk has no fields."""
    params = replace(h.PARAMS, shipments=replace(h.PARAMS.shipments, row_object="doc", configured_quantity="Pieces"))
    ships = [
        '{"shipment_id": "7", "state": "moving", "updated_at": "junk", "CREATED_AT": "2026-01-02"}',
        '{"ID": 7, "STATUS": "done", "WRITE_DATE": "2026-01-01"}',
        '{"id": "8", "status": null, "shipment_status": "arrived", "x": {"state": "no"}}',
        "no json", None, "[1]",
    ]
    lines = [
        '{"shipment_id": 7, "part_number": "P1", "quantity": "n/a", "product_qty": 3.5}',
        '{"SHIPMENT_ID": "8", "DEFAULT_CODE": "P2", "PART_NUMBER": "no", "Pieces": 2, "quantity": 9}',
        '{"shipment_id": "9", "part_number": "P3"}', '{"part_number": "P4"}', "",
    ]
    text = lambda rows: spark.createDataFrame([(r,) for r in rows], "doc string")
    variant = lambda rows: text(rows).select(F.try_parse_json("doc").alias("DOC"))
    for make in (text, variant):
        got = shipment_lines(make(lines), latest_shipments(make(ships), params), params).collect()
        assert sorted(map(tuple, got)) == [("P1", 3.5, "MOVING"), ("P2", 2.0, "ARRIVED")]
    mixed = text(lines).withColumn("quantity", F.lit("1"))
    got = shipment_lines(mixed, latest_shipments(text(ships), params), params).collect()
    assert sorted(map(tuple, got)) == [("P1", 1.0, "MOVING"), ("P2", 2.0, "ARRIVED")]
