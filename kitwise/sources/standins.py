"""Stand-in report inputs derived from the driver's test tables.

The test data has no bill of materials, purchasing or warehouse tables, so
every input the report reads is derived here from ``part``, ``orders``,
``lineitem``, ``supplier`` and ``events`` with plain DataFrame expressions.
All of them grow with the scale factor; nothing is a fixed small table except
two literal alternate groups mixed into a data-derived one.

The same derivations exist as DuckDB SQL in ``oracle/standins.py``.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kitwise.functions.paths import plain_path
from kitwise.params import LocationRule, ReportParams
from kitwise.sources.tables import INPUT_NAMES, ReportInputs

AS_OF = dt.date(1998, 6, 17)
SINCE = dt.date(1995, 6, 1)

# Neutral location rules for the stand-in locations, in order.
LOCATION_RULES = (
    LocationRule("Vendors%", "Vendors"),
    LocationRule("Plant%", "Production"),
    LocationRule("HUB/WH/Stock/Spares Pick%", "Nest"),
    LocationRule("HUB/Quarantine/Rework/Production%", "Warehouse"),
    LocationRule("%Quarantine%", "Quarantine"),
    LocationRule("%Scrap%", "Scrap"),
    LocationRule("%Nest%", "Nest"),
    LocationRule("HUB/Input%", "Receiving & Pre-IQC"),
    LocationRule("HUB/WH%", "Warehouse"),
    LocationRule("HUB/R&D%", "R&D"),
)

# Location name prefixes, picked by supplier key modulo 11.
LOCATION_PREFIXES = (
    "Vendors/",
    "HUB/WH/Stock/",
    "HUB/Input/",
    "HUB/Quarantine/Hold/",
    "HUB/Quarantine/Rework/Production/",
    "Site Nest ",
    "Site Scrap ",
    "HUB/R&D/",
    "Plant/",
    "HUB/WH/Stock/Spares Pick/",
    "Somewhere/",
)

# Two hand-made alternate groups: an alternate parent that is a root, and a
# group whose first items are blank.
LITERAL_ALTERNATE_GROUPS = (
    (2000000, "Brand#4-ECONOMY, Brand#1"),
    (2000001, ", ,Brand#5-ECONOMY"),
)

PARAMS = ReportParams(as_of=AS_OF, since=SINCE, location_rules=LOCATION_RULES)


def pnum(k: Column) -> Column:
    """Part number text of a part key: P + seven digits."""
    return F.concat(F.lit("P"), F.lpad(k.cast("string"), 7, "0"))


def root_rev(brand: Column) -> Column:
    """Root revision: NULL for one brand, 'A' for the others."""
    return F.when(brand == "Brand#5", F.lit(None).cast("string")).otherwise(F.lit("A"))


_BOM_COLS = (
    "path",
    "part_number",
    "revision",
    "product_name",
    "production_state",
    "indent_level",
    "uom",
    "tracking",
    "is_consumable_storable",
    "parent_bom",
    "parent_revision",
    "top_level_bom",
    "top_level_revision",
    "quantity",
    "procurement_intent",
    "adjusted_quantity",
    "adjusted_procurement_intent",
    "global_alternate_part_numbers",
    "substitute_part_numbers",
)


def _bom_row(**cols: Column) -> list[Column]:
    defaults = {
        "production_state": F.lit("active"),
        "uom": F.lit("EA"),
        "tracking": F.lit("none"),
        "is_consumable_storable": F.lit("false"),
        "global_alternate_part_numbers": F.lit(None).cast("string"),
        "substitute_part_numbers": F.lit(None).cast("string"),
    }
    defaults.update(cols)
    out = []
    for name in _BOM_COLS:
        c = defaults[name]
        if name == "indent_level":
            c = c.cast("int")
        elif name in ("quantity", "adjusted_quantity"):
            c = c.cast("double")
        else:
            c = c.cast("string")
        out.append(c.alias(name))
    return out


class StandIns(ReportInputs):
    """Lazily derived stand-ins for one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def _t(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def bom(self) -> DataFrame:
        part = self._t("part")
        b = F.col("p_brand")
        tier0 = part.select("p_brand").distinct().select(
            *_bom_row(
                path=F.concat(F.lit("|"), b, F.lit("|A|")),
                part_number=b,
                revision=root_rev(b),
                product_name=b,
                indent_level=F.lit(0),
                parent_bom=F.lit(None),
                parent_revision=F.lit(None),
                top_level_bom=b,
                top_level_revision=root_rev(b),
                quantity=F.lit(1),
                procurement_intent=F.lit("make"),
                adjusted_quantity=F.lit(1),
                adjusted_procurement_intent=F.lit("make"),
            )
        )
        sub = F.concat(b, F.lit("-"), F.col("p_type"))
        sub_path = F.concat(F.lit("|"), b, F.lit("|A|"), sub, F.lit("|B01|"))
        tier1 = (
            part.groupBy("p_brand", "p_type")
            .agg(F.min("p_size").alias("m"))
            .select(
                *_bom_row(
                    path=sub_path,
                    part_number=sub,
                    revision=F.lit("B01"),
                    product_name=F.col("p_type"),
                    indent_level=F.lit(1),
                    parent_bom=b,
                    parent_revision=root_rev(b),
                    top_level_bom=b,
                    top_level_revision=root_rev(b),
                    quantity=F.col("m") % 3,
                    procurement_intent=F.lit("make"),
                    adjusted_quantity=F.col("m") % 3,
                    adjusted_procurement_intent=F.lit("make"),
                )
            )
        )
        k = F.col("p_partkey")
        size = F.col("p_size")
        intent = F.when(size % 10 == 0, F.lit("supplier_buy")).otherwise(F.lit("company_buy"))
        tier2 = part.select(
            *_bom_row(
                path=F.concat(sub_path, pnum(k), F.lit("|C|")),
                part_number=pnum(k),
                revision=F.lit("C"),
                product_name=F.col("p_name"),
                indent_level=F.lit(2),
                tracking=F.when(size % 5 == 0, F.lit("serial")).otherwise(F.lit("none")),
                is_consumable_storable=F.when(size % 9 == 0, F.lit("yes")).otherwise(F.lit("false")),
                parent_bom=sub,
                parent_revision=F.lit("B01"),
                top_level_bom=b,
                top_level_revision=root_rev(b),
                quantity=size,
                procurement_intent=intent,
                adjusted_quantity=size,
                adjusted_procurement_intent=intent,
                global_alternate_part_numbers=F.when(k % 20 == 0, pnum(k + 1)),
            )
        )
        shared = part.where((k % 7 == 0) & (b != "Brand#1")).select(
            *_bom_row(
                path=F.concat(F.lit("|Brand#1|A|"), pnum(k), F.lit("|C|")),
                part_number=pnum(k),
                revision=F.lit("C"),
                product_name=F.col("p_name"),
                indent_level=F.lit(1),
                parent_bom=F.lit("Brand#1"),
                parent_revision=F.lit("A"),
                top_level_bom=F.lit("Brand#1"),
                top_level_revision=F.lit("A"),
                quantity=size % 4,
                procurement_intent=F.lit("company_buy"),
                adjusted_quantity=size % 4,
                adjusted_procurement_intent=F.lit("company_buy"),
            )
        )
        nested = part.where(k == F.lit(0)).select(
            *_bom_row(
                path=F.lit("|Brand#3|A|Brand#2|A|"),
                part_number=F.lit("Brand#2"),
                revision=F.lit("A"),
                product_name=F.lit("Brand#2"),
                indent_level=F.lit(1),
                parent_bom=F.lit("Brand#3"),
                parent_revision=F.lit("A"),
                top_level_bom=F.lit("Brand#3"),
                top_level_revision=F.lit("A"),
                quantity=F.lit(2),
                procurement_intent=F.lit("make"),
                adjusted_quantity=F.lit(2),
                adjusted_procurement_intent=F.lit("make"),
            )
        )
        return tier0.unionByName(tier1).unionByName(tier2).unionByName(shared).unionByName(nested)

    @cached_property
    def demand(self) -> DataFrame:
        # what an order says is worked out once an order, and each join moves only what is left to tell
        prio = F.col("o_orderpriority")
        o = self._t("orders").select(
            "o_orderkey",
            F.when(F.col("o_orderkey") % 97 == 0, F.lit("TBD"))
            .otherwise(F.date_format(F.col("o_orderdate"), "MM/dd/yyyy"))
            .alias("date"),
            F.when(prio.isin("1-URGENT", "2-HIGH"), F.lit("Spares"))
            .when(prio == "4-NOT SPECIFIED", F.lit(None).cast("string"))
            .otherwise(F.lit("Production"))
            .alias("demand_type"),
        )
        li = self._t("lineitem").select("l_orderkey", "l_partkey", "l_quantity")
        p = self._t("part").select("p_partkey", "p_brand")
        j = li.join(p, li.l_partkey == p.p_partkey).select("l_orderkey", "l_quantity", "p_brand")
        j = j.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        return j.select(
            F.col("p_brand").alias("part_number"),
            F.when(F.col("p_brand") == "Brand#5", F.lit("")).otherwise(F.lit("A")).alias("revision"),
            F.when(F.col("p_brand") == "Brand#7", F.lit(0.0)).otherwise(F.col("l_quantity")).alias("quantity"),
            "date",
            "demand_type",
        )

    @cached_property
    def structured(self) -> DataFrame:
        bom = self.bom.where(F.col("part_number") != "Brand#2")
        ind = F.col("indent_level")
        return bom.select(
            plain_path(F.col("path")).alias("path_without_rev"),
            F.col("top_level_bom").alias("product"),
            F.when(ind == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("V"), ind.cast("string")))
            .alias("variant"),
            F.when(ind >= 1, F.concat(F.lit("S"), F.substring(F.col("part_number"), 6, 1))).alias("system"),
            F.col("parent_bom").alias("subsystem"),
        )

    @cached_property
    def flat_parts(self) -> DataFrame:
        part = self._t("part")
        return part.where(F.col("p_partkey") % 13 != 0).select(
            pnum(F.col("p_partkey")).alias("part_number"), F.col("p_type").alias("new_commodity")
        )

    @cached_property
    def alternates(self) -> DataFrame:
        part = self._t("part").select("p_partkey")
        k = F.col("p_partkey")
        groups = part.where(k % 15 == 0).select(
            k.alias("row_id"),
            F.concat(pnum(k), F.lit(", "), pnum(k + 1), F.lit(","), pnum(k + 2)).alias("part_numbers"),
        )
        chains = part.where(k % 15 == 0).select(
            (k + 1000000).alias("row_id"),
            F.concat(pnum(k + 2), F.lit(", "), pnum(k + 15)).alias("part_numbers"),
        )
        # every assembly has a root for an alternate
        own = F.col("p_brand")
        assemblies = (
            self._t("part")
            .groupBy("p_brand", "p_type")
            .agg(F.min("p_partkey").alias("m"))
            .select(
                (F.col("m") + 3000000).alias("row_id"),
                F.concat(own, F.lit("-"), F.col("p_type"), F.lit(", Brand#"), (F.col("m") % 25 + 1).cast("string")).alias(
                    "part_numbers"
                ),
            )
        )
        literal = self.spark.createDataFrame(list(LITERAL_ALTERNATE_GROUPS), "row_id bigint, part_numbers string")
        return groups.unionByName(chains).unionByName(assemblies).unionByName(literal)

    @cached_property
    def forecast(self) -> DataFrame:
        part = self._t("part")
        k = F.col("p_partkey")
        base = part.where(k % 2 == 0).select(
            F.when(k % 4 == 0, F.concat(F.lit(" "), pnum(k), F.lit(" "))).otherwise(pnum(k)).alias("part_number"),
            F.when(k % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("p_retailprice")).alias("unit_cost_q2"),
            F.date_add(F.lit(dt.date(1998, 1, 1)), F.col("p_size")).cast("timestamp_ntz").alias("synced_at"),
        )
        older = part.where(k % 6 == 0).select(
            pnum(k).alias("part_number"),
            (F.col("p_retailprice") + 1).alias("unit_cost_q2"),
            F.lit(None).cast("timestamp_ntz").alias("synced_at"),
        )
        return base.unionByName(older)

    @cached_property
    def supply_plans(self) -> DataFrame:
        li = self._t("lineitem")
        d = F.col("l_shipdate")
        md = F.date_format(d, "MM/dd")
        return li.where(F.year(d) == 1998).select(
            pnum(F.col("l_partkey")).alias("part_number"),
            F.col("l_quantity").alias("quantity"),
            F.when(F.col("l_orderkey") % 50 == 0, F.lit("13/45"))
            .when(F.col("l_linenumber") == 2, F.concat(F.lit(" "), md))
            .otherwise(md)
            .alias("date"),
        )

    @cached_property
    def stock_location(self) -> DataFrame:
        s = self._t("supplier")
        prefix = F.element_at(
            F.array(*[F.lit(x) for x in LOCATION_PREFIXES]), (F.col("s_suppkey") % 11 + 1).cast("int")
        )
        return s.select(F.col("s_suppkey").alias("id"), F.concat(prefix, F.col("s_name")).alias("complete_name"))

    @cached_property
    def stock_move(self) -> DataFrame:
        li = self._t("lineitem")
        return li.select(
            F.col("l_shipdate").alias("date"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("location_id"),
            (F.col("l_suppkey") + F.col("l_linenumber")).alias("location_dest_id"),
            F.col("l_quantity").alias("product_qty"),
            F.when(F.col("l_linestatus") == "F", F.lit("done")).otherwise(F.lit("draft")).alias("state"),
        )

    @cached_property
    def product_product(self) -> DataFrame:
        return self._t("part").select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("product_tmpl_id"))

    @cached_property
    def product_template(self) -> DataFrame:
        return self._t("part").select(
            F.col("p_partkey").alias("id"), pnum(F.col("p_partkey")).alias("default_code"), F.col("p_name").alias("name")
        )

    @cached_property
    def inventory(self) -> DataFrame:
        li = self._t("lineitem")
        return li.where(F.col("l_linestatus") == "O").select(
            pnum(F.col("l_partkey")).alias("default_code"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_suppkey").alias("stock_location_id"),
        )

    @cached_property
    def shipments(self) -> DataFrame:
        ev = self._t("events")
        et = F.col("event_type")
        return ev.select(
            (F.col("event_id") / 5).cast("bigint").cast("string").alias("shipment_id"),
            F.when(et == "purchase", F.lit(" In Transit "))
            .when(et == "signup", F.lit("Delivered / Completed"))
            .when(et == "click", F.lit("draft"))
            .when(et == "error", F.lit("Cancelled"))
            .alias("state"),
            F.col("ts").cast("string").alias("updated_at"),
        )

    @cached_property
    def shipment_lines(self) -> DataFrame:
        ev = self._t("events")
        return ev.where(F.col("event_type") != "view").select(
            (F.col("event_id") / 5).cast("bigint").cast("string").alias("shipment_id"),
            pnum(F.col("user_id")).alias("default_code"),
            F.when(F.col("event_type") == "error", F.lit("n/a"))
            .otherwise(F.get_json_object(F.col("props"), "$.k"))
            .alias("quantity"),
        )

    @cached_property
    def po_line(self) -> DataFrame:
        ucents = F.round(F.col("l_extendedprice") / F.col("l_quantity") * 100).cast("bigint") * F.lit(1000000)
        li = self._t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", ucents.alias("unit_price_ucents"))
        o = self._t("orders").select("o_orderkey", "o_orderdate")
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        return j.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_orderkey").alias("purchase_order_version_id"),
            F.col("l_partkey").alias("part_template_id"),
            F.col("l_partkey").alias("unit_of_measure_id"),
            "unit_price_ucents",
            F.col("o_orderdate").alias("created_at"),
            F.lit("C").alias("major_revision_name"),
        )

    @cached_property
    def po_version(self) -> DataFrame:
        o = self._t("orders")
        return o.select(
            F.col("o_orderkey").alias("id"),
            F.col("o_orderkey").alias("purchase_order_id"),
            (F.col("o_custkey") % 50).alias("supplier_id"),
            F.when(F.col("o_orderstatus") == "F", F.lit("ISSUED")).otherwise(F.lit("DRAFT")).alias("status"),
        )

    @cached_property
    def purchase_order(self) -> DataFrame:
        o = self._t("orders")
        return o.select(
            F.col("o_orderkey").alias("id"),
            F.concat(F.lit("PO"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("purchase_order_number"),
        )

    @cached_property
    def po_supplier(self) -> DataFrame:
        return self._t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))

    @cached_property
    def uom(self) -> DataFrame:
        p = self._t("part")
        return p.where(F.col("p_size") % 4 != 0).select(
            F.col("p_partkey").alias("id"), F.col("p_partkey").alias("unit_ref_id")
        )

    @cached_property
    def uom_factor(self) -> DataFrame:
        p = self._t("part")
        return p.select(F.col("p_partkey").alias("id"), (F.col("p_size") % 4).cast("double").alias("factor"))


class WrittenInputs(ReportInputs):
    """Inputs that are written as Parquet when first read, each on its own."""

    def __init__(self, raw: StandIns):
        from kitwise.plans.scratch import Folder

        self._raw = raw
        self._folder = Folder(raw.spark, "kitwise-inputs")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in INPUT_NAMES:
            raise AttributeError(name)
        value = self._folder.write(getattr(self._raw, name), name)
        self.__dict__[name] = value
        return value

    def write_all(self, at_once: int = 4) -> None:
        """Write every input that has not been read yet, some at a time (they are independent)."""
        with ThreadPoolExecutor(at_once) as pool:
            list(pool.map(lambda n: getattr(self, n), INPUT_NAMES))


_WRITTEN: dict[tuple[str, str], WrittenInputs] = {}


def load(spark: SparkSession, sf_dir: str, materialize: bool = True) -> ReportInputs:
    """The stand-in inputs of ``sf_dir``.

    With ``materialize`` each is derived once per application, when a stage
    first reads it, and written as Parquet under the session's checkpoint
    directory, so queries read them as the plain input tables a production run
    has (small plans, parallel scans); the files go when the application ends.
    Without it every query derives them from the test tables itself.
    """
    raw = StandIns(spark, sf_dir)
    if not materialize:
        return raw
    key = (spark.sparkContext.applicationId, raw.sf_dir)
    if key not in _WRITTEN:
        _WRITTEN[key] = WrittenInputs(raw)
    return _WRITTEN[key]
