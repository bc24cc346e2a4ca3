"""Registry of queries, and the nested input documents built from the flat test tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundspark.context import RunContext
from fundspark.operators.campaigns import HEADER
from fundspark.operators.lineage import materialise
from suite.fixtures import BASE, FIXTURES, direct_inputs, with_fixtures

# The whole history in one run.
FULL = RunContext(
    as_of=date(2001, 12, 31),
    date_in=date(1995, 1, 1),
    date_fin=date(2001, 12, 31),
    backfill=True,
    weight_step_entity="EF_AT",
    history_start=date(1990, 1, 1),
)
# A run on the first of a month: campaigns that end from 1998-04-27 to 1998-05-31.
MONTHLY = RunContext(
    as_of=date(1998, 5, 1),
    date_in=date(1996, 1, 1),
    date_fin=date(1998, 5, 31),
    entities=tuple(
        f"{prefix}_N{n}" for n, prefix in enumerate(("PY", "TB", "HS", "EF", "FP") * 5)
    ),
    excluded_warehouses=("W2-1",),
    excluded_vendors=("V4-7",),
    name_exclusion_entity="TB_N1",
    name_exclusion_pattern="a3|b5",
)


# Narrow derived tables that many others start from: written once per session. Wide ones are derived
# again where they are used, with the columns that are used: their lines move once, by order.
SHARED = {
    "f_order_heads", "f_pair", "f_assort", "f_slots", "f_campaign_keys", "f_campaign_slots", "f_fx",
    "f_crm",
}
_DERIVED: dict[tuple[str, str, str], DataFrame] = {}

LINES_A_TASK = 100_000
# The same joins with the lines last: the only join that moves them is the one on the order.
LINES_FIRST = """from lineitem join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey join f_entities as e on c_nationkey = e.n"""
LINES_LAST = """from lineitem join (orders join customer on o_custkey = c_custkey
  join f_entities as e on c_nationkey = e.n) on l_orderkey = o_orderkey"""
# Tables whose rows are dealt while they are narrow: what they are made from, its columns, and by what.
ENTITY = ["global_entity_id", "country_code"]
DEALT = {
    "f_catalog": ("f_assort", ["n", *ENTITY, "pkey", "slot"], ["n", "pkey"]),
    "f_suppliers_flat": ("f_sales", ["n", *ENTITY, "pkey", "skey", "slot % 3 as slot"], ["n", "pkey"]),
    "f_locations": ("f_assort", ["n", "pkey", "slot % 3 as slot"], ["n", "pkey"]),
    "f_chain_products": ("f_assort", ["n", *ENTITY, "pkey", "slot % 2 as slot"], ["pkey"]),
    "f_crm": ("f_sales", [*ENTITY, "skey"], ["skey"]),
}
# Columns that their rows are dealt by and that the texts make the ids from, one to one. As further
# keys of the same groups they spare the wide rows a shuffle.
KEYED = {
    "f_master": ["n", "slot", "pkey"],
    "f_suppliers_flat": ["n", "slot", "pkey"],
    "f_chain_products": ["n", "slot", "pkey"],
    "f_locations": ["n", "slot", "pkey"],
    "f_catalog": ["n", "pkey"],
    "f_items": ["okey"],
}


class Inputs:
    """Test tables of one scale, by name. ``store`` is a folder of already derived tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, store: str | None = None):
        self.spark, self.sf_dir, self.store = spark, sf_dir.rstrip("/"), store

    def base(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def _once(self, name: str, build: Callable[[], DataFrame], keep: bool) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        if key not in _DERIVED:
            df = build()
            _DERIVED[key] = materialise(df, name) if keep else df
        return _DERIVED[key]

    def __call__(self, name: str) -> DataFrame:
        if self.store:
            return self.spark.read.parquet(f"{self.store}/{name}")
        return self._once(name, lambda: self._derive(name), name in SHARED)

    def _derive(self, name: str) -> DataFrame:
        return self._keyed(name).drop(*KEYED.get(name, [])) if name in KEYED else self._run(name, FIXTURES[name])

    def _keyed(self, name: str) -> DataFrame:
        """The table with its columns of ``KEYED``, dealt by product or order."""
        keys = ", ".join(KEYED[name])
        return self._run(name, re.sub(r"select( distinct)?", rf"select\1 {keys},", FIXTURES[name], count=1))

    def _run(self, name: str, sql: str) -> DataFrame:
        for table in BASE:
            if re.search(rf"\b{table}\b", sql):
                self.base(table).createOrReplaceTempView(table)
        for table in direct_inputs(sql):
            self._source(name, table).createOrReplaceTempView(table)
        return self.spark.sql(sql.replace(LINES_FIRST, LINES_LAST))

    def _source(self, name: str, table: str) -> DataFrame:
        """What ``name`` reads of a table: all it needs, in as few and as narrow rows as give the same."""
        if name == "f_slots":
            return self("f_assort")
        if name == "f_pair":
            region = self("f_entities").select("n", "global_entity_id", "country_code", "region")
            pairs = self("f_assort").drop("slot").distinct()
            return pairs.join(F.broadcast(region), ["n", "global_entity_id", "country_code"])
        if table == "f_entities" and name in ("f_sales", "f_order_heads"):
            return F.broadcast(self(table))  # one row per nation; by nation no row ever moves
        if table == "f_edits":
            return F.broadcast(self(table))  # both edits of a row are made in one task
        rows = self(table)
        if table != DEALT.get(name, ("",))[0]:
            return rows
        _, columns, by = DEALT[name]
        return rows.selectExpr(*columns).repartition(self._tasks(), *by).distinct()

    def _tasks(self) -> int:
        """Tasks for narrow rows that become wide ones: a fixed number of lines each, as merging
        them by their narrow size would make too much of them. Counting reads no rows."""
        lines = self.base("lineitem").count()
        return max(self.spark.sparkContext.defaultParallelism, lines // LINES_A_TASK)

    def _document(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if self.store:
            return self.spark.read.parquet(f"{self.store}/{name}")
        return self._once(name, build, False)

    def _one_pass(self, name: str, key: str) -> DataFrame:
        """The rows of a union of texts over one table, made in one pass over it. ``__key`` is a
        column the table is dealt by, so that grouping by it moves nothing."""
        texts = [
            re.fullmatch(r"\s*select (.*)\sfrom (f_[a-z]+)(?:\swhere (.*))?\s*", part, re.DOTALL)
            for part in FIXTURES[name].split("union all")
        ]
        made = ", ".join(f"case when {t[3] or 'true'} then struct({t[1]}) end" for t in texts)
        (table,) = {t[2] for t in texts}
        return self._run(
            name,
            f"""select __key, r.* from (select {key} as __key,
              explode(filter(array({made}), r -> r is not null)) as r from {table}) as made""",
        )

    def _dealt(self, name: str) -> tuple[DataFrame, list[str]]:
        """Rows to group where they are, and the keys to add; a stored table has none."""
        return (self(name), []) if self.store else (self._keyed(name), KEYED[name])

    @cached_property
    def catalog(self) -> DataFrame:
        return self._document("catalog", self.build_catalog)

    @cached_property
    def orders(self) -> DataFrame:
        return self._document("orders", self.build_orders)

    @cached_property
    def promo_orders(self) -> DataFrame:
        return self._document("promo_orders", self.build_promo_orders)

    @cached_property
    def entities(self) -> DataFrame:
        from fundspark.sources.tables import enabled_entities

        return enabled_entities(self.spark, MONTHLY.entities)

    def build_catalog(self) -> DataFrame:
        def category(name: str):
            return F.struct(F.struct(F.col(name).alias("level_one")).alias("master_category_names"))

        categories = F.filter(
            F.array(category("category_one"), category("category_two")),
            lambda c: c["master_category_names"]["level_one"].isNotNull(),
        )
        rows, own = self._dealt("f_catalog")
        flat = rows.withColumns(
            {
                "master_categories": categories,
                "barcodes": F.array(
                    F.struct(F.col("barcode_one").alias("barcode")),
                    F.struct(F.col("barcode_two").alias("barcode")),
                ),
                "tags": F.array(
                    F.struct(F.col("tag_one").alias("tag_name")),
                    F.struct(F.col("tag_two").alias("tag_name")),
                ),
            }
        )
        return flat.groupBy(
            "global_entity_id", "country_code", "sku", "catalog_chain_product_id",
            "product_name", "brand_name", "master_product_created_at_utc",
            "chain_product_created_at_utc", "master_categories", "barcodes", *own,
        ).agg(
            F.collect_list(
                F.struct(
                    "warehouse_id", "warehouse_name", "platform_vendor_id",
                    "catalog_global_vendor_id", "is_dark_store", "global_catalog_id",
                    "platform_product_id", "vendor_product_created_at_utc", "tags",
                )
            ).alias("vendor_products")
        ).drop(*own)

    def build_orders(self) -> DataFrame:
        campaign = F.struct(
            "campaign_id", "product_unit_price_lc", "campaign_discount_amt_lc",
            "campaign_supplier_funded_amt_lc",
        )
        info = F.filter(F.array(campaign), lambda c: c["campaign_id"].isNotNull())
        values = F.struct(
            "unit_price_listed_lc", "unit_discount_lc", "unit_price_paid_lc",
            "promo_items_discount_lc", "total_amt_paid_lc", "promo_items_supplier_funded_lc",
        )
        item = F.struct(
            "sku", "quantity_sold", values.alias("value_lc"), info.alias("campaign_info")
        )
        rows, own = self._dealt("f_items")
        return rows.groupBy(
            "global_entity_id", "country_code", "currency_code", "order_id",
            "order_created_date_lt", "warehouse_id", "platform_vendor_id", "is_dark_store",
            "is_successful", "is_failed", "is_cancelled", *own,
        ).agg(F.collect_list(item).alias("items")).drop(*own)

    def build_promo_orders(self) -> DataFrame:
        head = ["created_date", "created_at_utc", "region", "global_entity_id",
                "country_code", "order_id", "exchange_rate_value", "okey"]
        product = ["product_id", "platform_product_id", "promo_order_item_id",
                   "parent_product_id", "product_qty", "product_unit_price", "subtotal",
                   "total", "absolute_discount_lc", "distributed_discounted_price"]
        campaign = F.struct(
            "campaign_id", "discount_lc", "supplier_funded_amount", "trigger_qty", "benefit_qty"
        )
        known = F.when(F.col("campaign_id").isNotNull(), campaign)
        own = [] if self.store else ["__key"]
        rows = self("f_promo_flat") if self.store else self._one_pass("f_promo_flat", "okey")
        per_product = rows.groupBy(*own, *head, *product).agg(
            F.collect_list(known).alias("campaigns")
        )
        return per_product.groupBy(*own, *head).agg(
            F.collect_list(F.struct(*product, "campaigns")).alias("products")
        ).drop("okey", *own)

    @property
    def warehouses(self) -> DataFrame:
        vendor = F.struct("platform_vendor_id", "additional_platform_vendor_id", "migrated_at_utc")
        return (
            self("f_vendor_places")
            .groupBy(
                "global_entity_id", "warehouse_id", "name", "is_dark_store", "uses_new_locations"
            )
            .agg(F.collect_list(vendor).alias("vendors"))
        )

    @property
    def product_suppliers(self) -> DataFrame:
        key = ["global_entity_id", "country_code", "sku"]
        rows, own = self._dealt("f_suppliers_flat")
        own = [c for c in own if c != "slot"]
        per_supplier = (
            rows.groupBy(*key, *own, "supplier_id", "is_supplier_deleted")
            .agg(
                F.collect_list(F.struct("warehouse_id", "is_preferred_supplier")).alias(
                    "warehouses"
                )
            )
        )
        supplier = F.struct("supplier_id", "is_supplier_deleted", "warehouses")
        return (
            per_supplier.groupBy(*key, *own)
            .agg(F.collect_list(supplier).alias("suppliers"))
            .drop(*own)
        )

    @property
    def line_campaigns(self) -> DataFrame:
        """Campaign facts with arrays as the line operators carry them."""
        return self("f_line_campaigns").withColumns(
            {
                "campaign_info": F.array(F.struct(F.col("some_campaign_id").alias("campaign_id"))),
                "combo_products": F.array().cast("array<struct<combo_product_id:string>>"),
            }
        )


@dataclass(frozen=True)
class Query:
    build: Callable[[Inputs], DataFrame]
    oracle: str | None
    plain: str | None = None  # the SQL without the derived tables


QUERIES: dict[str, Query] = {}


def register(name: str, oracle: str | None):
    """Register a query; the oracle may use the derived tables by name."""

    def add(build: Callable[[Inputs], DataFrame]):
        QUERIES[name] = Query(build, with_fixtures(oracle) if oracle else None, oracle)
        return build

    return add


def text(*names: str) -> list:
    """Timestamps as text, so that both engines print the same value."""
    return [F.col(n).cast("string").alias(n) for n in names]


# Moves values off exact halves, which the two engines round differently.
OFF_HALF = 1.37e-7


def near(col, digits: int = 4):
    return F.round(col.cast("double") + OFF_HALF, digits)


def rounded(*names: str, digits: int = 4) -> list:
    return [near(F.col(n), digits).alias(n) for n in names]


def sql_near(expr: str, digits: int = 4) -> str:
    return f"round(cast({expr} as double) + {OFF_HALF}, {digits})"


def sql_text(*names: str, prefix: str = "") -> str:
    return ", ".join(f"cast({prefix}{n} as string) as {n}" for n in names)


def sql_rounded(*names: str, prefix: str = "", digits: int = 4) -> str:
    return ", ".join(f"{sql_near(prefix + n, digits)} as {n}" for n in names)


HEADER_TIMES = [c for c in HEADER if c.endswith("_at_utc")]
