"""Funding of concluded campaigns: order lines, SKU totals, supplier statements."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.context import RunContext
from fundspark.functions.money import coalesce_zero
from fundspark.operators.campaigns import (
    campaign_version_rollup,
    campaign_versions_flat,
    eligible_campaigns,
)
from fundspark.operators.catalog import (
    catalog_latest_by_vendor,
    dc_mapping,
    preferred_supplier,
    product_supplier_master,
    supplier_per_warehouse,
)
from fundspark.operators.lineage import materialise
from fundspark.operators.nested import fold
from fundspark.operators.order_items import is_completed, sold_items
from fundspark.operators.skew import bounded_join


def funded_order_lines(
    orders: DataFrame, versions: DataFrame, entities: DataFrame, ctx: RunContext
) -> DataFrame:
    """Lines of concluded campaigns with the amount the supplier funds.

    Whole-basket group campaigns are funded with the full discount, all others with the amount
    the promo tool booked. Orders go back 18 months from the window start, never further than 20
    months from the run date.
    """
    start, end = ctx.window
    oldest = F.greatest(
        F.add_months(F.lit(ctx.as_of), -20), F.add_months(F.lit(start), -18)
    )
    kept = orders.where(is_completed() & (F.col("order_created_date_lt") >= oldest))
    if ctx.excluded_warehouses:
        kept = kept.where(~F.col("warehouse_id").isin(*ctx.excluded_warehouses))
    if ctx.excluded_vendors:
        kept = kept.where(~F.col("platform_vendor_id").isin(*ctx.excluded_vendors))
    head = ["order_created_date_lt", "global_entity_id", "country_code", "currency_code",
            "warehouse_id", "platform_vendor_id"]
    kept = bounded_join(kept.select(*head, "items"), entities, ["global_entity_id"])
    lines = sold_items(kept, head, campaigns_required=True)
    concluded = versions.where(
        F.to_date("campaign_end_at_utc").between(F.lit(start), F.lit(end))
    ).select("global_entity_id", "campaign_id", "campaign_type", "root_id", "campaign_end_at_utc")
    matched = lines.join(concluded, ["global_entity_id", "campaign_id"])
    discount = F.col("promo_items_discount_lc")
    funded = F.col("promo_items_supplier_funded_lc")
    return matched.select(
        F.to_date("campaign_end_at_utc").alias("campaign_concluded_date_utc"),
        F.col("campaign_end_at_utc").alias("campaign_concluded_at_utc"),
        *head,
        "campaign_id",
        "campaign_type",
        "root_id",
        "sku",
        "quantity_sold",
        "unit_price_listed_lc",
        "unit_discount_lc",
        "unit_price_paid_lc",
        discount.alias("total_discount_lc"),
        "total_amt_paid_lc",
        funded.alias("order_items_supplier_funded_lc"),
        "product_unit_price_lc",
        "campaign_discount_amt_lc",
        "campaign_supplier_funded_amt_lc",
        coalesce_zero(
            F.when(F.col("campaign_type") == "GroupValue", discount).otherwise(funded)
        ).alias("supplier_funded_amount_lc"),
    )


def funded_lines_enriched(lines: DataFrame, master: DataFrame) -> DataFrame:
    """Lines with money to claim, with supplier and product attributes."""
    key = ["global_entity_id", "country_code", "warehouse_id", "sku", "platform_vendor_id"]
    attributes = master.drop("master_product_created_at_utc")
    return (
        lines.where(F.col("supplier_funded_amount_lc") > 0)
        .join(attributes, key, "left")
        .drop("platform_vendor_id", "campaign_type")
    )


SKU_GROUP = [
    "campaign_concluded_date_utc", "global_entity_id", "country_code", "currency_code",
    "supplier_id", "global_supplier_id", "supplier_name", "root_id", "sku", "product_name",
    "brand_name", "category_level_one", "barcodes",
]


def sku_supplier_funding(lines: DataFrame, ctx: RunContext) -> DataFrame:
    start, end = ctx.window
    concluded = lines.where(
        F.col("campaign_concluded_date_utc").between(F.lit(start), F.lit(end))
    )
    averages = ["unit_price_listed_lc", "unit_discount_lc", "unit_price_paid_lc"]
    totals = ["quantity_sold", "total_discount_lc", "total_amt_paid_lc",
              "supplier_funded_amount_lc"]
    return concluded.groupBy(*SKU_GROUP).agg(
        *[F.avg(c).alias(f"avg_{c}") for c in averages], *[F.sum(c).alias(c) for c in totals]
    )


SUPPLIER = [
    "global_entity_id", "country_code", "currency_code", "supplier_id", "global_supplier_id",
    "supplier_name",
]
SKU_FIELDS = [
    "sku", "product_name", "brand_name", "category_level_one", "barcodes",
    "avg_unit_price_listed_lc", "avg_unit_discount_lc", "avg_unit_price_paid_lc",
    "quantity_sold", "total_discount_lc", "total_amt_paid_lc", "supplier_funded_amount_lc",
]
CAMPAIGN_FIELDS = [
    "root_id", "campaign_name", "campaign_type", "campaign_subtype", "reason",
    "campaign_created_at_utc", "campaign_start_at_utc", "campaign_end_at_utc",
    "child_campaigns",
]


def supplier_statement(sku_rows: DataFrame, rollup: DataFrame, ctx: RunContext) -> DataFrame:
    """One statement per supplier: campaigns[], each with its skus[]."""
    start, end = ctx.window
    in_window = sku_rows.where(
        F.col("campaign_concluded_date_utc").between(F.lit(start), F.lit(end))
    )
    per_unit = F.try_divide("supplier_funded_amount_lc", "quantity_sold")
    element = F.struct(*SKU_FIELDS, per_unit.alias("unit_supplier_funded_amount_lc"))
    per_campaign = fold(in_window, [*SUPPLIER, "root_id"], "skus", element, split_on=["sku"])
    campaigns = rollup.where(
        F.to_date("campaign_end_at_utc").between(F.lit(start), F.lit(end))
    ).select("global_entity_id", "country_code", *CAMPAIGN_FIELDS)
    joined = per_campaign.join(campaigns, ["global_entity_id", "country_code", "root_id"])
    campaign = F.struct(*CAMPAIGN_FIELDS, "skus")
    statements = fold(joined, SUPPLIER, "campaigns", campaign, split_on=["root_id"])
    return statements.withColumn("campaign_concluded_week_utc", F.lit(start)).select(
        *SUPPLIER, "campaign_concluded_week_utc", "campaigns"
    )


@dataclass(frozen=True)
class FundingV1Inputs:
    campaigns: DataFrame
    catalog: DataFrame
    product_suppliers: DataFrame
    replenishment: DataFrame
    crm: DataFrame
    orders: DataFrame
    entities: DataFrame


def run_funding_v1(inputs: FundingV1Inputs, ctx: RunContext) -> dict[str, DataFrame]:
    """All tables of one run, by name. Each is written before the next step reads it."""
    eligible = eligible_campaigns(inputs.campaigns, inputs.entities, ctx)
    rollup = materialise(campaign_version_rollup(eligible, ctx), "concluded_campaigns")
    latest = catalog_latest_by_vendor(inputs.catalog, inputs.entities)
    dc = dc_mapping(inputs.replenishment, inputs.product_suppliers)
    suppliers = supplier_per_warehouse(inputs.product_suppliers, dc, inputs.entities)
    master = materialise(
        product_supplier_master(latest, preferred_supplier(suppliers), inputs.crm), "products"
    )
    lines = funded_order_lines(
        inputs.orders, campaign_versions_flat(rollup), inputs.entities, ctx
    )
    enriched = materialise(funded_lines_enriched(lines, master), "funded_lines")
    sku_rows = materialise(sku_supplier_funding(enriched, ctx), "sku_funding")
    return {
        "campaigns": rollup,
        "products": master,
        "orders": enriched,
        "sku_funding": sku_rows,
        "statements": supplier_statement(sku_rows, rollup, ctx),
    }
