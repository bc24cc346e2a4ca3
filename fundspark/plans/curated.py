"""The curated layer: raw feeds to clean, nested, order lines and order documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from fundspark.context import RunContext
from fundspark.operators import campaigns as campaign_ops
from fundspark.operators import catalog as catalog_ops
from fundspark.operators import feeds
from fundspark.operators.lineage import materialise
from fundspark.operators.lines import order_line_campaigns, order_lines_curated
from fundspark.operators.orders import orders_curated, orders_nested_promos
from fundspark.operators.quality import REPORT, TableChecks, checked_table
from fundspark.plans.checks import CAMPAIGN_CHECKS, CATALOG_CHECKS, ORDER_CHECKS
from fundspark.streaming.refresh import stream_filter


class CheckedTables:
    """Tables of one run as they are written, and one report of all their checks."""

    def __init__(self, checks: dict[str, TableChecks]):
        self.checks, self.rows = checks, []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        table, rows = checked_table(df, name, self.checks[name])
        self.rows += rows
        return table

    def report(self, df: DataFrame) -> DataFrame:
        """``table_name, check_name, subject, violations, passed``; one row per declared check."""
        return df.sparkSession.createDataFrame(self.rows, REPORT)


@dataclass(frozen=True)
class CampaignFeeds:
    campaigns: DataFrame
    benefits_new: DataFrame
    benefits_old: DataFrame
    triggers_new: DataFrame
    triggers_old: DataFrame
    vendors: DataFrame


def run_campaigns(raw: CampaignFeeds, ctx: RunContext) -> dict[str, DataFrame]:
    """Clean campaign tables, the published campaign documents, and the report of their checks."""
    run = CheckedTables(CAMPAIGN_CHECKS)
    header = campaign_ops.campaigns_clean(raw.campaigns)
    benefits = feeds.benefits_merge(raw.benefits_new, feeds.benefits_old_clean(raw.benefits_old))
    triggers = feeds.triggers_merge(
        raw.triggers_new, feeds.triggers_old_clean(raw.triggers_old)
    )
    vendors = feeds.campaign_vendors_clean(raw.vendors)
    tables = {
        "campaigns": header,
        "benefits": benefits,
        "triggers": triggers,
        "campaign_vendors": vendors,
    }
    clean = {name: run.write(df, name) for name, df in tables.items()}
    nested = campaign_ops.campaigns_nested(
        clean["campaigns"], clean["benefits"], clean["triggers"], clean["campaign_vendors"], ctx
    )
    published = run.write(campaign_ops.campaigns_curated(nested), "campaigns_nested")
    return {**clean, "campaigns_nested": published, "report": run.report(published)}


@dataclass(frozen=True)
class CatalogFeeds:
    chain_products: DataFrame
    vendor_products: DataFrame
    warehouses: DataFrame
    sales_buffers: DataFrame
    vat_history: DataFrame
    locations: DataFrame
    sources: DataFrame


def run_catalog(raw: CatalogFeeds, ctx: RunContext) -> dict[str, DataFrame]:
    """The catalog documents and the report of their checks."""
    flags = catalog_ops.vendor_products_flags(
        raw.vendor_products,
        catalog_ops.vendor_warehouses(raw.warehouses),
        catalog_ops.latest_sales_buffer(raw.sales_buffers, ctx),
        catalog_ops.current_vat(raw.vat_history, ctx),
        raw.locations,
    )
    flagged = materialise(flags, "vendor_products_flags")
    run = CheckedTables(CATALOG_CHECKS)
    catalog = run.write(catalog_ops.catalog_nested(raw.chain_products, flagged, raw.sources, ctx), "catalog")
    return {"catalog": catalog, "report": run.report(catalog)}


@dataclass(frozen=True)
class OrderFeeds:
    cart_orders: DataFrame
    app_orders: DataFrame
    cart_items: DataFrame
    app_items: DataFrame
    cart_campaigns: DataFrame
    app_campaigns: DataFrame
    external_funding: DataFrame
    lines: DataFrame
    headers: DataFrame
    ranks: DataFrame


@dataclass(frozen=True)
class OrderDimensions:
    catalog: DataFrame
    sku_history: DataFrame
    warehouses: DataFrame
    vendors: DataFrame
    wac: DataFrame
    vat_events: DataFrame
    price_history: DataFrame
    sales_buffers: DataFrame
    attribute_log: DataFrame
    fx: DataFrame


def run_orders(raw: OrderFeeds, dims: OrderDimensions, ctx: RunContext) -> dict[str, DataFrame]:
    """Promo orders, order lines and order documents of one run.

    Each table is written before the next step reads it, so a step that looks at its input
    twice reads files twice instead of computing everything before it twice.
    """

    def days(df: DataFrame) -> DataFrame:
        return stream_filter(df, "created_date", ctx)

    orders = feeds.orders_clean(days(raw.cart_orders), days(raw.app_orders))
    items = feeds.order_items_clean(days(raw.cart_items), days(raw.app_items))
    campaigns = feeds.order_campaigns_clean(days(raw.cart_campaigns), days(raw.app_campaigns))
    run = CheckedTables(ORDER_CHECKS)
    clean = {
        "orders_clean": run.write(orders, "orders_clean"),
        "items_clean": run.write(items, "items_clean"),
        "order_campaigns_clean": run.write(campaigns, "order_campaigns_clean"),
    }
    promos = materialise(orders_nested_promos(*clean.values(), dims.fx, ctx), "promo_orders")
    line_campaigns = materialise(
        order_line_campaigns(promos, dims.catalog, feeds.external_funding(raw.external_funding)),
        "line_campaigns",
    )
    lines = materialise(
        order_lines_curated(
            raw.lines,
            sku_history=dims.sku_history,
            catalog=dims.catalog,
            warehouses=dims.warehouses,
            vendors=dims.vendors,
            wac=dims.wac,
            vat_events=dims.vat_events,
            price_history=dims.price_history,
            sales_buffers=dims.sales_buffers,
            attribute_log=dims.attribute_log,
            line_campaigns=line_campaigns,
            fx=dims.fx,
            ctx=ctx,
        ),
        "order_lines",
    )
    return {
        **clean,
        "promo_orders": promos,
        "line_campaigns": line_campaigns,
        "order_lines": lines,
        "orders": orders_curated(raw.headers, lines, raw.ranks, ctx),
        "report": run.report(lines),
    }
