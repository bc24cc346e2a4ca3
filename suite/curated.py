"""Whole runs of the curated layer, from raw feeds to published tables, in daily and backfill mode."""

from __future__ import annotations

import contextlib
import uuid
from dataclasses import replace
from datetime import date, timedelta

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fundspark.operators import feeds
from fundspark.operators.lineage import materialise, work_path
from fundspark.operators.quality import TableChecks
from fundspark.plans.checks import CAMPAIGN_CHECKS, CATALOG_CHECKS, ORDER_CHECKS
from fundspark.plans.curated import (
    CampaignFeeds,
    OrderDimensions,
    OrderFeeds,
    run_campaigns,
    run_orders,
)
from fundspark.plans.targets import CAMPAIGN_TARGETS, leave_tables, read_left
from fundspark.sources.tables import literal_rows, read_partitions, read_table, replace_table
from fundspark.sources.views import publish_to_groups
from fundspark.streaming.backfill import Ledger, run_backfill
from fundspark.streaming.fingerprints import refresh_changed
from fundspark.streaming.refresh import (
    backfill_filter,
    lookback_filter,
    read_refreshed,
    refresh_partitions,
)
from suite.campaigns import SHAPED_SQL, SUBTYPE_SQL
from suite.catalog import catalog_run
from suite.feeds import MERGED_ITEMS_SQL, MERGED_ORDERS_SQL
from suite.lines import CURATED_SQL, DAILY, order_headers
from suite.model import FULL, QUERIES, Inputs, near, register, sql_near

# Benefits and triggers come from two feeds; a key that is in both counts once.
CHILDREN_SQL = """
children as (
  select country_code, campaign_id, global_entity_id, 'b' as kind, cast(sku as string) as element
    from f_benefits_new_raw
  union select country_code, campaign_id, global_entity_id, 'b', cast(sku as string)
    from f_benefits_old_raw
  union select country_code, campaign_id, global_entity_id, 't', cast(sku as string)
    from f_triggers_new
  union select country_code, campaign_id, global_entity_id, 't',
    cast(coalesce(sku, product_id) as string) from f_triggers_old_raw
  union select country_code, campaign_id, global_entity_id, 'v', cast(vendor_id as string)
    from f_campaign_vendors_raw),
counted as (
  select country_code, campaign_id, count(*) filter (where kind = 'b') as benefit_count,
    count(*) filter (where kind = 't') as trigger_count,
    count(*) filter (where kind = 'v') as vendor_count
  from children group by all)"""


def campaigns_run(x: Inputs):
    raw = CampaignFeeds(
        campaigns=x("f_campaigns_raw"),
        benefits_new=x("f_benefits_new_raw"),
        benefits_old=x("f_benefits_old_raw"),
        triggers_new=x("f_triggers_new"),
        triggers_old=x("f_triggers_old_raw"),
        vendors=x("f_campaign_vendors_raw"),
    )
    return run_campaigns(raw, FULL)


@register(
    "curated_campaigns_run",
    f"""with {SHAPED_SQL}, {CHILDREN_SQL}
    select s.country_code, s.campaign_id, s.campaign_name, s.is_valid,
      {SUBTYPE_SQL} as campaign_subtype,
      coalesce(benefit_count, 0) as benefit_count, coalesce(trigger_count, 0) as trigger_count,
      coalesce(vendor_count, 0) as vendor_count
    from shaped as s left join counted as n on n.country_code = s.country_code
      and n.campaign_id = s.campaign_id""",
)
def _(x):
    return campaign_sizes(campaigns_run(x)["campaigns_nested"])


def campaign_sizes(documents):
    sizes = {"benefits": "benefit_count", "triggers": "trigger_count", "vendors": "vendor_count"}
    return documents.select(
        "country_code", "campaign_id", "campaign_name", "is_valid", "campaign_subtype",
        *[F.size(a).cast("bigint").alias(n) for a, n in sizes.items()],
    )


def orders_run(x: Inputs, ctx):
    raw = OrderFeeds(
        cart_orders=x("f_cart_orders"),
        app_orders=x("f_app_orders"),
        cart_items=x("f_cart_items"),
        app_items=x("f_app_items"),
        cart_campaigns=x("f_cart_campaigns"),
        app_campaigns=x("f_app_campaigns"),
        external_funding=x("f_external"),
        lines=x("f_lines_raw").withColumn("returns", F.array().cast("array<struct<reason:string>>")),
        headers=order_headers(x),
        ranks=x("f_ranks"),
    )
    dims = OrderDimensions(
        catalog=x.catalog,
        sku_history=x("f_sku_history"),
        warehouses=x.warehouses,
        vendors=x("f_vendor_verticals"),
        wac=x("f_wac"),
        vat_events=x("f_vat_events"),
        price_history=x("f_price_history"),
        sales_buffers=x("f_buffer_history"),
        attribute_log=x("f_attribute_log"),
        fx=x("f_fx"),
    )
    return run_orders(raw, dims, ctx)


def order_documents(x: Inputs, ctx):
    """Order documents of a whole run, with the number of products of the promo order."""
    tables = orders_run(x, ctx)
    promos = tables["promo_orders"].select(
        "country_code", "order_id", F.size("products").cast("bigint").alias("promo_product_count")
    )
    sold = F.transform("items", lambda i: i["quantity_sold"])
    ids = F.array_distinct(F.transform("items", lambda i: i["picking_order_item_id"]))
    documents = tables["orders"].select(
        "global_entity_id", "country_code", "order_id", "order_created_date_lt",
        "customer_qc_order_rank",
        F.coalesce(F.size(ids), F.lit(0)).cast("bigint").alias("item_count"),
        near(F.array_min(sold)).alias("least_sold"),
        near(F.array_max(sold)).alias("most_sold"),
    )
    return documents.join(promos, ["country_code", "order_id"], "left")


def orders_run_sql(headers: str, ranks: str, feed_days: str) -> str:
    return f"""with lines as ({CURATED_SQL}),
    per_order as (select country_code, order_id,
        count(distinct picking_order_item_id) as item_count,
        min(quantity_sold) as least_sold, max(quantity_sold) as most_sold
      from lines group by all),
    promo_heads as (
      select distinct country_code, order_id as promo_id, platform_order_code as order_id
      from (select country_code, order_id, platform_order_code, created_date from f_cart_orders
        union all select country_code, order_id, platform_order_code, created_date
          from f_app_orders) as o where {feed_days}),
    promo_sizes as (
      select country_code, promo_order_id as promo_id, count(*) as n
      from ({MERGED_ITEMS_SQL}) as i where {feed_days} group by all)
    select o.global_entity_id, o.country_code, o.order_id, o.order_date as order_created_date_lt,
      r.customer_qc_order_rank, coalesce(p.item_count, 0) as item_count,
      p.least_sold, p.most_sold, s.n as promo_product_count
    from f_order_heads as o
      left join per_order as p on p.country_code = o.country_code and p.order_id = o.order_id
      left join f_ranks as r on r.global_entity_id = o.global_entity_id
        and r.order_id = o.order_id and {ranks}
      left join promo_heads as h on h.country_code = o.country_code and h.order_id = o.order_id
      left join promo_sizes as s on s.country_code = h.country_code and s.promo_id = h.promo_id
    where {headers}"""


@register("curated_orders_backfill", orders_run_sql("true", "true", "true"))
def _(x):
    return order_documents(x, FULL)


# The run of 1998-06-15 looks back seven days and, on headers, one day ahead.
@register(
    "curated_orders_daily",
    orders_run_sql(
        "o.order_date between date '1998-06-08' and date '1998-06-16'",
        "r.partition_month_local = date '1998-06-01'",
        "created_date between date '1998-06-08' and date '1998-06-15'",
    ),
)
def _(x):
    return order_documents(x, DAILY)


# --- tables that runs leave behind ----------------------------------------------------------------


@register(
    "orders_clean_refresh",
    f"""select country_code, promo_order_id, created_date, {sql_near("total")} as total, src,
      cast(case when created_date between date '1998-06-08' and date '1998-06-15'
        then 2 else 1 end as int) as load_no
    from ({MERGED_ORDERS_SQL}) as o""",
)
def _(x):
    """A full load, then a daily run over the last seven days that replaces just their partitions."""
    cart, app = x("f_cart_orders"), x("f_app_orders")
    path = work_path(x.spark, "orders-clean")

    def load(new, old, number: int) -> None:
        rows = feeds.orders_clean(new, old).withColumn("load_no", F.lit(number))
        refresh_partitions(rows, path, "created_date", sort_by=["country_code", "promo_order_id"])

    load(cart, app, 1)
    days = [lookback_filter(df, "created_date", DAILY) for df in (cart, app)]
    load(*days, 2)
    bounds = (date(1990, 1, 1), date(2010, 1, 1))
    stored = read_partitions(x.spark, path, "created_date", bounds)
    return stored.select(
        "country_code", "promo_order_id", "created_date", near(F.col("total")).alias("total"),
        "src", "load_no",
    )


PUBLISHED = """global_entity_id string, country_code string, campaign_id string,
    campaign_name string, state string, discount_value double"""


@register(
    "published_campaigns",
    f"""select c.global_entity_id, country_code, campaign_id, campaign_name, state,
      {sql_near("discount_value")} as discount_value, reader
    from f_campaigns as c join (values ('PY_N0', 'north'), ('EF_AT', 'south'))
      as t(global_entity_id, reader) on t.global_entity_id = c.global_entity_id""",
)
def _(x):
    """A clustered, typed table, read again and shown to the readers of two entities."""
    path = work_path(x.spark, "published-campaigns")
    replace_table(
        x("f_campaigns"), path, cluster_by=["global_entity_id", "campaign_id"], ddl=PUBLISHED
    )
    readers = literal_rows(
        x.spark, [("PY_N0", "north"), ("EF_AT", "south")], "global_entity_id string, reader string"
    )
    table = read_table(x.spark, path, PUBLISHED).withColumn(
        "discount_value", near(F.col("discount_value"))
    )
    return table.join(F.broadcast(readers), "global_entity_id")


# --- reports, resumed backfills, tables replaced at once ----------------------------------------------


def plain(name: str) -> str:
    return QUERIES[name].plain


def report_sql(entries: dict[str, tuple[str, TableChecks]]) -> str:
    parts = []
    for table, (rows, checks) in entries.items():
        for c in checks.not_null:
            parts.append(
                f"select '{table}' as table_name, 'not_null' as check_name, '{c}' as subject,"
                f" count(*) - count({c}) as violations from ({rows}) as t"
            )
        key = ", ".join([*checks.key, *checks.optional])
        keyless = " or ".join(f"{c} is null" for c in checks.key) if checks.strict else "false"
        parts.append(
            f"""select '{table}', 'unique', '{key}', (select count(*) from ({rows}) as t)
            - (select count(*) from (select distinct {key} from ({rows}) as t) as k)
            + (select count(*) from ({rows}) as t where {keyless})"""
        )
    return f"""select table_name, check_name, subject, cast(violations as bigint) as violations,
      violations = 0 as passed from ({" union all ".join(parts)}) as r"""


ORDER_ROWS = {
    "orders_clean": plain("merge_sources_orders"),
    "items_clean": plain("merge_sources_items"),
    "order_campaigns_clean": plain("merge_sources_campaigns"),
}


@register("dq_report_orders", report_sql({t: (rows, ORDER_CHECKS[t]) for t, rows in ORDER_ROWS.items()}))
def _(x):
    """What the checks of a whole run report, gathered while its tables are written."""
    return orders_run(x, FULL)["report"]


OLD_TRIGGERS_SQL = f"""(select * replace (cast(created_at_utc as timestamp) as created_at_utc,
    cast(updated_at_utc as timestamp) as updated_at_utc) from ({plain("triggers_old_clean")}) as o) as old"""
CAMPAIGN_ROWS = {
    "campaigns": plain("campaigns_clean"),
    "benefits": plain("benefits_merge"),
    "triggers": plain("triggers_merge").replace("f_triggers_old)", f"{OLD_TRIGGERS_SQL})"),
    "campaign_vendors": plain("campaign_vendors_clean"),
    "campaigns_nested": plain("campaigns_clean"),
}


@register(
    "dq_report_campaigns",
    report_sql({t: (rows, CAMPAIGN_CHECKS[t]) for t, rows in CAMPAIGN_ROWS.items()}),
)
def _(x):
    return campaigns_run(x)["report"]


@register(
    "dq_report_catalog",
    report_sql({"catalog": ("select * from f_chain_products", CATALOG_CHECKS["catalog"])}),
)
def _(x):
    return catalog_run(x)["report"]


def orders_of_chunk(x: Inputs, ctx, number: int):
    feeds_of_chunk = [backfill_filter(x(f), "created_date", ctx) for f in ("f_cart_orders", "f_app_orders")]
    return feeds.orders_clean(*feeds_of_chunk).withColumn("load_no", F.lit(number))


CHUNKED = replace(FULL, backfill_start=date(1992, 1, 1), backfill_end=date(2001, 12, 31))
CHUNK_DAYS = 400


@register(
    "chunked_backfill",
    f"""select country_code, promo_order_id, created_date, {sql_near("total")} as total, src,
      cast(case when created_date < date '1994-03-11' then 1 else 2 end as int) as load_no
    from ({MERGED_ORDERS_SQL}) as o where created_date between date '1992-01-01' and date '2001-12-31'""",
)
def _(x):
    """A backfill that is lost in its third chunk and started again: the first two stay as they are."""
    path = work_path(x.spark, "orders-chunked")
    ledger = Ledger(x.spark, work_path(x.spark, "ledger"))
    settings = {
        "path": path, "partition_column": "created_date", "ledger": ledger, "job": "orders_clean",
        "chunk_days": CHUNK_DAYS, "sort_by": ["country_code", "promo_order_id"],
    }

    def until_lost(ctx):
        if ctx.backfill_start >= date(1992, 1, 1) + timedelta(days=2 * CHUNK_DAYS):
            raise ConnectionError("lost")
        return orders_of_chunk(x, ctx, 1)

    with contextlib.suppress(ConnectionError):
        run_backfill(until_lost, CHUNKED, **settings)
    run_backfill(lambda ctx: orders_of_chunk(x, ctx, 2), CHUNKED, **settings)
    bounds = (CHUNKED.backfill_start, CHUNKED.backfill_end)
    stored = read_partitions(x.spark, path, "created_date", bounds)
    return stored.select(
        "country_code", "promo_order_id", "created_date", near(F.col("total")).alias("total"),
        "src", "load_no",
    )


@register(
    "atomic_replace",
    f"""select c.global_entity_id, country_code, campaign_id, campaign_name, state,
      {sql_near("discount_value")} as discount_value, v.version_no
    from f_campaigns as c cross join (values (1), (2)) as v(version_no)
    where v.version_no = 1 or state = 'READY'""",
)
def _(x):
    """A table replaced twice, the second time after a write that failed: both versions as read."""
    path = work_path(x.spark, "campaign-versions")
    rows = x("f_campaigns")
    replace_table(rows, path, cluster_by=["global_entity_id", "campaign_id"], ddl=PUBLISHED)
    broken = rows.withColumn("campaign_name", F.raise_error(F.lit("lost")).cast("string"))
    with contextlib.suppress(PySparkException):
        replace_table(broken, path, ddl=PUBLISHED)
    first = read_table(x.spark, path, PUBLISHED)
    replace_table(rows.where("state = 'READY'"), path, ddl=PUBLISHED)
    both = first.withColumn("version_no", F.lit(1)).unionByName(
        read_table(x.spark, path, PUBLISHED).withColumn("version_no", F.lit(2))
    )
    return both.withColumn("discount_value", near(F.col("discount_value")))


LATE_DAY = date(1998, 5, 10)


@register(
    "late_rows_refresh",
    f"""with days as (select order_id, order_date, date_trunc('month', order_date)::date as order_month
      from f_order_heads),
    late as (select order_month, min(order_id) as order_id from days
      where order_month in (date '1995-02-01', date '1998-05-01') group by all)
    select d.order_id, d.order_month, cast(case when l.order_month is null then 1 else 2 end as int) as load_no
    from days as d left join (select distinct order_month from late) as l using (order_month)""",
)
def _(x):
    """Two orders arrive long after their month: only these two months are loaded again."""
    month = F.trunc("order_date", "month").alias("order_month")
    rows = materialise(x("f_order_heads").select("order_id", month), "late-rows")
    held_back = rows.where(F.col("order_month").isin(date(1995, 2, 1), date(1998, 5, 1)))
    held_back = held_back.groupBy("order_month").agg(F.min("order_id").alias("order_id"))
    path, marks = work_path(x.spark, "late"), work_path(x.spark, "late-marks")

    def load(current, number: int) -> None:
        refresh_changed(
            x.spark, current, path, "order_month", marks, extra={"load_no": F.lit(number)}
        )

    load(rows.join(held_back, ["order_month", "order_id"], "left_anti"), 1)
    load(rows, 2)
    return read_refreshed(x.spark, path).select("order_id", "order_month", "load_no")


@register(
    "published_views",
    f"""select c.country_code, c.campaign_id, c.campaign_name, c.state, {sql_near("discount_value")} as discount_value,
      reader from f_campaigns as c join (values ('PY_N0', 'north'), ('EF_AT', 'south'))
      as t(global_entity_id, reader) on t.global_entity_id = c.global_entity_id""",
)
def _(x):
    """A table published to two groups of readers and read through their views by another session."""
    path = work_path(x.spark, "campaigns-to-publish")
    replace_table(x("f_campaigns"), path)
    columns = {
        "country_code": "two letters", "campaign_id": "id of this version", "campaign_name": "",
        "state": "READY when it may run", "discount_value": "amount or per cent",
    }
    name = f"campaigns_{uuid.uuid4().hex[:12]}"
    views = publish_to_groups(
        x.spark, name, path, columns, {"north": ["PY_N0"], "south": ["EF_AT"], "nobody": []}
    )
    other = x.spark.newSession()
    shown = [
        other.table(view).withColumn("reader", F.lit(view.rsplit("_", 1)[1])) for view in views
    ]
    both = shown[0].unionByName(shown[1])
    return both.withColumn("discount_value", near(F.col("discount_value")))


@register("campaigns_run_targets", plain("curated_campaigns_run"))
def _(x):
    """The tables that two runs leave: the second replaces the first, read as a reader would."""
    root = work_path(x.spark, "campaign-targets")
    tables = campaigns_run(x)
    empty = {name: df.limit(0) for name, df in tables.items()}
    for run in (empty, tables):
        leave_tables(run, root, CAMPAIGN_TARGETS, strict=False)
    return campaign_sizes(read_left(x.spark, root, "campaigns_nested", CAMPAIGN_TARGETS))
