"""Run calendar, feed cleaning and incremental filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fundspark.context import RunContext
from fundspark.functions.calendar import register_sql_functions, run_partitions, run_window
from fundspark.functions.sql import register_all
from fundspark.operators import feeds
from fundspark.operators.lineage import work_path
from fundspark.operators.rules import country_rules
from fundspark.operators.skew import bounded_join
from fundspark.operators.temporal import scd2_from_events
from fundspark.sources.catalogs import read_contracted
from fundspark.streaming.refresh import backfill_filter, lookback_filter, month_window_filter
from suite.model import MONTHLY, QUERIES, Inputs, register, rounded, sql_rounded, sql_text, text

WINDOW_SQL = """
calendar as (select distinct cast(o_orderdate as date) as input_date from orders),
marked as (
  select input_date, date_part('day', input_date) as dom, isodow(input_date) = 1 as monday,
    input_date - cast(isodow(input_date) - 1 as int) as week_start from calendar),
windows as (
  select input_date, dom = 1 and not monday as is_first_of_month_not_monday,
    monday and dom between 2 and 7 as is_first_monday_after_first,
    case when dom = 1 and not monday then week_start
      when monday and dom between 2 and 7 then input_date - cast(dom - 1 as int)
      else week_start - 7 end as filter_start_date,
    case when dom = 1 and not monday then last_day(input_date)
      when monday and dom between 2 and 7 then input_date - 1
      else week_start - 1 end as filter_end_date
  from marked)"""


def order_dates(x: Inputs):
    return x.base("orders").select(F.to_date("o_orderdate").alias("input_date")).distinct()


@register("run_window", f"with {WINDOW_SQL} select * from windows")
def _(x):
    return run_window(order_dates(x))


@register(
    "run_window_sql_function",
    f"with {WINDOW_SQL} select input_date, filter_start_date, filter_end_date from windows",
)
def _(x):
    register_sql_functions(x.spark)
    return order_dates(x).selectExpr(
        "input_date",
        "run_window_start(input_date) AS filter_start_date",
        "run_window_end(input_date) AS filter_end_date",
    )


@register(
    "run_partitions_sql",
    f"""with {WINDOW_SQL} select input_date,
    cast(unnest(generate_series(filter_start_date, filter_end_date, interval 1 day)) as date)
      as partition_date from windows""",
)
def _(x):
    """The partitions of every run date from a table function, in SQL text alone."""
    register_all(x.spark)
    order_dates(x).createOrReplaceTempView("run_dates")
    return x.spark.sql(
        "SELECT d.input_date, p.partition_date FROM run_dates AS d, LATERAL run_partitions(d.input_date) AS p"
    )


@register(
    "run_partitions",
    f"""with {WINDOW_SQL} select input_date,
    cast(unnest(generate_series(filter_start_date, filter_end_date, interval 1 day)) as date)
      as partition_date from windows""",
)
def _(x):
    return run_partitions(order_dates(x))


ENTITY_LIST = ", ".join(f"'{e}'" for e in MONTHLY.entities)


@register(
    "enabled_entities",
    f"""select global_entity_id, count(*) as order_count from f_order_heads
    where global_entity_id in ({ENTITY_LIST}) group by global_entity_id""",
)
def _(x):
    orders = x("f_order_heads").select("global_entity_id", "order_id")
    return (
        bounded_join(orders, x.entities, ["global_entity_id"])
        .groupBy("global_entity_id")
        .agg(F.count(F.lit(1)).alias("order_count"))
    )


RULE_COLUMNS = """global_entity_id, country_code, join_strategy, require_discount_to_charge,
  missing_contract_fallback, funding_value_convention, funding_source, param_billing_period"""


@register("country_rules", f"select {RULE_COLUMNS} from f_rules where is_active")
def _(x):
    columns = [c.strip() for c in RULE_COLUMNS.split(",")]
    return country_rules(x("f_rules")).select(*columns)


# --- two feeds merged -----------------------------------------------------------------------------


def merge_sql(new: str, old: str, keys: list[str], values: list[str], times: list[str]) -> str:
    """Latest instant per key over both feeds, then each feed joined back on key and instant."""
    key_list = ", ".join(keys)

    def back(alias: str) -> str:
        tests = [f"spine.{k} = {alias}.{k}" for k in keys]
        return " and ".join([*tests, f"spine.created_at_utc = {alias}.created_at_utc"])

    plain = ", ".join(f"coalesce(n.{c}, o.{c}) as {c}" for c in values if c not in times)
    stamps = ", ".join(f"cast(coalesce(n.{c}, o.{c}) as string) as {c}" for c in times)
    return f"""with new_rows as ({new}), old_rows as ({old}),
    spine as (select {key_list}, max(created_at_utc) as created_at_utc from (
        select {key_list}, created_at_utc from new_rows
        union all select {key_list}, created_at_utc from old_rows) group by {key_list})
    select {", ".join(f"spine.{k}" for k in keys)},
      cast(spine.created_at_utc as string) as created_at_utc, {plain}, {stamps}
    from spine left join new_rows as n on {back("n")} left join old_rows as o on {back("o")}"""


ORDER_VALUES = [
    "created_date", "region", "global_entity_id", "order_id", "cart_id", "vendor_id",
    "target_audience", "absolute_discount_lc", "delivery_absolute_discount_lc", "total",
    "subtotal", "delivery_fee", "delivery_total", "minimum_order_value", "status", "client_id",
    "session_id", "src", "updated_at_utc",
]
ORDER_RENAMES = """* exclude (order_id, platform_order_code, absolute_discount,
  delivery_absolute_discount, created_at, modified_at), order_id as promo_order_id,
  platform_order_code as order_id, absolute_discount as absolute_discount_lc,
  delivery_absolute_discount as delivery_absolute_discount_lc, created_at as created_at_utc,
  modified_at as updated_at_utc"""


MERGED_ORDERS_SQL = merge_sql(
    f"""select {ORDER_RENAMES}, json_extract_string(client_info, '$.client_id') as client_id,
    json_extract_string(client_info, '$.session_id') as session_id, 'cart' as src
    from f_cart_orders""",
    f"""select {ORDER_RENAMES}, cast(null as string) as client_id,
    cast(null as string) as session_id, 'app' as src from f_app_orders""",
    ["country_code", "promo_order_id"],
    ORDER_VALUES,
    ["updated_at_utc"],
)


@register("merge_sources_orders", MERGED_ORDERS_SQL)
def _(x):
    merged = feeds.orders_clean(x("f_cart_orders"), x("f_app_orders"))
    stamps = ["created_at_utc", "updated_at_utc"]
    return merged.select(*[c for c in merged.columns if c not in stamps], *text(*stamps))


ITEM_VALUES = [
    "created_date", "global_entity_id", "promo_order_item_id", "parent_product_id",
    "is_combo_product", "product_qty", "product_unit_price", "absolute_discount_lc", "total",
    "subtotal", "free_qty", "platform_product_id", "distributed_discounted_price", "weight",
    "src", "updated_at_utc",
]
ITEM_SHARED = """created_date, country_code, global_entity_id, order_id as promo_order_id,
  product_id, qty as product_qty, price as product_unit_price,
  absolute_discount as absolute_discount_lc, total, subtotal, free_qty,
  created_at as created_at_utc, modified_at as updated_at_utc"""


MERGED_ITEMS_SQL = merge_sql(
    f"""select {ITEM_SHARED}, order_item_id as promo_order_item_id, parent_product_id,
    parent_product_id is not null as is_combo_product, platform_product_id,
    distributed_discounted_price, weight, 'cart' as src from f_cart_items""",
    f"""select {ITEM_SHARED}, cast(null as string) as promo_order_item_id,
    cast(null as string) as parent_product_id, cast(null as boolean) as is_combo_product,
    cast(null as string) as platform_product_id,
    cast(null as double) as distributed_discounted_price, cast(null as double) as weight,
    'app' as src from f_app_items""",
    ["country_code", "promo_order_id", "product_id"],
    ITEM_VALUES,
    ["updated_at_utc"],
)


@register("merge_sources_items", MERGED_ITEMS_SQL)
def _(x):
    merged = feeds.order_items_clean(x("f_cart_items"), x("f_app_items"))
    stamps = ["created_at_utc", "updated_at_utc"]
    return merged.select(*[c for c in merged.columns if c not in stamps], *text(*stamps))


CAMPAIGN_VALUES = [
    "created_date", "global_entity_id", "parent_product_id", "is_combo_product", "discount_lc",
    "applied_times", "benefit_qty", "trigger_qty", "supplier_funded_amount", "ds_synced",
    "external_funder", "src", "updated_at_utc",
]
CAMPAIGN_SHARED = """created_date, country_code, global_entity_id, order_id as promo_order_id,
  campaign_id, product_id, discount as discount_lc, applied_times,
  created_at as created_at_utc, modified_at as updated_at_utc"""


@register(
    "merge_sources_campaigns",
    merge_sql(
        f"""select {CAMPAIGN_SHARED}, parent_product_id,
        parent_product_id is not null as is_combo_product, supplier_funded_amount, benefit_qty,
        trigger_qty, ds_synced, external_funder, 'cart' as src from f_cart_campaigns""",
        f"""select {CAMPAIGN_SHARED}, cast(null as string) as parent_product_id,
        cast(null as boolean) as is_combo_product, cast(null as double) as supplier_funded_amount,
        cast(null as double) as benefit_qty, cast(null as double) as trigger_qty,
        cast(null as boolean) as ds_synced, cast(null as string) as external_funder, 'app' as src
        from f_app_campaigns""",
        ["country_code", "promo_order_id", "campaign_id", "product_id"],
        CAMPAIGN_VALUES,
        ["updated_at_utc"],
    ),
)
def _(x):
    merged = feeds.order_campaigns_clean(x("f_cart_campaigns"), x("f_app_campaigns"))
    stamps = ["created_at_utc", "updated_at_utc"]
    return merged.select(*[c for c in merged.columns if c not in stamps], *text(*stamps))


@register(
    "combo_flag",
    """select coalesce(is_combo, false) as is_combo_product, count(*) as item_count,
      count(distinct order_id) as order_count
    from (select order_id, parent_product_id is not null as is_combo from f_cart_items)
    group by all""",
)
def _(x):
    flagged = x("f_cart_items").withColumn(
        "is_combo_product", feeds.combo_flag(F.col("parent_product_id"))
    )
    return flagged.groupBy("is_combo_product").agg(
        F.count(F.lit(1)).alias("item_count"), F.countDistinct("order_id").alias("order_count")
    )


# --- latest row per key ---------------------------------------------------------------------------

BENEFIT_OUT = """country_code, global_entity_id, campaign_id, sku, discount_type, discount_value,
  max_qty, remaining_qty, supplier_funding_type, supplier_funding_value"""
BENEFIT_RAW = """country_code, global_entity_id, campaign_id, sku, discount_type,
  discount as discount_value, max_qty, remaining_qty,
  supplier_fund_type as supplier_funding_type, supplier_fund_value as supplier_funding_value"""
OLD_BENEFITS_SQL = f"""select {BENEFIT_RAW}, coalesce(created_at, modified_at) as created_at_utc,
    modified_at as updated_at_utc, is_deleted from f_benefits_old_raw
    qualify row_number() over (partition by country_code, campaign_id, sku
      order by modified_at desc nulls last, global_entity_id, discount) = 1"""


def benefit_columns():
    return [c.strip() for c in BENEFIT_OUT.split(",")]


@register(
    "benefits_old_clean",
    f"""select {BENEFIT_OUT}, {sql_text("created_at_utc", "updated_at_utc")}, is_deleted
    from ({OLD_BENEFITS_SQL}) as b""",
)
def _(x):
    return feeds.benefits_old_clean(x("f_benefits_old_raw")).select(
        *benefit_columns(), *text("created_at_utc", "updated_at_utc"), "is_deleted"
    )


@register(
    "benefits_merge",
    f"""with old_rows as ({OLD_BENEFITS_SQL}),
    new_rows as (select {BENEFIT_RAW}, created_at as created_at_utc,
      modified_at as updated_at_utc, is_deleted from f_benefits_new_raw
      qualify row_number() over (partition by country_code, global_entity_id, campaign_id, sku
        order by modified_at desc nulls last) = 1)
    select {BENEFIT_OUT}, {sql_text("created_at_utc", "updated_at_utc")}, is_deleted, src,
      src_priority from (
        select *, 'New benefits' as src, 1 as src_priority from new_rows
        union all
        select o.*, 'Old benefits' as src, 2 as src_priority from old_rows as o
          anti join new_rows as n using (country_code, global_entity_id, campaign_id, sku)) as b""",
)
def _(x):
    merged = feeds.benefits_merge(
        x("f_benefits_new_raw"), feeds.benefits_old_clean(x("f_benefits_old_raw"))
    )
    return merged.select(
        *benefit_columns(), *text("created_at_utc", "updated_at_utc"), "is_deleted", "src",
        "src_priority",
    )


@register(
    "triggers_old_clean",
    f"""select distinct country_code, global_entity_id, campaign_id,
      coalesce(sku, product_id) as sku, cast(created_at as string) as created_at_utc,
      cast(modified_at as string) as updated_at_utc, is_deleted
    from (select *, row_number() over (
        partition by country_code, global_entity_id, campaign_id, product_id, vendor_id
        order by modified_at desc nulls last) as place from f_triggers_old_raw) as t
    where place = 1""",
)
def _(x):
    clean = feeds.triggers_old_clean(x("f_triggers_old_raw"))
    return clean.select(
        "country_code", "global_entity_id", "campaign_id", "sku",
        *text("created_at_utc", "updated_at_utc"), "is_deleted",
    )


@register(
    "triggers_merge",
    """select country_code, global_entity_id, campaign_id, sku,
      cast(created_at_utc as string) as created_at_utc,
      cast(updated_at_utc as string) as updated_at_utc, is_deleted, src, src_priority
    from (select *, 'New triggers' as src, 1 as src_priority from f_triggers_new
      union all by name select *, 'Old triggers' as src, 2 as src_priority from f_triggers_old)
    qualify row_number() over (partition by country_code, global_entity_id, campaign_id, sku
      order by src_priority, updated_at_utc desc nulls last) = 1""",
)
def _(x):
    merged = feeds.triggers_merge(x("f_triggers_new"), x("f_triggers_old"))
    return merged.select(
        "country_code", "global_entity_id", "campaign_id", "sku",
        *text("created_at_utc", "updated_at_utc"), "is_deleted", "src", "src_priority",
    )


@register(
    "campaign_vendors_clean",
    """select country_code, global_entity_id, campaign_id,
      vendor_id as catalog_global_vendor_id, cast(max(creation_date) as string) as created_at_utc,
      cast(coalesce(max(updated_date), max(creation_date)) as string) as updated_at_utc
    from f_campaign_vendors_raw group by all""",
)
def _(x):
    clean = feeds.campaign_vendors_clean(x("f_campaign_vendors_raw"))
    return clean.select(
        "country_code", "global_entity_id", "campaign_id", "catalog_global_vendor_id",
        *text("created_at_utc", "updated_at_utc"),
    )


@register(
    "vendors_clean",
    """select country_code, global_entity_id, vendor_id as catalog_global_vendor_id,
      case when left(global_entity_id, 2) not in ('PY', 'TB', 'HS') then vendor_code end
        as catalog_remote_vendor_id,
      case when left(global_entity_id, 2) in ('PY', 'TB', 'HS') then vendor_code end
        as catalog_additional_remote_vendor_id,
      name, cast(created_at as string) as created_at_utc,
      cast(modified_at as string) as updated_at_utc,
      cast(deleted_at as string) as deleted_at_utc,
      cast(synchronised_at as string) as synchronized_at_utc
    from f_vendors_raw where global_entity_id <> 'TEST_VA'
    qualify row_number() over (partition by country_code, global_entity_id, vendor_id
      order by synchronised_at desc nulls last) = 1""",
)
def _(x):
    clean = feeds.vendors_clean(x("f_vendors_raw"))
    stamps = ["created_at_utc", "updated_at_utc", "deleted_at_utc", "synchronized_at_utc"]
    return clean.select(*[c for c in clean.columns if c not in stamps], *text(*stamps))


@register(
    "external_funding",
    f"""select global_entity_id, country_code, order_id, sku,
      cast(order_fulfilled_at as string) as order_fulfilled_at_utc, campaign_id,
      {sql_rounded("amount").replace(" as amount", " as abs_discount_value_lt")}
    from f_external""",
)
def _(x):
    imported = feeds.external_funding(x("f_external"))
    return imported.select(
        "global_entity_id", "country_code", "order_id", "sku",
        *text("order_fulfilled_at_utc"), "campaign_id", *rounded("abs_discount_value_lt"),
    )


EXTERNAL_CONTRACT = """global_entity_id string, country_code string, order_id string, sku string,
    order_fulfilled_at timestamp, campaign_id string, amount double"""


@register("external_funding_by_name", QUERIES["external_funding"].plain)
def _(x):
    """The same from a table that another team owns, by its qualified name and under a contract."""
    roots = {"partner": work_path(x.spark, "partner")}
    x("f_external").withColumn("internal_note", F.lit("not promised")).write.parquet(
        f"{roots['partner']}/billing/external_funding"
    )
    source = read_contracted(x.spark, "partner.billing.external_funding", EXTERNAL_CONTRACT, roots)
    imported = feeds.external_funding(source)
    return imported.select(
        "global_entity_id", "country_code", "order_id", "sku",
        *text("order_fulfilled_at_utc"), "campaign_id", *rounded("abs_discount_value_lt"),
    )


# --- incremental filters --------------------------------------------------------------------------


@register(
    "lookback_filter",
    """select order_id, order_date from f_order_heads
    where order_date between date '1998-04-23' and date '1998-05-02'""",
)
def _(x):
    heads = x("f_order_heads").select("order_id", "order_date")
    return lookback_filter(heads, "order_date", MONTHLY, pad=1)


@register(
    "backfill_filter",
    """select order_id, order_date from f_order_heads
    where order_date between date '1997-02-01' and date '1998-01-31'""",
)
def _(x):
    ctx = RunContext(
        as_of=date(2001, 12, 31),
        backfill=True,
        backfill_start=date(1997, 2, 1),
        backfill_end=date(1998, 1, 31),
    )
    return backfill_filter(x("f_order_heads").select("order_id", "order_date"), "order_date", ctx)


@register(
    "month_window_filter",
    """select order_id, partition_month_local from f_ranks
    where partition_month_local between date '1998-04-01' and date '1998-05-01'""",
)
def _(x):
    ranks = x("f_ranks").select("order_id", "partition_month_local")
    return month_window_filter(ranks, "partition_month_local", MONTHLY)


@register(
    "scd2_from_events",
    """select global_entity_id, global_catalog_id, vat_rate,
      cast(timestamp_valid_from as string) as valid_from_utc,
      cast(coalesce(lead(timestamp_valid_from) over (
        partition by global_entity_id, global_catalog_id
        order by timestamp_valid_from, vat_rate), timestamp '2030-01-01 00:00:00') as string)
        as valid_to_utc
    from f_vat_events""",
)
def _(x):
    intervals = scd2_from_events(
        x("f_vat_events").withColumnRenamed("timestamp_valid_from", "valid_from_utc"),
        ["global_entity_id", "global_catalog_id"],
        "valid_from_utc",
        ties=["vat_rate"],
    )
    return intervals.select(
        "global_entity_id", "global_catalog_id", "vat_rate",
        *text("valid_from_utc", "valid_to_utc"),
    )
