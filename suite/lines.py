"""Order lines and nested orders."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from fundspark.functions.money import NUMERIC
from fundspark.operators import lines as ops
from fundspark.operators import orders as order_ops
from fundspark.operators.feeds import (
    ITEM_NAMES,
    ORDER_CAMPAIGN_NAMES,
    ORDER_NAMES,
    combo_flag,
    renamed,
)
from fundspark.operators.nested import unfold
from fundspark.operators.skew import hot_keys
from suite.model import FULL, Inputs, near, register, rounded, sql_near, sql_rounded

LINE = ["order_id", "picking_order_item_id"]
LINE_SQL = "l.order_id, l.picking_order_item_id"

# --- identifiers and quantities -----------------------------------------------------------------

STEPS_SQL = """
steps as (
  select global_entity_id, global_catalog_id, sku, platform_vendor_id,
    min(try_cast(split_part(tag, '-', 2) as double)) as weight_step
  from (select *, tag_one as tag from f_catalog union all select *, tag_two as tag from f_catalog)
  where lower(tag) like 'weighted_step-%' and global_entity_id = 'EF_AT'
  group by all)"""


@register("weight_step", f"with {STEPS_SQL} select * from steps")
def _(x):
    steps = ops.weight_step(x.catalog, FULL)
    return steps.withColumn("weight_step", F.col("weight_step").cast("double"))


def stepped_sql(table: str, key: str) -> str:
    amounts = ", ".join(
        f"""case when l.global_entity_id = 'EF_AT' and w.weight_step is not null
          then round(l.{q} / nullif(w.weight_step, 0), 2) else l.{q} end as {q}"""
        for q in ops.QUANTITIES
    )
    return f"""select l.* exclude ({", ".join(ops.QUANTITIES)}), {amounts} from {table} as l
      left join steps as w on w.global_entity_id = l.global_entity_id
        and w.platform_vendor_id = l.platform_vendor_id and w.sku = l.sku
        and w.global_catalog_id = l.{key}"""


@register(
    "normalise_quantity",
    f"""with {STEPS_SQL}, done as ({stepped_sql("f_lines_raw", "global_catalog_id")})
    select global_entity_id, {LINE_SQL}, {", ".join(ops.QUANTITIES)} from done as l""",
)
def _(x):
    steps = ops.weight_step(x.catalog, FULL)
    lines = ops.normalise_quantity(x("f_lines_raw"), steps, FULL)
    return lines.select("global_entity_id", *LINE, *ops.QUANTITIES)


IDS = ["sku", "platform_product_id", "global_catalog_id"]
RESOLVED_SQL = f"""
resolved as (
  select l.* exclude ({", ".join(IDS)}), l.global_catalog_id as line_catalog_id,
    {", ".join(f"coalesce(l.{c}, h.{c}, c.{c}) as {c}" for c in IDS)}
  from f_lines_raw as l
    left join f_catalog as c on c.global_entity_id = l.global_entity_id
      and c.platform_vendor_id = l.platform_vendor_id
      and c.global_catalog_id = l.global_catalog_id
      and l.order_created_at_utc between c.vendor_product_created_at_utc
        and timestamp '2099-12-31 23:59:59'
    left join f_sku_history as h on h.global_entity_id = l.global_entity_id
      and h.platform_vendor_id = l.platform_vendor_id
      and h.platform_product_id = l.platform_product_id
      and l.order_created_at_utc between h.valid_from_utc and h.valid_to_utc)"""


@register(
    "resolve_sku",
    f"with {RESOLVED_SQL} select {LINE_SQL}, {', '.join('l.' + c for c in IDS)} from resolved as l",
)
def _(x):
    resolved = ops.resolve_ids(x("f_lines_raw"), x("f_sku_history"), x.catalog, FULL)
    return resolved.select(*LINE, *IDS)


# --- facts as of the order time -------------------------------------------------------------------

INTERVALS_SQL = """
stays as (
  select *, coalesce(lag(valid_to_utc) over (partition by global_entity_id, join_key
      order by valid_to_utc, warehouse_id, is_dark_store), timestamp '1970-01-01 00:00:00')
      as valid_from_utc
  from (select distinct global_entity_id, warehouse_id, is_dark_store,
      coalesce(platform_vendor_id, additional_platform_vendor_id) as join_key,
      coalesce(migrated_at_utc, timestamp '2030-01-01 00:00:00') as valid_to_utc
    from f_vendor_places) as p)"""
STAY_JOIN = """left join stays as w on w.global_entity_id = l.fulfilled_by_entity
      and w.join_key = l.platform_vendor_id
      and l.order_created_at_utc between w.valid_from_utc and w.valid_to_utc"""


@register(
    "warehouse_asof",
    f"""with {INTERVALS_SQL}
    select {LINE_SQL}, w.warehouse_id, coalesce(w.is_dark_store, false) as is_dark_store
    from f_lines_raw as l {STAY_JOIN}""",
)
def _(x):
    intervals = ops.warehouse_intervals(x.warehouses)
    return ops.warehouse_asof(x("f_lines_raw"), intervals, FULL).select(
        *LINE, "warehouse_id", "is_dark_store"
    )


VAT_SQL = """
vat as (
  select global_entity_id, global_catalog_id, cast(vat_rate as double) as rate,
    timestamp_valid_from as valid_from_utc,
    coalesce(lead(timestamp_valid_from) over (partition by global_entity_id, global_catalog_id
      order by timestamp_valid_from, vat_rate), timestamp '2030-01-01 00:00:00') as valid_to_utc
  from f_vat_events)"""


def history_join(table: str, alias: str, entity: str, where: str = "true") -> str:
    return f"""left join {table} as {alias} on {alias}.global_entity_id = l.{entity}
      and {alias}.global_catalog_id = l.global_catalog_id and {where}
      and l.order_created_at_utc >= {alias}.valid_from_utc
      and l.order_created_at_utc < {alias}.valid_to_utc"""


@register(
    "vat_asof",
    f"""with {VAT_SQL} select {LINE_SQL},
      {sql_near('coalesce(v.rate, l.vat_percentage)', 6)} as product_vat_rate
    from f_lines_raw as l {history_join("vat", "v", "fulfilled_by_entity")}""",
)
def _(x):
    lines = ops.vat_asof(x("f_lines_raw"), ops.vat_intervals(x("f_vat_events")), FULL)
    return lines.select(*LINE, *rounded("product_vat_rate", digits=6))


LISTED = "coalesce(p.original_price_lc, l.unit_price_lc, 0)"


@register(
    "price_asof",
    f"""select {LINE_SQL}, {sql_near(LISTED)} as unit_price_listed_lc,
      {sql_near(f'coalesce(greatest({LISTED} - l.unit_price_paid_lc, 0), 0)')} as unit_discount_lc
    from f_lines_raw as l {history_join("f_price_history", "p", "fulfilled_by_entity")}""",
)
def _(x):
    lines = ops.price_asof(x("f_lines_raw"), x("f_price_history"), FULL)
    return lines.select(*LINE, *rounded("unit_price_listed_lc", "unit_discount_lc"))


WAC_JOIN = """left join f_wac as c on c.global_entity_id = l.fulfilled_by_entity
      and c.warehouse_id = l.warehouse_id and c.sku = l.sku
      and l.order_created_at_utc between c.valid_from and c.valid_to"""


@register(
    "cost_asof",
    f"""with {INTERVALS_SQL},
    placed as (select l.*, w.warehouse_id from f_lines_raw as l {STAY_JOIN})
    select {LINE_SQL}, l.warehouse_id, {sql_near('c.wac')} as wac,
      {sql_near('coalesce(c.wac, l.unit_price_lc)')} as unit_cost_lc
    from placed as l {WAC_JOIN}""",
)
def _(x):
    intervals = ops.warehouse_intervals(x.warehouses)
    placed = ops.warehouse_asof(x("f_lines_raw"), intervals, FULL)
    costed = ops.cost_asof(placed, x("f_wac"), FULL)
    return costed.select(*LINE, "warehouse_id", *rounded("wac", "unit_cost_lc"))


@register(
    "sales_buffer_asof",
    f"""select {LINE_SQL}, b.sales_buffer from f_lines_raw as l
    {history_join("f_buffer_history", "b", "global_entity_id")}""",
)
def _(x):
    lines = ops.sales_buffer_asof(x("f_lines_raw"), x("f_buffer_history"), FULL)
    return lines.select(*LINE, "sales_buffer")


CHANGES_SQL = """
changes as (
  select * from f_attribute_log
  where cast(valid_from_lt as date) <= date '2001-12-31'
    and updated_field <> 'average_weight_per_piece_unit'
  qualify row_number() over (partition by global_entity_id, global_catalog_id, updated_field,
    cast(valid_from_lt as date) order by valid_from_lt desc nulls last, updated_value) = 1)"""
ATTRIBUTE_FIELDS = {
    "m": "minimum_starting_weight", "sw": "sold_by_weight", "sp": "sold_by_piece",
    "av": "average_weight_per_piece",
}
# One stored history per field, so that every join is an equality with a short residual.
CHANGES_SQL = CHANGES_SQL.replace("changes as (", "changes as materialized (") + "".join(
    f""", changes_{alias} as materialized (
  select global_entity_id, global_catalog_id, valid_from_utc, valid_to_utc, updated_value
  from changes where updated_field = '{field}')"""
    for alias, field in ATTRIBUTE_FIELDS.items()
)
ATTRIBUTE_JOINS = "\n".join(
    history_join(f"changes_{alias}", alias, "global_entity_id") for alias in ATTRIBUTE_FIELDS
)
ATTRIBUTE_SQL = """cast(m.updated_value as double) as minimum_starting_weight,
  cast(sw.updated_value as boolean) as is_sold_by_weight,
  cast(sp.updated_value as boolean) as is_sold_by_piece,
  try_cast(av.updated_value as double) as average_weight_per_piece"""
WEIGHTS = ["minimum_starting_weight", "average_weight_per_piece"]
SOLD_BY = ["is_sold_by_weight", "is_sold_by_piece"]


@register(
    "attribute_history_pivot",
    f"with {CHANGES_SQL} select {LINE_SQL}, {ATTRIBUTE_SQL} from f_lines_raw as l"
    f" {ATTRIBUTE_JOINS}",
)
def _(x):
    lines = ops.attribute_asof(x("f_lines_raw"), x("f_attribute_log"), FULL)
    return lines.select(*LINE, *rounded(*WEIGHTS), *SOLD_BY)


HISTORIES_SQL = f"""with {VAT_SQL}, {CHANGES_SQL}
  select {LINE_SQL}, {sql_near('coalesce(v.rate, l.vat_percentage)', 6)} as product_vat_rate,
    {sql_near(LISTED)} as unit_price_listed_lc,
    {sql_near(f'coalesce(greatest({LISTED} - l.unit_price_paid_lc, 0), 0)')} as unit_discount_lc,
    b.sales_buffer, {ATTRIBUTE_SQL}
  from f_lines_raw as l
    {history_join("vat", "v", "fulfilled_by_entity")}
    {history_join("f_price_history", "p", "fulfilled_by_entity")}
    {history_join("f_buffer_history", "b", "global_entity_id")}
    {ATTRIBUTE_JOINS}"""


def all_histories(x: Inputs, hot_rows: int):
    lines = x("f_lines_raw")
    found = ops.product_histories(
        lines,
        vat=ops.vat_intervals(x("f_vat_events")),
        prices=x("f_price_history"),
        sales_buffers=x("f_buffer_history"),
        attribute_log=x("f_attribute_log"),
        ctx=FULL,
        hot=hot_keys(lines, "global_catalog_id", hot_rows),
        vat_events=x("f_vat_events"),
    )
    return found.select(
        *LINE,
        *rounded("product_vat_rate", digits=6),
        *rounded("unit_price_listed_lc", "unit_discount_lc", *WEIGHTS),
        "sales_buffer",
        *SOLD_BY,
    )


@register("product_histories", HISTORIES_SQL)
def _(x):
    return all_histories(x, FULL.hot_rows)


@register("product_histories_split", HISTORIES_SQL)
def _(x):
    """As above with every product of more than 20 lines dealt to several tasks."""
    return all_histories(x, 20)


KG_SQL = "coalesce(is_sold_by_weight, false) or coalesce(is_sold_by_piece, false)"
WEIGHT_NAMES = {
    "ordered_weight": "quantity_ordered", "delivered_weight": "quantity_delivered",
    "sold_weight": "quantity_sold", "returned_weight": "quantity_returned",
}


@register(
    "weight_fields",
    f"""with {CHANGES_SQL},
    known as (select l.*, {ATTRIBUTE_SQL} from f_lines_raw as l {ATTRIBUTE_JOINS})
    select order_id, picking_order_item_id, {KG_SQL} as is_weightable,
      {", ".join(f"case when {KG_SQL} then {q} end as {w}" for w, q in WEIGHT_NAMES.items())},
      case when {KG_SQL} then 'KG' end as weight_unit, minimum_starting_weight
    from known""",
)
def _(x):
    lines = ops.attribute_asof(x("f_lines_raw"), x("f_attribute_log"), FULL)
    attributes = F.col("weightable_attributes")
    return ops.weight_fields(lines).select(
        *LINE,
        attributes["is_weightable"].alias("is_weightable"),
        *WEIGHT_NAMES,
        "weight_unit",
        attributes["minimum_starting_weight"].cast("double").alias("minimum_starting_weight"),
    )


FX_JOIN = """left join f_fx as fx on fx.currency_code = l.currency_code
      and fx.exchange_rate_date = cast(l.order_created_at_utc as date)"""


@register(
    "fx_convert",
    f"""select {LINE_SQL}, {sql_near('l.unit_price_lc / fx.exchange_rate_value')} as unit_price_eur,
      {sql_near('l.total_amt_paid_lc / fx.exchange_rate_value')} as total_amt_paid_eur,
      {sql_near('fx.exchange_rate_value')} as fx_rate
    from f_lines_raw as l {FX_JOIN}""",
)
def _(x):
    eur = {"unit_price_eur": "unit_price_lc", "total_amt_paid_eur": "total_amt_paid_lc"}
    lines = ops.fx_convert(x("f_lines_raw"), x("f_fx"), eur)
    return lines.select(*LINE, *rounded(*eur, "fx_rate"))


ECONOMICS = [
    "total_amt_paid_net_lc", "total_amt_paid_net_eur", "amt_cogs_lc", "amt_cogs_eur",
    "total_ppp_lc", "total_ppp_eur",
]


def economics_sql(funded_lc: str, funded_eur: str) -> str:
    """Money of a line `l` with wac, product_vat_rate, fx_rate and the weight flags."""
    vat = "(1 + coalesce(l.product_vat_rate, 0) / 100)"
    kept = "coalesce(l.quantity_delivered - coalesce(l.quantity_returned, 0), 0)"
    factor = "case when l.is_sold_by_weight or l.is_sold_by_piece then 1000 else 1 end"
    cost = "coalesce(l.wac, 0)"
    parts = {
        "total_amt_paid_net_lc": f"l.total_amt_paid_lc / {vat}",
        "total_amt_paid_net_eur": f"l.total_amt_paid_lc / l.fx_rate / {vat}",
        "amt_cogs_lc": f"{cost} * {kept} * {factor}",
        "amt_cogs_eur": f"{cost} / l.fx_rate * {kept} * {factor}",
        "total_ppp_lc": f"""l.total_amt_paid_lc / {vat} - {cost} * l.quantity_delivered
          + coalesce({funded_lc}, 0)""",
        "total_ppp_eur": f"""l.total_amt_paid_lc / l.fx_rate / {vat}
          - {cost} / l.fx_rate * l.quantity_delivered + coalesce({funded_eur}, 0)""",
    }
    return ", ".join(f"{sql_near(sql, 3)} as {name}" for name, sql in parts.items())


@register(
    "unit_economics",
    f"""with ready as (
      select *, case when rn % 4 = 0 then null else unit_price_lc / 2 end as wac,
        case when rn % 5 = 0 then null else vat_percentage end as product_vat_rate,
        cast(1.5 as double) as fx_rate, rn % 3 = 0 as is_sold_by_weight,
        case when rn % 2 = 0 then false end as is_sold_by_piece,
        case when rn % 7 > 0 then cast(2 as double) end as funded_lc,
        cast(1 as double) as funded_eur
      from (select *, cast(substr(order_id, 2) as bigint) as rn from f_lines_raw) as numbered)
    select {LINE_SQL}, {economics_sql("l.funded_lc", "l.funded_eur")} from ready as l""",
)
def _(x):
    rn = F.substring("order_id", 2, 30).cast("bigint")
    ready = x("f_lines_raw").withColumns(
        {
            "wac": F.when(rn % 4 != 0, F.col("unit_price_lc") / 2),
            "product_vat_rate": F.when(rn % 5 != 0, F.col("vat_percentage")),
            "fx_rate": F.lit(1.5),
            "is_sold_by_weight": rn % 3 == 0,
            "is_sold_by_piece": F.when(rn % 2 == 0, F.lit(False)),
            "__first_funded_lc": F.when(rn % 7 > 0, F.lit(2.0)),
            "__first_funded_eur": F.lit(1.0),
        }
    )
    return ops.unit_economics(ready).select(*LINE, *rounded(*ECONOMICS, digits=3))


# --- campaigns on lines -----------------------------------------------------------------------------

CAMPAIGN_ON = """{a}.global_entity_id = l.global_entity_id
      and lower({a}.country_code) = lower(l.country_code) and {a}.order_id = l.order_id
      and {a}.promo_order_item_id is not distinct from l.promo_order_item_id"""
TWO_KEY_JOIN = f"""left join f_line_campaigns as ca on {CAMPAIGN_ON.format(a="ca")}
      and ca.global_catalog_id = l.global_catalog_id
    left join f_line_campaigns as cb on {CAMPAIGN_ON.format(a="cb")}
      and cb.platform_product_id = l.platform_product_id and ca.order_id is null"""
TWO_KEY_AMOUNTS = ", ".join(
    f"{sql_near(f'coalesce(ca.{c}, cb.{c}, 0)')} as {c}" for c in ops.MATCH_AMOUNTS
)


@register(
    "campaign_two_key_match",
    f"""with coded as (select *, upper(split_part(global_entity_id, '_', 2)) as country_code
      from f_lines_raw)
    select {LINE_SQL}, {TWO_KEY_AMOUNTS},
      coalesce(ca.some_campaign_id, cb.some_campaign_id) as some_campaign_id
    from coded as l {TWO_KEY_JOIN}""",
)
def _(x):
    coded = x("f_lines_raw").withColumn(
        "country_code", F.upper(F.split("global_entity_id", "_")[1])
    )
    matched = ops.two_key_match(coded, x.line_campaigns)
    return matched.select(
        *LINE,
        *rounded(*ops.MATCH_AMOUNTS),
        F.get("campaign_info", F.lit(0))["campaign_id"].alias("some_campaign_id"),
    )


PROMO_AMOUNTS = [
    "quantity_sold", "promo_items_before_discount_lc", "promo_items_before_discount_eur",
    "promo_items_discount_lc", "promo_items_discount_eur", "promo_items_paid_lc",
    "promo_items_paid_eur", "promo_items_supplier_funded_lc",
    "promo_items_supplier_funded_eur", "order_items_supplier_funded_lc",
    "order_items_supplier_funded_eur",
]
PROMO_KEYS = [
    "order_created_date_utc", "global_entity_id", "country_code", "order_id",
    "global_catalog_id", "platform_product_id", "promo_order_item_id", "exchange_rate_value",
]


def promo_sum(column: str) -> str:
    return f"sum({column}) as {{0}}_lc, sum({column}) / p.exchange_rate_value as {{0}}_eur"


ITEM_ID_SINCE_UTC = "2024-02-07 10:36:00"
PROMO_SQL = f"""
known as (select distinct global_entity_id, global_catalog_id, sku from f_catalog),
paired as (
  select p.*, e.abs_value, k.sku,
    case when p.created_at_utc >= timestamp '{ITEM_ID_SINCE_UTC}' and (p.region = 'ap'
      or (p.region = 'eu' and lower(split_part(p.global_entity_id, '_', 2)) in
        ('at', 'cz', 'de', 'fi', 'hu', 'no', 'se', 'sk', 'tr')))
      then p.promo_order_item_id end as trusted_item
  from f_promo_flat as p
    left join known as k on k.global_entity_id = p.global_entity_id
      and k.global_catalog_id = p.product_id
    left join (select global_entity_id, order_id, sku, campaign_id, amount as abs_value
      from f_external) as e
      on e.global_entity_id = p.global_entity_id and e.order_id = p.order_id
      and e.sku = k.sku and e.campaign_id = p.campaign_id),
per_line as (
  select created_date as order_created_date_utc, global_entity_id, country_code, order_id,
    product_id as global_catalog_id, platform_product_id, trusted_item as promo_order_item_id,
    exchange_rate_value, sum(product_qty) as quantity_sold,
    {promo_sum("subtotal").format("promo_items_before_discount")},
    {promo_sum("absolute_discount_lc").format("promo_items_discount")},
    {promo_sum("total").format("promo_items_paid")},
    coalesce(sum(supplier_funded_amount), 0) as promo_items_supplier_funded_lc,
    coalesce(sum(supplier_funded_amount), 0) / exchange_rate_value
      as promo_items_supplier_funded_eur,
    coalesce(sum(abs_value), sum(supplier_funded_amount), 0) as order_items_supplier_funded_lc,
    coalesce(sum(abs_value), sum(supplier_funded_amount), 0) / exchange_rate_value
      as order_items_supplier_funded_eur,
    count(*) as element_count,
    string_agg(campaign_id, '|' order by campaign_id) as campaign_ids,
    string_agg(parent_product_id, '|' order by parent_product_id) as combo_ids,
    sum(coalesce(abs_value, supplier_funded_amount)) as element_funding
  from paired as p
  group by created_date, global_entity_id, country_code, order_id, product_id,
    platform_product_id, trusted_item, exchange_rate_value)"""


LINE_CAMPAIGNS_SQL = f"""with {PROMO_SQL} select {", ".join(PROMO_KEYS)},
      {sql_rounded(*PROMO_AMOUNTS)},
      element_count, coalesce(campaign_ids, '') as campaign_ids,
      coalesce(combo_ids, '') as combo_ids, {sql_near('coalesce(element_funding, 0)')}
        as element_funding from per_line"""
# Within the dates of the test orders, so that both sides of the instant occur.
ITEM_ID_TRIAL = "1998-06-15 12:00:00"


@register("order_line_campaigns", LINE_CAMPAIGNS_SQL)
def _(x):
    return checked_line_campaigns(x)


@register(
    "order_line_campaigns_item_id", LINE_CAMPAIGNS_SQL.replace(ITEM_ID_SINCE_UTC, ITEM_ID_TRIAL)
)
def _(x):
    return checked_line_campaigns(x, item_id_since=f"{ITEM_ID_TRIAL} UTC")


def checked_line_campaigns(x, **settings):
    external = x("f_external").withColumnRenamed("amount", "abs_discount_value_lt")
    lines = ops.order_line_campaigns(x.promo_orders, x.catalog, external, **settings)
    funding = F.aggregate(
        "campaign_info",
        F.lit(0.0),
        lambda total, c: total
        + F.coalesce(c["campaign_supplier_funded_amt_lc"].cast("double"), F.lit(0.0)),
    )
    return lines.select(
        *PROMO_KEYS,
        *rounded(*PROMO_AMOUNTS),
        F.size("campaign_info").cast("bigint").alias("element_count"),
        F.array_join(F.array_sort("campaign_info.campaign_id"), "|").alias("campaign_ids"),
        F.array_join(F.array_sort("combo_products.combo_product_id"), "|").alias("combo_ids"),
        near(funding).alias("element_funding"),
    )


# --- the whole order line ---------------------------------------------------------------------------

CURATED_AMOUNTS = [
    "unit_price_listed_lc", "unit_price_listed_eur", "unit_discount_lc", "unit_discount_eur",
    "unit_cost_lc", "unit_cost_eur", "product_vat_rate", "fx_rate", "sales_buffer",
    "unit_price_eur", "unit_price_paid_eur", "total_amt_paid_eur", *ops.MATCH_AMOUNTS,
    *ops.QUANTITIES, "sold_weight", "returned_weight",
]
CURATED_PLAIN = [
    "order_id", "country_code", "picking_order_item_id", "warehouse_id", "is_dark_store", "sku",
    "platform_product_id", "global_catalog_id", "vertical_parent", "weight_unit",
]
CURATED_SQL = f"""
with {STEPS_SQL}, {RESOLVED_SQL},
stepped as ({stepped_sql("resolved", "line_catalog_id")}), {INTERVALS_SQL}, {VAT_SQL}, {CHANGES_SQL},
coded as (select *, lower(split_part(global_entity_id, '_', 2)) as country_code from stepped),
placed as (select l.*, w.warehouse_id, coalesce(w.is_dark_store, false) as is_dark_store,
    d.vertical_parent
  from coded as l {STAY_JOIN}
    left join f_vendor_verticals as d on d.global_entity_id = l.global_entity_id
      and d.platform_vendor_id = l.platform_vendor_id),
facts as (select l.*, c.wac, coalesce(v.rate, l.vat_percentage) as product_vat_rate,
    {LISTED} as listed, b.sales_buffer, fx.exchange_rate_value as fx_rate, {ATTRIBUTE_SQL},
    {", ".join(f"coalesce(ca.{c}, cb.{c}, 0) as {c}" for c in ops.MATCH_AMOUNTS)},
    ca.order_items_supplier_funded_lc as first_lc, ca.order_items_supplier_funded_eur as first_eur
  from placed as l {WAC_JOIN}
    {history_join("vat", "v", "fulfilled_by_entity")}
    {history_join("f_price_history", "p", "fulfilled_by_entity")}
    {history_join("f_buffer_history", "b", "global_entity_id")}
    {ATTRIBUTE_JOINS}
    {TWO_KEY_JOIN}
    {FX_JOIN}),
shown as (select l.*, listed as unit_price_listed_lc, listed / fx_rate as unit_price_listed_eur,
    greatest(listed - unit_price_paid_lc, 0) as unit_discount_lc,
    greatest(listed - unit_price_paid_lc, 0) / fx_rate as unit_discount_eur,
    coalesce(wac, unit_price_lc) as unit_cost_lc,
    coalesce(wac, unit_price_lc) / fx_rate as unit_cost_eur,
    unit_price_lc / fx_rate as unit_price_eur, unit_price_paid_lc / fx_rate as unit_price_paid_eur,
    total_amt_paid_lc / fx_rate as total_amt_paid_eur,
    case when {KG_SQL} then quantity_sold end as sold_weight,
    case when {KG_SQL} then quantity_returned end as returned_weight,
    case when {KG_SQL} then 'KG' end as weight_unit
  from facts as l)
select {", ".join("l." + c for c in CURATED_PLAIN)}, {economics_sql("first_lc", "first_eur")},
  {", ".join(f"{sql_near(f'coalesce(l.{c}, 0)' if c in ops.QUANTITIES else f'l.{c}')} as {c}" for c in CURATED_AMOUNTS)}
from shown as l"""


# A daily run: the eight days before the run date and the run date itself.
DAILY = replace(FULL, as_of=date(1998, 6, 15), backfill=False)
DAILY_SQL = f"""{CURATED_SQL}
where l.order_created_date_utc between date '1998-06-07' and date '1998-06-15'"""


def curated_lines(x: Inputs, ctx=FULL):
    raw = x("f_lines_raw").withColumn("returns", F.array().cast("array<struct<reason:string>>"))
    return ops.order_lines_curated(
        raw,
        sku_history=x("f_sku_history"),
        catalog=x.catalog,
        warehouses=x.warehouses,
        vendors=x("f_vendor_verticals"),
        wac=x("f_wac"),
        vat_events=x("f_vat_events"),
        price_history=x("f_price_history"),
        sales_buffers=x("f_buffer_history"),
        attribute_log=x("f_attribute_log"),
        line_campaigns=x.line_campaigns,
        fx=x("f_fx"),
        ctx=ctx,
    )


@register("order_lines_curated_daily", DAILY_SQL)
def _(x):
    day = F.col("order_created_date_utc")
    return curated_lines(x, DAILY).where(day <= F.lit(DAILY.as_of)).select(
        *CURATED_PLAIN, *rounded(*ECONOMICS, digits=3), *rounded(*CURATED_AMOUNTS)
    )


@register("order_lines_curated", CURATED_SQL)
def _(x):
    return curated_lines(x).select(
        *CURATED_PLAIN, *rounded(*ECONOMICS, digits=3), *rounded(*CURATED_AMOUNTS)
    )


# --- nested orders ----------------------------------------------------------------------------------


@register(
    "orders_nested_promos",
    f"""with per_product as (
      select country_code, order_id, product_id, parent_product_id, count(*) as campaign_count,
        sum(discount) as discount, string_agg(campaign_id, '|' order by campaign_id) as ids
      from f_cart_campaigns group by all),
    listed as (
      select i.*, c.campaign_count, c.discount, c.ids from f_cart_items as i
        left join per_product as c on c.country_code = i.country_code
          and c.order_id = i.order_id and c.product_id = i.product_id
          and c.parent_product_id is not distinct from i.parent_product_id),
    flags as (select country_code, order_id, bool_or(campaign_count is not null) as any_campaign
      from listed group by all)
    select o.country_code, o.order_id as promo_order_id, o.platform_order_code as order_id,
      coalesce(f.any_campaign, false) as order_has_campaigns, fx.currency_code,
      {sql_near('fx.exchange_rate_value')} as exchange_rate_value, i.product_id, i.parent_product_id,
      {sql_near('i.total')} as total, case when i.order_id is not null
        then i.campaign_count is not null end as product_has_campaigns,
      coalesce(i.campaign_count, 0) as campaign_count, coalesce(i.ids, '') as campaign_ids,
      {sql_near('coalesce(i.discount, 0)')} as campaign_discount
    from f_cart_orders as o
      left join flags as f on f.country_code = o.country_code and f.order_id = o.order_id
      left join listed as i on i.country_code = o.country_code and i.order_id = o.order_id
      left join f_fx as fx on fx.country_code = o.country_code
        and fx.exchange_rate_date = o.created_date""",
)
def _(x):
    items = renamed(x("f_cart_items"), ITEM_NAMES).withColumn(
        "is_combo_product", combo_flag(F.col("parent_product_id"))
    )
    nested = order_ops.orders_nested_promos(
        renamed(x("f_cart_orders"), ORDER_NAMES).drop("total"),
        items,
        renamed(x("f_cart_campaigns"), ORDER_CAMPAIGN_NAMES),
        x("f_fx"),
        FULL,
    )
    parent = ["country_code", "promo_order_id", "order_id", "order_has_campaigns",
              "currency_code", "exchange_rate_value"]
    products = unfold(nested, "products", parent, outer=True)
    total = F.aggregate(
        F.coalesce("campaigns.discount_lc", F.array().cast("array<double>")),
        F.lit(0.0),
        lambda a, d: a + d,
    )
    return products.select(
        *[c for c in parent if c != "exchange_rate_value"],
        *rounded("exchange_rate_value", "total"),
        "product_id",
        "parent_product_id",
        "product_has_campaigns",
        F.coalesce(F.array_size("campaigns"), F.lit(0)).cast("bigint").alias("campaign_count"),
        F.coalesce(
            F.array_join(F.array_sort("campaigns.campaign_id"), "|"), F.lit("")
        ).alias("campaign_ids"),
        near(total).alias("campaign_discount"),
    )


def order_headers(x: Inputs):
    """Headers with every published column; amounts are fixed shares of the order total."""
    heads = x("f_order_heads")
    known = {
        "order_created_date_utc": F.col("order_date"),
        "order_created_date_lt": F.col("order_date"),
        "fulfilled_by_entity": F.col("global_entity_id"),
        "order_created_at_utc": F.col("order_at"),
        "order_status": F.col("status"),
        "warehouse_id": F.concat(F.lit("W"), F.col("n"), F.lit("-"), F.col("slot") % 3),
    }
    given = ("global_entity_id", "country_code", "currency_code", "order_id")
    columns = [F.col(c) for c in given] + [c.alias(n) for n, c in known.items()]
    columns += [
        F.lit(None).cast("string").alias(c)
        for c in order_ops.HEADER
        if c not in known and c not in given
    ]
    for i, value in enumerate(order_ops.ORDER_VALUES):
        columns.append((F.col("total") * (i + 1) / 100).alias(f"{value}_lc"))
        columns.append((F.col("total") * (i + 1) / 200).alias(f"{value}_eur"))
    columns += [(F.col("total") / 3).alias(f"{v}_lc") for v in order_ops.LOCAL_ONLY_VALUES]
    return heads.select(*columns)


def order_item_rows(x: Inputs):
    """Lines with every nested item column."""
    raw = x("f_lines_raw")
    price = F.col("unit_price_lc")
    extra = {f"{v}_lc": price * (i + 1) for i, v in enumerate(order_ops.ITEM_VALUES)}
    extra |= {f"{v}_eur": price / (i + 1) for i, v in enumerate(order_ops.ITEM_VALUES)}
    extra = {k: v.cast(NUMERIC) if k.startswith(("amt_cogs", "total_ppp")) else v
             for k, v in extra.items()}
    missing = [c for c in order_ops.ITEM_FIELDS if c not in raw.columns]
    for name in (*missing, "returns", "combo_products", "weightable_attributes"):
        extra[name] = F.lit(None).cast("string")
    return raw.withColumns(extra)


# Every published amount by its place in the list: swapping two of them shows.
ORDER_AMOUNTS_SQL = [
    *[f"{sql_near(f'o.total * {i} / 100')} as {v}_lc"
      for i, v in enumerate(order_ops.ORDER_VALUES, start=1)],
    *[f"{sql_near(f'o.total * {i} / 200')} as {v}_eur"
      for i, v in enumerate(order_ops.ORDER_VALUES, start=1)],
    *[f"{sql_near('o.total / 3')} as {v}_lc" for v in order_ops.LOCAL_ONLY_VALUES],
]
ITEM_AMOUNTS_SQL = [
    *[f"{sql_near(f'l.unit_price_lc * {i}')} as item_{v}_lc"
      for i, v in enumerate(order_ops.ITEM_VALUES, start=1)],
    *[f"{sql_near(f'l.unit_price_lc / {i}')} as item_{v}_eur"
      for i, v in enumerate(order_ops.ITEM_VALUES, start=1)],
]


@register(
    "orders_curated",
    f"""select o.global_entity_id, o.order_id, o.order_date as order_created_date_lt,
      r.customer_qc_order_rank,
      coalesce(r.is_acquisition_qcommerce, false) as is_acquisition_qcommerce,
      coalesce(r.is_acquisition_darkstore, false) as is_acquisition_darkstore,
      coalesce(r.is_acquisition_localshop, false) as is_acquisition_localshop,
      {", ".join(ORDER_AMOUNTS_SQL)}, l.sku, l.quantity_sold, {", ".join(ITEM_AMOUNTS_SQL)}
    from f_order_heads as o
      left join f_lines_raw as l on l.global_entity_id = o.global_entity_id
        and l.order_id = o.order_id
      left join f_ranks as r on r.global_entity_id = o.global_entity_id
        and r.order_id = o.order_id""",
)
def _(x):
    curated = order_ops.orders_curated(order_headers(x), order_item_rows(x), x("f_ranks"), FULL)
    head = ["global_entity_id", "order_id", "order_created_date_lt", "customer_qc_order_rank",
            *order_ops.ACQUISITION_FLAGS]
    structs = {"order_value_euro": "eur", "order_value_lc": "lc"}
    amounts = [
        near(F.col(f"{struct}.{v}_{unit}")).alias(f"{v}_{unit}")
        for struct, unit in structs.items()
        for v in order_ops.ORDER_VALUES
    ]
    amounts += [
        near(F.col(f"order_value_lc.{v}_lc")).alias(f"{v}_lc") for v in order_ops.LOCAL_ONLY_VALUES
    ]
    parent = curated.select(*head, *amounts, F.explode_outer("items").alias("i"))
    return parent.select(
        *[c for c in parent.columns if c != "i"],
        "i.sku",
        "i.quantity_sold",
        *[near(F.col(f"i.value_lc.{v}_lc")).alias(f"item_{v}_lc") for v in order_ops.ITEM_VALUES],
        *[near(F.col(f"i.value_euro.{v}_eur")).alias(f"item_{v}_eur") for v in order_ops.ITEM_VALUES],
    )
