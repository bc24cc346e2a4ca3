"""Domain tables derived from the test tables.

Every table is one SQL text that Spark and DuckDB both run, so a query and its check share
inputs but no operator logic. All tables cover all rows of what they are derived from.
"""

from __future__ import annotations

import re

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def s(expr: str) -> str:
    return f"cast({expr} as string)"


def day(offset: str, base: str = "1995-01-01") -> str:
    return f"cast(date '{base}' + cast({offset} as int) as date)"


def at(offset: str, hours: int = 0, base: str = "1995-01-01") -> str:
    midnight = f"cast({day(offset, base)} as timestamp)"
    return f"({midnight} + interval '{hours}' hour)" if hours else midnight


A_BLOCK = "cast(floor(pkey / 20) as bigint)"
B_BLOCK = "cast(floor(((pkey * 7) % 20011) / 30) as bigint)"


def campaign_id(kind: str, block: str, n: str = "n") -> str:
    return f"('C' || {s(n)} || '-' || {kind} || {s(block)})"


LINE_CAMPAIGN = (
    f"case when pkey % 3 = 0 then {campaign_id(chr(39) + 'A' + chr(39), A_BLOCK)}"
    f" when pkey % 3 = 1 then {campaign_id(chr(39) + 'B' + chr(39), B_BLOCK)} end"
)
SKU = f"('S' || {s('pkey')})"
CATALOG_ID = f"('K' || {s('n')} || '-' || {s('pkey')})"
PLATFORM_ID = f"('P' || {s('n')} || '-' || {s('pkey')} || '-' || {s('slot % 4')})"
VENDOR = f"('V' || {s('n')} || '-' || {s('slot')})"
GLOBAL_VENDOR = f"('G' || {s('n')} || '-' || {s('slot')})"
WAREHOUSE = f"('W' || {s('n')} || '-' || {s('slot % 3')})"
ENTITY = "global_entity_id, country_code"

FIXTURES: dict[str, str] = {}

FIXTURES["f_entities"] = f"""
select n_nationkey as n,
  case n_nationkey % 5 when 0 then 'PY' when 1 then 'TB' when 2 then 'HS' when 3 then 'EF'
    else 'FP' end || '_' || code as global_entity_id,
  lower(code) as country_code,
  case r_regionkey when 0 then 'me' when 1 then 'am' when 2 then 'ap' when 3 then 'eu'
    else 'af' end as region,
  'U' || {s("n_nationkey")} as currency_code
from (select *, case n_nationkey when 3 then 'AT' when 8 then 'DE' when 13 then 'SE'
        else 'N' || {s("n_nationkey")} end as code
      from nation join region on n_regionkey = r_regionkey) as named"""

FIXTURES["f_rules"] = """
select global_entity_id, country_code,
  case n % 2 when 0 then 'date_warehouse_sku' else 'campaign_id' end as join_strategy,
  n % 3 <> 0 as require_discount_to_charge,
  case when n % 4 < 2 then 'skip' else 'full_discount' end as missing_contract_fallback,
  case when n % 8 < 4 then 'normalized' else 'per_benefit' end as funding_value_convention,
  case when n % 5 = 4 then 'promotool' else 'negotiated' end as funding_source,
  case when n % 3 = 1 then 'order_date' else 'campaign_end_date' end as param_billing_period,
  n % 7 <> 6 as is_active,
  timestamp '2001-01-01 00:00:00' as updated_at
from f_entities"""

FIXTURES["f_sales"] = f"""
select e.n, e.global_entity_id, e.country_code, e.region, e.currency_code,
  o_orderkey as okey, 'O' || {s("o_orderkey")} as order_id, o_orderstatus as status,
  cast(o_orderdate as date) as order_date,
  case o_orderkey % 3 when 0 then cast(o_orderdate as timestamp)
    when 1 then cast(o_orderdate as timestamp) + interval '9' hour
    else cast(o_orderdate as timestamp) + interval '20' hour end as order_at,
  o_custkey as ckey, o_custkey % 40 as slot, l_partkey as pkey, l_suppkey as skey,
  l_linenumber as lno, l_quantity as qty, l_extendedprice / l_quantity as price,
  l_discount as disc, l_tax as tax, l_returnflag as rflag
from lineitem join orders on l_orderkey = o_orderkey
  join customer on o_custkey = c_custkey join f_entities as e on c_nationkey = e.n"""

FIXTURES["f_order_heads"] = f"""
select e.n, e.global_entity_id, e.country_code, e.region, e.currency_code,
  o_orderkey as okey, 'O' || {s("o_orderkey")} as order_id, o_orderstatus as status,
  cast(o_orderdate as date) as order_date,
  case o_orderkey % 3 when 0 then cast(o_orderdate as timestamp)
    when 1 then cast(o_orderdate as timestamp) + interval '9' hour
    else cast(o_orderdate as timestamp) + interval '20' hour end as order_at,
  o_custkey as ckey, o_custkey % 40 as slot, o_totalprice as total, o_orderpriority as priority
from orders join customer on o_custkey = c_custkey join f_entities as e on c_nationkey = e.n"""

FIXTURES["f_pair"] = f"select distinct n, {ENTITY}, region, pkey from f_sales"
FIXTURES["f_assort"] = f"select distinct n, {ENTITY}, slot, pkey from f_sales"
FIXTURES["f_slots"] = f"select distinct n, {ENTITY}, slot from f_sales"

FIXTURES["f_offer"] = f"""
select n, {ENTITY}, pkey, 'A' as kind, {A_BLOCK} as blk,
  {campaign_id("'A'", A_BLOCK)} as campaign_id from f_pair
union all
select n, {ENTITY}, pkey, 'B' as kind, {B_BLOCK} as blk,
  {campaign_id("'B'", B_BLOCK)} as campaign_id from f_pair"""

FIXTURES["f_campaign_keys"] = f"""
select n, {ENTITY}, kind, blk, campaign_id,
  {campaign_id("kind", "(blk - blk % 3)")} as root_id,
  (blk * 37 + n * 11 + case kind when 'B' then 5 else 0 end) % 2300 as start_offset,
  20 + (blk % 6) * 10 as length
from (select distinct n, {ENTITY}, kind, blk, campaign_id from f_offer) as c"""

# Clean campaign headers.
FIXTURES["f_campaigns"] = f"""
select {ENTITY}, campaign_id, 'Promo ' || kind || {s("blk % 7")} as campaign_name,
  case blk % 4 when 0 then 'Strikethrough' when 1 then 'SameItemBundle' when 2 then 'GroupValue'
    else 'MixAndMatch' end as campaign_type,
  case blk % 4 when 0 then 'Strikethrough %' when 1 then 'Multibuy: Same Item %'
    when 3 then 'Multibuy: Mix & Match %' end as campaign_subtype,
  'ALL' as target_audience, cast(null as string) as target_audience_id,
  'PRODUCTS' as applies_to, 'PERCENTAGE' as discount_type,
  cast(5 + blk % 20 as double) as discount_value,
  cast(100 as bigint) as global_usage_limit, cast(blk % 5 as bigint) as user_usage_limit,
  cast(1000 * (blk % 9) as double) as budget, cast(null as double) as total_trigger_threshold,
  cast(blk % 100 as double) as externally_funded_percentage,
  {at("start_offset - 10")} as created_at_utc, {at("start_offset - 5")} as updated_at_utc,
  {at("start_offset", 6)} as start_at_utc, {at("start_offset + length", 18)} as end_at_utc,
  blk % 8 <> 5 as is_active, '{{"en":"d"}}' as descriptions, '{{"en":"n"}}' as display_names,
  cast(case blk % 2 when 0 then 0 else 3 end as double) as benefit_qty_limit,
  cast(case blk % 3 when 0 then 0 when 1 then 2 end as double) as trigger_qty_threshold,
  cast(null as bigint) as cart_item_usage_limit,
  case blk % 2 when 0 then 'SUPPLIER_FUNDED' else 'CUSTOMER_GROWTH' end as reason,
  case when blk % 41 <> 7 then root_id end as root_id,
  cast(null as timestamp) as deactivated_at_utc,
  {at("start_offset - 12")} as root_creation_at_utc,
  cast(null as double) as fixed_bundle_price, cast(null as string) as experiment_id,
  cast(null as string) as variation_name, 'PORTAL' as creation_source,
  'SUPPLIER' as external_funder, case blk % 25 when 7 then 'DRAFT' else 'READY' end as state,
  blk % 31 <> 5 as is_valid
from f_campaign_keys"""

FIXTURES["f_benefits"] = f"""
select {ENTITY}, campaign_id, {SKU} as sku,
  case when pkey % 4 = 1 then 'ABSOLUTE' end as discount_type,
  case when pkey % 4 = 1 then cast(pkey % 30 as double) end as discount_value,
  cast(pkey % 6 as bigint) as max_qty, cast(pkey % 3 as bigint) as remaining_qty,
  case when pkey % 9 = 0 then null when pkey % 9 = 1 then 'PERCENTAGE' else 'ABSOLUTE' end
    as supplier_funding_type,
  case when pkey % 9 = 0 then null when pkey % 7 = 3 then cast(0 as double)
    else cast(0.25 as double) * (pkey % 8 + 1) end as supplier_funding_value,
  {at("pkey % 300", 0, "1994-01-01")} as created_at_utc,
  {at("pkey % 300", 3, "1994-02-01")} as updated_at_utc,
  pkey % 11 = 3 as is_deleted, 'New benefits' as src, 1 as src_priority
from f_offer"""

FIXTURES["f_triggers"] = f"""
select {ENTITY}, campaign_id, {SKU} as sku, {at("pkey % 300", 0, "1994-01-01")} as created_at_utc,
  {at("pkey % 300", 5, "1994-02-01")} as updated_at_utc, pkey % 13 = 3 as is_deleted,
  'Old triggers' as src, 2 as src_priority
from f_offer where kind = 'A'"""

FIXTURES["f_campaign_slots"] = f"""
select distinct n, {ENTITY}, slot, {campaign_id("'A'", A_BLOCK)} as campaign_id from f_assort
union
select distinct n, {ENTITY}, slot, {campaign_id("'B'", B_BLOCK)} as campaign_id from f_assort"""

FIXTURES["f_campaign_vendors"] = f"""
select {ENTITY}, campaign_id, {GLOBAL_VENDOR} as catalog_global_vendor_id,
  {at("slot", 0, "1994-01-01")} as created_at_utc, {at("slot", 7, "1994-01-01")} as updated_at_utc
from f_campaign_slots"""

# Flat catalog: one row per vendor product; two chains sell the same SKU.
FIXTURES["f_catalog"] = f"""
select {ENTITY}, {SKU} as sku, {s("n")} || '-' || {s("pkey")} || '-' || {s("slot % 2")}
    as catalog_chain_product_id,
  'Product ' || {s("pkey")} as product_name, 'Brand ' || {s("pkey % 40")} as brand_name,
  {at("pkey % 200", 0, "1993-01-01")} as master_product_created_at_utc,
  {at("pkey % 200 + slot % 2", 0, "1993-06-01")} as chain_product_created_at_utc,
  'Cat ' || {s("pkey % 12")} as category_one,
  case when pkey % 5 = 0 then 'Cat X' || {s("pkey % 3")} end as category_two,
  'B' || {s("pkey % 17")} as barcode_one, 'B' || {s("pkey % 19")} as barcode_two,
  {WAREHOUSE} as warehouse_id, 'Store ' || {WAREHOUSE} as warehouse_name,
  {VENDOR} as platform_vendor_id, {GLOBAL_VENDOR} as catalog_global_vendor_id,
  slot % 3 <> 2 or n % 4 <> 0 as is_dark_store, {CATALOG_ID} as global_catalog_id,
  {PLATFORM_ID} as platform_product_id,
  {at("pkey % 400", 0, "1994-09-01")} as vendor_product_created_at_utc,
  case when pkey % 7 = 0 then 'Weighted_step-' || {s("cast(0.25 as double) * (pkey % 4 + 1)")}
    when pkey % 7 = 1 then 'weighted_step-bad' else 'fresh' end as tag_one,
  case when pkey % 14 = 0 then 'weighted_step-2.5' else 'other' end as tag_two
from f_assort"""

# Flat order items of curated orders.
# The offset keeps amounts off exact half cents, which engines round differently.
UNIT_DISCOUNT = "(case when disc > 0 then price * disc + 0.0001237e0 else 0e0 end)"
FIXTURES["f_items"] = f"""
select n, {ENTITY}, currency_code, order_id, order_date as order_created_date_lt,
  {WAREHOUSE} as warehouse_id, {VENDOR} as platform_vendor_id,
  slot % 3 <> 2 or n % 4 <> 0 as is_dark_store, status in ('F', 'O') as is_successful,
  status = 'P' as is_failed, okey % 29 = 0 as is_cancelled, {SKU} as sku,
  case when lno = 7 then cast(0 as double) else qty end as quantity_sold,
  price as unit_price_listed_lc, {UNIT_DISCOUNT} as unit_discount_lc,
  price - {UNIT_DISCOUNT} as unit_price_paid_lc, {UNIT_DISCOUNT} * qty as promo_items_discount_lc,
  (price - {UNIT_DISCOUNT}) * qty as total_amt_paid_lc,
  case when pkey % 5 = 0 then null else cast(0.1 as double) * qty * (pkey % 4) end
    as promo_items_supplier_funded_lc,
  {LINE_CAMPAIGN} as campaign_id, price as product_unit_price_lc,
  {UNIT_DISCOUNT} * qty as campaign_discount_amt_lc,
  cast(0.1 as double) * qty * (pkey % 4) as campaign_supplier_funded_amt_lc
from f_sales"""

FIXTURES["f_suppliers_flat"] = f"""
select distinct {ENTITY}, {SKU} as sku, skey as supplier_id, skey % 13 = 0 as is_supplier_deleted,
  {WAREHOUSE} as warehouse_id, skey % 2 = 0 as is_preferred_supplier from f_sales"""

FIXTURES["f_replenishment"] = f"""
select country_code, {SKU} as sku,
  case when pkey % 4 <> 3 then 'W' || {s("n")} || '-0' end as dc_warehouse_id,
  'W' || {s("n")} || '-1' as warehouse_id from f_pair
union all
select country_code, {SKU} as sku, 'W' || {s("n")} || '-0' as dc_warehouse_id,
  'W' || {s("n")} || '-2' as warehouse_id from f_pair"""

FIXTURES["f_crm"] = f"""
select distinct {ENTITY}, s_name || ' ' || country_code as supplier_name,
  'GS' || {s("s_suppkey")} as global_supplier_id, {s("s_suppkey")} as supplier_id
from f_sales join supplier on skey = s_suppkey"""

FIXTURES["f_master"] = f"""
select distinct {ENTITY}, skey % 50 as supplier_id, 'GS' || {s("skey % 50")} as global_supplier_id,
  'Supplier ' || {s("skey % 50")} as supplier_name, {SKU} as sku,
  'Product ' || {s("pkey")} as product_name, 'Brand ' || {s("pkey % 40")} as brand_name,
  'Cat ' || {s("pkey % 12")} as category_level_one, 'B1,B2' as barcodes,
  {WAREHOUSE} as warehouse_id, {VENDOR} as platform_vendor_id,
  timestamp '1993-01-01 00:00:00' as master_product_created_at_utc
from (select n, {ENTITY}, slot, pkey, min(skey) as skey from f_sales
      group by n, {ENTITY}, slot, pkey) as m"""

# Raw feeds. The new feed knows fulfilled and open orders, the old one open and pending ones.
FEED_ORDER = f"""order_date as created_date, country_code, region, global_entity_id,
  'D' || {s("okey")} as order_id, order_id as platform_order_code, 'cart' || {s("okey")} as cart_id,
  {VENDOR} as vendor_id, priority as target_audience"""
FIXTURES["f_cart_orders"] = f"""
select {FEED_ORDER}, total * cast(0.1 as double) as absolute_discount,
  cast(1 as double) as delivery_absolute_discount, total,
  case when okey % 6 = 0 then null else total * cast(0.9 as double) end as subtotal,
  cast(3 as double) as delivery_fee, cast(2 as double) as delivery_total,
  cast(10 as double) as minimum_order_value, order_at as created_at,
  order_at + interval '2' hour as modified_at, 'NEW' as status,
  '{{"client_id":"c' || {s("ckey")} || '","session_id":"s' || {s("okey % 99")} || '"}}' as client_info
from f_order_heads where status in ('F', 'O')"""
FIXTURES["f_app_orders"] = f"""
select {FEED_ORDER}, total * cast(0.2 as double) as absolute_discount,
  cast(2 as double) as delivery_absolute_discount, total,
  total * cast(0.8 as double) as subtotal, cast(4 as double) as delivery_fee,
  cast(3 as double) as delivery_total, cast(11 as double) as minimum_order_value,
  case ckey % 3 when 0 then order_at when 1 then order_at - interval '24' hour
    else order_at + interval '24' hour end as created_at,
  order_at + interval '3' hour as modified_at, 'OLD' as status
from f_order_heads where status in ('O', 'P')"""

FEED_ITEM = f"""order_date as created_date, {ENTITY}, 'D' || {s("okey")} as order_id"""
APP_CREATED = """case ckey % 3 when 0 then order_at when 1 then order_at - interval '24' hour
    else order_at + interval '24' hour end as created_at"""
FIXTURES["f_cart_items"] = f"""
select {FEED_ITEM}, 'I' || {s("okey")} || '-' || {s("lno")} as order_item_id,
  {CATALOG_ID} as product_id,
  case when lno % 3 = 0 then 'combo' || {s("lno")} end as parent_product_id, qty, price,
  price * disc * qty as absolute_discount, price * (1 - disc) * qty as total,
  price * qty as subtotal, cast(lno % 2 as double) as free_qty,
  price * (1 - disc) as distributed_discounted_price, cast(lno as double) as weight,
  order_at as created_at, order_at + interval '2' hour as modified_at,
  {PLATFORM_ID} as platform_product_id
from f_sales where status in ('F', 'O')"""
FIXTURES["f_app_items"] = f"""
select {FEED_ITEM}, {CATALOG_ID} as product_id, qty, price,
  cast(0 as double) as absolute_discount, price * qty as total, price * qty as subtotal,
  cast(0 as double) as free_qty, {APP_CREATED}, order_at + interval '3' hour as modified_at
from f_sales where status in ('O', 'P')"""
FIXTURES["f_cart_campaigns"] = f"""
select {FEED_ITEM}, {LINE_CAMPAIGN} as campaign_id, {CATALOG_ID} as product_id,
  case when lno % 3 = 0 then 'combo' || {s("lno")} end as parent_product_id,
  price * disc * qty as discount, cast(1 + lno % 2 as bigint) as applied_times,
  case when lno % 4 = 0 then null else cast(0.1 as double) * qty end as supplier_funded_amount,
  cast(1 as double) as benefit_qty, cast(2 as double) as trigger_qty, lno % 2 = 0 as ds_synced,
  'SUPPLIER' as external_funder, order_at as created_at,
  order_at + interval '2' hour as modified_at
from f_sales where status in ('F', 'O') and {LINE_CAMPAIGN} is not null"""
FIXTURES["f_app_campaigns"] = f"""
select {FEED_ITEM}, {LINE_CAMPAIGN} as campaign_id, {CATALOG_ID} as product_id,
  price * disc as discount, cast(1 as bigint) as applied_times, {APP_CREATED},
  order_at + interval '3' hour as modified_at
from f_sales where status in ('O', 'P') and {LINE_CAMPAIGN} is not null"""

RAW_TYPE = """case blk % 7 when 0 then 'Strikethrough' when 1 then 'SameItemBundle'
    when 2 then 'MixAndMatch' when 3 then 'BasketValue' when 4 then 'GENERIC'
    when 5 then 'OldFashioned Campaign Type' else 'GroupValue' end as type,
  case blk % 5 when 0 then 'RETURNING' when 1 then 'ALL' when 2 then 'seg-77' when 3 then null
    else 'NEW_USER' end as target_audience,
  case (blk + n) % 4 when 0 then 'PRODUCTS' when 1 then 'CHEAPEST_PRODUCTS'
    when 2 then 'DELIVERY_FEE' else 'BASKET' end as applies_to"""
RAW_DISCOUNT = f"""'{{"type":"' || case (blk + edit) % 3 when 0 then 'ABSOLUTE' else 'PERCENTAGE' end
    || '","value":' || case when blk % 17 = 0 then '"abc"' when blk % 3 = 0 then '100'
    else {s("blk % 90")} end || '}}' as discount"""
# Every raw row exists in an earlier and a later edit.
FIXTURES["f_edits"] = """
select n, 0 as edit from f_entities union all select n, 1 as edit from f_entities"""
FIXTURES["f_campaigns_raw"] = f"""
select {ENTITY}, campaign_id as global_id, 'Raw ' || {s("edit")} as name, {RAW_TYPE},
  {RAW_DISCOUNT}, cast(10 as bigint) as global_usage_limit, cast(2 as bigint) as user_usage_limit,
  cast(blk as double) as budget, cast(null as double) as total_trigger_threshold,
  cast(50 as double) as externally_funded_percentage,
  {at("start_offset - 20 + edit")} as creation_date,
  case when blk % 4 = 0 then {at("start_offset - 3")} else {at("start_offset + 3")} end
    as updated_date,
  {at("start_offset", 6)} as start_time, {at("start_offset + length", 18)} as end_time,
  case blk % 6 when 0 then null when 1 then true else false end as active,
  '{{"en":"x"}}' as description, '{{"en":"y"}}' as display_name,
  cast(3 as double) as benefit_qty_limit, cast(2 as double) as trigger_qty_threshold,
  cast(1 as bigint) as cart_item_usage_limit, 'SUPPLIER_FUNDED' as reason, root_id,
  cast(null as timestamp) as deactivated_at, {at("start_offset - 20")} as root_creation_date,
  cast(null as double) as fixed_bundle_price, cast(null as string) as experiment_id,
  cast(null as string) as variation_name, 'PORTAL' as creation_source,
  'SUPPLIER' as external_funder, 'READY' as state
from f_campaign_keys join f_edits using (n)"""

RAW_BENEFIT = f"""{ENTITY}, campaign_id, {SKU} as sku, 'PERCENTAGE' as discount_type"""
FIXTURES["f_benefits_new_raw"] = f"""
select {RAW_BENEFIT}, cast(pkey % 30 + edit as double) as discount, cast(5 as bigint) as max_qty,
  cast(pkey % 4 as bigint) as remaining_qty, 'ABSOLUTE' as supplier_fund_type,
  cast(0.5 as double) * (pkey % 8) as supplier_fund_value,
  {at("pkey % 300", 0, "1994-01-01")} as created_at,
  {at("pkey % 300 + edit", 0, "1994-02-01")} as modified_at, edit = 1 as is_deleted
from f_offer join f_edits using (n) where kind = 'B'"""
FIXTURES["f_benefits_old_raw"] = f"""
select {RAW_BENEFIT}, cast(pkey % 20 + edit as double) as discount, cast(9 as bigint) as max_qty,
  cast(1 as bigint) as remaining_qty, 'PERCENTAGE' as supplier_fund_type,
  cast(0.25 as double) * (pkey % 8) as supplier_fund_value,
  case when pkey % 3 = 0 then null else {at("pkey % 300", 0, "1992-01-01")} end as created_at,
  {at("pkey % 300 - edit", 0, "1992-02-01")} as modified_at, false as is_deleted
from f_offer join f_edits using (n)"""
FIXTURES["f_triggers_old_raw"] = f"""
select {ENTITY}, {campaign_id("'A'", A_BLOCK)} as campaign_id,
  case when pkey % 13 <> 0 then {SKU} end as sku, {CATALOG_ID} as product_id,
  {VENDOR} as vendor_id, {at("pkey % 300", 0, "1994-01-01")} as created_at,
  {at("pkey % 300 + edit + slot % 2", 0, "1994-02-01")} as modified_at, pkey % 11 = 1 as is_deleted
from f_assort join f_edits using (n)"""
FIXTURES["f_triggers_new"] = f"""
select {ENTITY}, campaign_id, {SKU} as sku, {at("pkey % 300", 0, "1994-03-01")} as created_at_utc,
  {at("pkey % 300", 2, "1994-04-01")} as updated_at_utc, false as is_deleted
from f_offer where kind = 'B' or global_entity_id not like 'TB%'"""
FIXTURES["f_triggers_old"] = f"""
select distinct {ENTITY}, {campaign_id("'A'", A_BLOCK)} as campaign_id, {SKU} as sku,
  {at("pkey % 300", 0, "1994-01-01")} as created_at_utc,
  {at("pkey % 300 + slot % 2", 0, "1994-02-01")} as updated_at_utc, pkey % 11 = 1 as is_deleted
from f_assort"""
FIXTURES["f_campaign_vendors_raw"] = f"""
select {ENTITY}, campaign_id, {GLOBAL_VENDOR} as vendor_id,
  {at("slot", 0, "1994-01-01")} as creation_date,
  case when slot % 3 = 0 then null else {at("slot + edit", 0, "1994-05-01")} end as updated_date
from f_campaign_slots join f_edits using (n)"""
FIXTURES["f_vendors_raw"] = f"""
select country_code, case slot when 39 then 'TEST_VA' else global_entity_id end as global_entity_id,
  {GLOBAL_VENDOR} as vendor_id, 'code' || {s("slot")} || {s("edit")} as vendor_code,
  'Vendor ' || {s("slot")} as name, {at("slot", 0, "1990-01-01")} as created_at,
  {at("slot + edit", 0, "1991-01-01")} as modified_at, cast(null as timestamp) as deleted_at,
  {at("slot + edit", 0, "1992-01-01")} as synchronised_at
from f_slots join f_edits using (n)"""
FIXTURES["f_external"] = f"""
select {ENTITY}, order_id, {SKU} as sku, order_at as order_fulfilled_at,
  {LINE_CAMPAIGN} as campaign_id, max(cast(0.3 as double) * qty) as amount
from f_sales where rflag = 'R' and {LINE_CAMPAIGN} is not null
group by {ENTITY}, order_id, pkey, n, order_at"""

# Dimensions and histories.
FIXTURES["f_vendor_places"] = f"""
select {ENTITY}, slot, n, {WAREHOUSE} as warehouse_id, 'Store ' || {WAREHOUSE} as name,
  slot % 3 <> 2 or n % 4 <> 0 as is_dark_store, n % 2 = 0 as uses_new_locations,
  case when slot % 4 <> 1 then {VENDOR} end as platform_vendor_id,
  {VENDOR} as additional_platform_vendor_id, cast(null as timestamp) as migrated_at_utc
from f_slots
union all
select {ENTITY}, slot, n, 'W' || {s("n")} || '-' || {s("(slot + 1) % 3")} as warehouse_id,
  'Store ' || 'W' || {s("n")} || '-' || {s("(slot + 1) % 3")} as name,
  (slot + 1) % 3 <> 2 or n % 4 <> 0 as is_dark_store, n % 2 = 0 as uses_new_locations,
  {VENDOR} as platform_vendor_id, cast(null as string) as additional_platform_vendor_id,
  {at("slot * 20", 0, "1996-01-01")} as migrated_at_utc
from f_slots
union all
select {ENTITY}, slot, n, 'W' || {s("n")} || '-' || {s("(slot + 2) % 3")} as warehouse_id,
  'Store ' || 'W' || {s("n")} || '-' || {s("(slot + 2) % 3")} as name,
  (slot + 2) % 3 <> 2 or n % 4 <> 0 as is_dark_store, n % 2 = 0 as uses_new_locations,
  {VENDOR} as platform_vendor_id, cast(null as string) as additional_platform_vendor_id,
  {at("slot * 20", 0, "1999-01-01")} as migrated_at_utc
from f_slots"""
FIXTURES["f_vendor_verticals"] = f"""
select global_entity_id, {VENDOR} as platform_vendor_id, 'darkstores' as vertical_type,
  'Q' || {s("slot % 3")} as vertical_parent from f_slots"""


def versions(table: str, columns: str, value: str, out: str, cuts: tuple[str, ...]) -> str:
    """Consecutive half-open versions with the given cut dates, first from 1994, last open."""
    bounds = ["timestamp '1994-01-01 00:00:00'", *cuts, "timestamp '2030-01-01 00:00:00'"]
    return "\nunion all\n".join(
        f"select {columns}, {value.format(v=v)} as {out}, {bounds[v]} as valid_from_utc,"
        f" {bounds[v + 1]} as valid_to_utc, {bounds[v]} as valid_from_lt from {table}"
        for v in range(len(bounds) - 1)
    )


FIXTURES["f_price_history"] = f"""
select * from (
{versions("f_pair", f"global_entity_id, {CATALOG_ID} as global_catalog_id",
          "cast(1000 + pkey % 500 as double) * (1 + cast(0.5 as double) * {v})",
          "original_price_lc", (at("pkey % 500"), at("pkey % 500 + 700")))}
) as p"""
FIXTURES["f_wac"] = f"""
select global_entity_id, warehouse_id, sku, valid_from_utc as valid_from, valid_to_utc as valid_to,
  wac from (
{versions("(select distinct n, global_entity_id, slot % 3 as slot, pkey from f_assort) as a",
          f"global_entity_id, {WAREHOUSE} as warehouse_id, {SKU} as sku",
          "cast(300 + pkey % 200 as double) + 10 * {v}", "wac", (at("pkey % 900"),))}
) as w"""
FIXTURES["f_buffer_history"] = f"""
select *, 'src' || {s("cast(sales_buffer as bigint) % 3")} as src from (
{versions("f_pair", f"global_entity_id, {CATALOG_ID} as global_catalog_id",
          "cast(pkey % 10 + {v} as double)", "sales_buffer", (at("pkey % 800"),))}
) as b"""
FIXTURES["f_sku_history"] = f"""
{versions("(select distinct n, global_entity_id, slot, pkey from f_assort) as a",
          f"global_entity_id, {VENDOR} as platform_vendor_id,"
          f" {PLATFORM_ID} as platform_product_id, {CATALOG_ID} as global_catalog_id",
          f"'S' || {s('pkey')} || case {{v}} when 0 then 'old' else '' end", "sku",
          (at("pkey % 1200"),))}"""
FIXTURES["f_vat_events"] = f"""
select global_entity_id, 'any' as vendor_id, {CATALOG_ID} as global_catalog_id,
  {at("pkey % 100", 0, "1994-01-01")} as timestamp_valid_from, {s("pkey % 20 + 5")} as vat_rate,
  false as current_flag from f_pair
union all
select global_entity_id, 'any' as vendor_id, {CATALOG_ID} as global_catalog_id,
  {at("pkey % 900", 0, "1995-06-01")} as timestamp_valid_from, {s("pkey % 20 + 6")} as vat_rate,
  false as current_flag from f_pair
union all
select global_entity_id, 'any' as vendor_id, {CATALOG_ID} as global_catalog_id,
  {at("pkey % 900", 0, "1998-06-01")} as timestamp_valid_from, {s("pkey % 20 + 7")} as vat_rate,
  true as current_flag from f_pair"""


def attribute(field: str, first: str, second: str, third: str) -> str:
    shared = f"global_entity_id, {CATALOG_ID} as global_catalog_id, '{field}' as updated_field"
    cut = at("pkey % 600", 12, "1996-01-01")
    same_day = at("pkey % 600", 8, "1996-01-01")
    rows = (
        (first, "timestamp '1994-01-01 00:00:00'", cut),
        (second, cut, "timestamp '2030-01-01 00:00:00'"),
        (third, same_day, "timestamp '2030-01-01 00:00:00'"),
    )
    return "\nunion all\n".join(
        f"select {shared}, {value} as updated_value, {low} as valid_from_utc,"
        f" {high} as valid_to_utc, {low} as valid_from_lt from f_pair"
        for value, low, high in rows
    )


FIXTURES["f_attribute_log"] = "\nunion all\n".join(
    [
        attribute("minimum_starting_weight", "'0.5'", s("pkey % 9"), "'77'"),
        attribute(
            "sold_by_weight",
            "case when pkey % 3 = 0 then 'true' else 'false' end",
            "case when pkey % 4 = 0 then 'true' else 'false' end",
            "'true'",
        ),
        attribute("sold_by_piece", "'false'", "case when pkey % 6 = 0 then 'true' else 'false' end", "'true'"),
        attribute("average_weight_per_piece", "'0.125'", "case when pkey % 5 = 0 then 'heavy' else '2.5' end", "'9'"),
        attribute("average_weight_per_piece_unit", "'KG'", "'KG'", "'KG'"),
    ]
)

FIXTURES["f_fx"] = """
select distinct order_date as exchange_rate_date, country_code, currency_code,
  cast(1 as double) + cast(n as double) / 10 as exchange_rate_value
from f_order_heads where status in ('F', 'O')"""

# Raw order lines; some identifiers are missing and must be resolved.
FIXTURES["f_lines_raw"] = f"""
select 'web' as origin, order_date as order_created_date_utc, order_at as order_created_at_utc,
  global_entity_id, global_entity_id as fulfilled_by_entity, order_id,
  case when lno <> 6 then {CATALOG_ID} end as global_catalog_id,
  case when lno <> 5 then {PLATFORM_ID} end as platform_product_id,
  'PK' || {s("okey")} || '-' || {s("lno")} as picking_order_item_id,
  case when lno > 2 then {SKU} end as sku,
  case when lno = 4 then 'I' || {s("okey")} || '-' || {s("lno")} end as promo_order_item_id,
  cast(null as string) as replacement_picking_order_item_id, {VENDOR} as platform_vendor_id,
  currency_code, 'UNIT' as pricing_type, tax * 100 as vat_percentage, false as is_custom,
  status as order_status, true as is_checkout_confirmed, order_at as order_updated_at_utc,
  'PICKED' as picking_order_item_status, cast(null as string) as pickup_issue,
  false as is_modified_quantity, false as is_modified_price, cast(1 as double) as min_quantity,
  cast(99 as double) as max_quantity, qty as quantity_ordered, qty as quantity_picked_up,
  case when lno = 3 then null else qty end as quantity_delivered,
  case when rflag = 'R' then cast(1 as double) end as quantity_returned,
  qty - case when rflag = 'R' then 1 else 0 end as quantity_sold,
  cast(null as double) as weighted_pieces_ordered, cast(null as double) as weighted_pieces_picked_up,
  price as unit_price_lc, price * (1 - disc) as unit_price_paid_lc,
  price * (1 - disc) * qty as total_amt_paid_lc, cast(null as string) as parent_order_id
from f_sales"""

# Campaign facts per order line, by catalog id or, for some lines, only by platform id.
FIXTURES["f_line_campaigns"] = f"""
select {ENTITY}, order_id, max(order_date) as order_created_date_utc,
  case when pkey % 4 <> 0 then {CATALOG_ID} else 'unknown' end as global_catalog_id,
  {PLATFORM_ID} as platform_product_id,
  case when lno = 4 then 'I' || {s("okey")} || '-' || {s("lno")} end as promo_order_item_id,
  sum(price * disc * qty) as promo_items_discount_lc,
  sum(price * disc * qty) / 2 as promo_items_discount_eur,
  sum(cast(0.1 as double) * qty) as promo_items_supplier_funded_lc,
  sum(cast(0.1 as double) * qty) / 2 as promo_items_supplier_funded_eur,
  sum(cast(0.2 as double) * qty) as order_items_supplier_funded_lc,
  sum(cast(0.2 as double) * qty) / 2 as order_items_supplier_funded_eur,
  max({LINE_CAMPAIGN}) as some_campaign_id
from f_sales where {LINE_CAMPAIGN} is not null
group by {ENTITY}, order_id, pkey, n, slot, okey, lno"""

PROMO_HEAD = f"""order_date as created_date, order_at as created_at_utc, region,
  global_entity_id, country_code, order_id, okey, cast(1 as double) + cast(n as double) / 10
    as exchange_rate_value,
  {CATALOG_ID} as product_id, {PLATFORM_ID} as platform_product_id,
  'I' || {s("okey")} || '-' || {s("lno")} as promo_order_item_id,
  case when lno % 3 = 0 then 'combo' || {s("lno")} end as parent_product_id, lno,
  qty as product_qty, price as product_unit_price, price * qty as subtotal,
  price * (1 - disc) * qty as total, price * disc * qty as absolute_discount_lc,
  price * (1 - disc) as distributed_discounted_price"""
# Products of promo orders, one row per campaign of the product (or one without campaign).
FIXTURES["f_promo_flat"] = f"""
select {PROMO_HEAD}, {LINE_CAMPAIGN} as campaign_id, price * disc as discount_lc,
  case when lno % 4 <> 0 and {LINE_CAMPAIGN} is not null then cast(0.1 as double) * qty end
    as supplier_funded_amount,
  cast(2 as double) as trigger_qty, cast(1 as double) as benefit_qty
from f_sales
union all
select {PROMO_HEAD}, 'X' || {s("pkey % 10")} as campaign_id, price * disc / 2 as discount_lc,
  cast(0.2 as double) * qty as supplier_funded_amount, cast(3 as double) as trigger_qty,
  cast(2 as double) as benefit_qty
from f_sales where rflag = 'A' and {LINE_CAMPAIGN} is not null"""

FIXTURES["f_vendor_products"] = f"""
select {ENTITY}, {s("n")} || '-' || {s("pkey")} || '-' || {s("slot % 2")}
    as catalog_chain_product_id,
  'VP' || {s("n")} || '-' || {s("pkey")} || '-' || {s("slot")} as catalog_vendor_product_id,
  {GLOBAL_VENDOR} as catalog_vendor_id, {PLATFORM_ID} as platform_product_id,
  {CATALOG_ID} as global_catalog_id,
  {at("pkey % 400", 0, "1994-09-01")} as vendor_product_created_at_utc,
  true as vendor_product_is_active, 'OK' as status, cast(pkey as double) as catalog_price_lc,
  case pkey % 5 when 0 then null when 1 then true else false end as has_own_brand_category,
  {GLOBAL_VENDOR} as catalog_global_vendor_id, {VENDOR} as platform_vendor_id,
  case pkey % 3 when 0 then 'SHOP' else 'WAREHOUSE' end as type,
  case when pkey % 2 = 0 then cast(pkey % 6 as double) end as sales_buffer,
  'client' as created_by_client, 'component' || {s("pkey % 2")} as created_by_component
from f_assort"""
FIXTURES["f_chain_products"] = f"""
select distinct {ENTITY}, {s("n")} || '-' || {s("pkey")} || '-' || {s("slot % 2")}
    as catalog_chain_product_id, 'chain' || {s("slot % 2")} as catalog_chain_id,
  {SKU} as sku, p_name as product_name,
  case when pkey % 3 = 0 then null else p_name end as product_description_english,
  'lokal ' || p_name as product_description_local,
  case pkey % 4 when 0 then 'EveryDay' when 1 then null else p_brand end as brand_name_english,
  'lokal ' || p_brand as brand_name_local,
  case pkey % 6 when 0 then null when 1 then true else false end as is_own_brand
from f_assort join part on pkey = p_partkey"""
FIXTURES["f_sources"] = f"""
select distinct global_entity_id, 'chain' || {s("slot % 2")} as chain_id
from f_slots where global_entity_id not like 'TB%'"""
FIXTURES["f_locations"] = f"""
select distinct 'W' || {s("n")} || '-' || {s("slot % 3")} as warehouse_id,
  {CATALOG_ID} as catalog_product_id, 'R' || {s("pkey % 9")} as row, 'K' as rack,
  'H' || {s("pkey % 5")} as shelf, 'AMBIENT' as storage_type,
  'NONE' as location_movement_request_strategy
from f_assort"""
FIXTURES["f_ranks"] = f"""
select global_entity_id, order_id, cast(okey % 9 as bigint) as customer_qc_order_rank,
  okey % 9 = 0 as is_acquisition_qcommerce, okey % 18 = 0 as is_acquisition_darkstore,
  cast(null as boolean) as is_acquisition_localshop,
  cast(date_trunc('month', order_date) as date) as partition_month_local
from f_order_heads where status in ('F', 'P')"""

_NAME = re.compile(r"\bf_[a-z_]+\b")


def direct_inputs(sql: str) -> list[str]:
    return sorted({name for name in _NAME.findall(sql) if name in FIXTURES})


def needed(sql: str) -> list[str]:
    """Fixture tables a text refers to, dependencies first."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in FIXTURES and name not in ordered:
                visit(FIXTURES[name])
                if name not in ordered:
                    ordered.append(name)

    visit(sql)
    return ordered


def with_fixtures(sql: str) -> str:
    """The text with the tables it needs as common table expressions in front."""
    names = needed(sql)
    if not names:
        return sql
    ctes = ",\n".join(f"{name} as ({FIXTURES[name]})" for name in names)
    body = sql.strip()
    if body[:5].lower() == "with ":
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
