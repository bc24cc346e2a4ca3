"""Funding of concluded campaigns, rule-driven funding, and billing."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import functions as F

from fundspark.functions.money import funding_amount
from fundspark.functions.sql import register_all
from fundspark.operators.lineage import materialise
from fundspark.operators.campaigns import campaign_version_rollup, campaign_versions_flat
from fundspark.operators.nested import unfold
from fundspark.operators.quality import run_metrics
from fundspark.operators.rules import country_rules
from fundspark.plans import billing as bill
from fundspark.plans import funding_v1 as v1
from fundspark.plans import funding_v2 as v2
from fundspark.sources.bucketed import write_bucketed
from suite.campaigns import ELIGIBLE_SQL, FLAT_SQL, ROLLUP_PLAIN, ROLLUP_SQL, ROLLUP_TIMES, eligible
from suite.model import FULL, MONTHLY, QUERIES, Inputs, near, register, rounded, sql_near, sql_rounded, text

# --- concluded campaigns --------------------------------------------------------------------------

LINES_SQL = f"""
with {ELIGIBLE_SQL}, source as (select * from eligible), {ROLLUP_SQL}, {FLAT_SQL},
v1_lines as (
  select cast(f.campaign_end_at_utc as date) as campaign_concluded_date_utc,
    i.order_created_date_lt, i.global_entity_id, i.country_code, i.currency_code,
    i.warehouse_id, i.platform_vendor_id, i.campaign_id, f.root_id, i.sku, i.quantity_sold,
    i.unit_price_listed_lc, i.unit_discount_lc, i.unit_price_paid_lc,
    i.promo_items_discount_lc as total_discount_lc, i.total_amt_paid_lc,
    i.campaign_discount_amt_lc,
    coalesce(if(f.campaign_type = 'GroupValue', i.promo_items_discount_lc,
      i.promo_items_supplier_funded_lc), 0) as supplier_funded_amount_lc
  from f_items as i join flat as f using (global_entity_id, campaign_id)
  where i.is_dark_store and i.is_successful and not i.is_failed and not i.is_cancelled
    and i.quantity_sold > 0 and i.order_created_date_lt >= date '1996-10-27'
    and cast(f.campaign_end_at_utc as date) between date '1998-04-27' and date '1998-05-31'
    and i.warehouse_id not in ('W2-1') and i.platform_vendor_id not in ('V4-7'))"""
LINE_PLAIN = [
    "campaign_concluded_date_utc", "order_created_date_lt", "global_entity_id", "country_code",
    "currency_code", "warehouse_id", "campaign_id", "root_id", "sku", "quantity_sold",
]
LINE_AMOUNTS = [
    "unit_price_listed_lc", "unit_discount_lc", "unit_price_paid_lc", "total_discount_lc",
    "total_amt_paid_lc", "campaign_discount_amt_lc", "supplier_funded_amount_lc",
]


def rollup(x: Inputs):
    return campaign_version_rollup(eligible(x), MONTHLY)


def v1_lines(x: Inputs):
    return v1.funded_order_lines(x.orders, campaign_versions_flat(rollup(x)), x.entities, MONTHLY)


@register(
    "funded_order_lines",
    f"""{LINES_SQL} select {", ".join(LINE_PLAIN)}, platform_vendor_id,
    {sql_rounded(*LINE_AMOUNTS)} from v1_lines""",
)
def _(x):
    return v1_lines(x).select(*LINE_PLAIN, "platform_vendor_id", *rounded(*LINE_AMOUNTS))


PRODUCT = [
    "supplier_id", "global_supplier_id", "supplier_name", "product_name", "brand_name",
    "category_level_one", "barcodes",
]
ENRICHED_SQL = f"""{LINES_SQL},
enriched as (
  select l.*, {", ".join("m." + c for c in PRODUCT)} from v1_lines as l
    left join f_master as m on m.global_entity_id = l.global_entity_id
      and m.country_code = l.country_code and m.warehouse_id = l.warehouse_id
      and m.sku = l.sku and m.platform_vendor_id = l.platform_vendor_id
  where l.supplier_funded_amount_lc > 0)"""


def enriched(x: Inputs):
    return v1.funded_lines_enriched(v1_lines(x), x("f_master"))


@register(
    "funded_lines_enriched",
    f"{ENRICHED_SQL} select {', '.join(LINE_PLAIN + PRODUCT)}, {sql_rounded(*LINE_AMOUNTS)}"
    " from enriched",
)
def _(x):
    return enriched(x).select(*LINE_PLAIN, *PRODUCT, *rounded(*LINE_AMOUNTS))


AVERAGES = ["unit_price_listed_lc", "unit_discount_lc", "unit_price_paid_lc"]
TOTALS = ["quantity_sold", "total_discount_lc", "total_amt_paid_lc", "supplier_funded_amount_lc"]
SKU_SQL = f"""{ENRICHED_SQL},
sku_rows as (
  select {", ".join(v1.SKU_GROUP)}, {", ".join(f"avg({c}) as avg_{c}" for c in AVERAGES)},
    {", ".join(f"sum({c}) as {c}" for c in TOTALS)}
  from enriched group by {", ".join(v1.SKU_GROUP)})"""
SKU_AMOUNTS = [*[f"avg_{c}" for c in AVERAGES], *TOTALS]


@register(
    "sku_supplier_funding",
    f"{SKU_SQL} select {', '.join(v1.SKU_GROUP)}, {sql_rounded(*SKU_AMOUNTS)} from sku_rows",
)
def _(x):
    rows = v1.sku_supplier_funding(enriched(x), MONTHLY)
    return rows.select(*v1.SKU_GROUP, *rounded(*SKU_AMOUNTS))


@register(
    "supplier_statement",
    f"""{SKU_SQL},
    roots as (select {", ".join(ROLLUP_PLAIN + ROLLUP_TIMES)},
        count(*) filter (where version_id <> root_id) as child_count
      from headed group by {", ".join(ROLLUP_PLAIN + ROLLUP_TIMES)})
    select {", ".join("s." + c for c in v1.SUPPLIER)}, s.root_id,
      date '1998-04-27' as campaign_concluded_week_utc, r.campaign_name, r.campaign_subtype,
      cast(r.campaign_end_at_utc as string) as campaign_end_at_utc, r.child_count, s.sku,
      s.product_name, {sql_near("s.supplier_funded_amount_lc")} as supplier_funded_amount_lc,
      {sql_near("s.supplier_funded_amount_lc / nullif(s.quantity_sold, 0)")}
        as unit_supplier_funded_amount_lc
    from sku_rows as s join roots as r on r.global_entity_id = s.global_entity_id
      and r.country_code = s.country_code and r.root_id = s.root_id""",
)
def _(x):
    campaigns = rollup(x)
    lines = v1.funded_order_lines(
        x.orders, campaign_versions_flat(campaigns), x.entities, MONTHLY
    )
    sku_rows = v1.sku_supplier_funding(
        v1.funded_lines_enriched(lines, x("f_master")), MONTHLY
    )
    statements = v1.supplier_statement(sku_rows, campaigns, MONTHLY)
    head = [*v1.SUPPLIER, "campaign_concluded_week_utc"]
    per_campaign = unfold(statements, "campaigns", head)
    flat = per_campaign.select(
        *head,
        "root_id",
        "campaign_name",
        "campaign_subtype",
        *text("campaign_end_at_utc"),
        F.size("child_campaigns").cast("bigint").alias("child_count"),
        F.explode("skus").alias("s"),
    )
    return flat.select(
        *[c for c in flat.columns if c != "s"],
        "s.sku",
        "s.product_name",
        near(F.col("s.supplier_funded_amount_lc")).alias("supplier_funded_amount_lc"),
        near(F.col("s.unit_supplier_funded_amount_lc")).alias("unit_supplier_funded_amount_lc"),
    )


# --- rule-driven funding --------------------------------------------------------------------------


class Run:
    """The steps of one run over the derived tables, each built once."""

    def __init__(self, x: Inputs):
        self.x = x

    @cached_property
    def rules(self):
        return country_rules(self.x("f_rules"))

    @cached_property
    def utilised(self):
        x = self.x
        return v2.campaigns_utilised(
            x("f_campaigns"), x("f_benefits"), x.catalog, self.rules, FULL
        )

    @cached_property
    def contracts(self):
        return v2.funding_rules(self.utilised, self.x("f_benefits"), self.rules)

    @cached_property
    def warehouses(self):
        x = self.x
        return v2.campaign_warehouses(x("f_campaign_vendors"), x.catalog, x("f_campaigns"))

    @cached_property
    def lines(self):
        return v2.order_lines_for_funding(self.x.orders, self.rules, FULL)

    @cached_property
    def dense(self):
        return v2.dense_skus(self.x("f_benefits"))

    @cached_property
    def matched(self):
        placed = v2.placed_contracts(self.contracts, self.warehouses)
        return v2.match_funding(self.lines, placed, self.rules, FULL, self.dense)

    @cached_property
    def resolved(self):
        return v2.resolve_overlaps(self.matched)

    @cached_property
    def funding(self):
        return v2.order_funding(self.resolved, self.x("f_master"), self.x("f_campaigns"))

    @cached_property
    def billing(self):
        return bill.billing(self.funding, self.rules, FULL)


UTILISED_SQL = """
with active as (select * from f_rules where is_active),
placed as (select * from f_catalog where is_dark_store and warehouse_id <> ''),
utilised as (
  select c.* from f_campaigns as c join active as a using (global_entity_id)
  where c.state = 'READY' and c.is_valid and c.start_at_utc <= timestamp '2001-12-31 00:00:00'
    and c.end_at_utc >= timestamp '1995-01-01 00:00:00'
    and exists (select 1 from f_benefits as b join placed as p on p.sku = b.sku
      where b.country_code = c.country_code and b.campaign_id = c.campaign_id
        and p.global_entity_id = c.global_entity_id))"""
UTILISED_PLAIN = [c for c in v2.UTILISED if not c.endswith("_at_utc")]


@register(
    "campaigns_utilised",
    f"{UTILISED_SQL} select {', '.join('u.' + c for c in UTILISED_PLAIN)},"
    " cast(u.start_at_utc as string) as start_at_utc,"
    " cast(u.end_at_utc as string) as end_at_utc from utilised as u",
)
def _(x):
    return Run(x).utilised.select(*UTILISED_PLAIN, *text("start_at_utc", "end_at_utc"))


CONTRACTS_SQL = f"""{UTILISED_SQL},
contracts as (
  select u.global_entity_id, u.country_code, u.campaign_id, u.campaign_type, b.sku,
    b.supplier_funding_type, b.supplier_funding_value,
    case when b.supplier_funding_value = 0 then 'explicit_zero'
      when b.supplier_funding_value > 0 and b.supplier_funding_type is not null then 'configured'
      else 'missing' end as contract_status,
    case when b.supplier_funding_value = 0 then 0
      when b.supplier_funding_value > 0 and b.supplier_funding_type = 'ABSOLUTE'
        then b.supplier_funding_value end as funding_unit_value,
    coalesce(b.discount_type, u.discount_type) as discount_type_resolved,
    coalesce(b.discount_value, u.discount_value) as discount_value_resolved,
    u.trigger_qty_threshold, u.benefit_qty_limit, cast(u.start_at_utc as date) as first_day,
    cast(u.end_at_utc as date) as campaign_end_date
  from utilised as u join f_benefits as b on b.country_code = u.country_code
    and b.campaign_id = u.campaign_id
  where b.sku is not null and not b.is_deleted)"""
CONTRACT_OUT = [
    "global_entity_id", "country_code", "campaign_id", "campaign_type", "sku",
    "supplier_funding_type", "supplier_funding_value", "contract_status", "funding_unit_value",
    "discount_type_resolved", "discount_value_resolved", "trigger_qty_threshold",
    "benefit_qty_limit",
]


@register("funding_rules", f"{CONTRACTS_SQL} select {', '.join(CONTRACT_OUT)} from contracts")
def _(x):
    return Run(x).contracts.select(*CONTRACT_OUT)


STORES_SQL = f"""{CONTRACTS_SQL},
stores as (
  select distinct v.country_code, v.campaign_id, v.catalog_global_vendor_id, p.warehouse_id,
    p.warehouse_name
  from f_campaign_vendors as v
    join f_campaigns as c on c.country_code = v.country_code and c.campaign_id = v.campaign_id
    join placed as p on p.global_entity_id = c.global_entity_id
      and p.catalog_global_vendor_id = v.catalog_global_vendor_id)"""
GRID_GROUP = ["global_entity_id", "campaign_id", "warehouse_id", "contract_status"]


@register(
    "daily_grid",
    f"""{STORES_SQL}
    select {", ".join("g." + c for c in GRID_GROUP)}, count(*) as row_count,
      count(distinct g.order_date) as day_count, min(g.order_date) as first_day,
      max(g.order_date) as last_day,
      {sql_near("sum(coalesce(g.funding_unit_value, 0))")} as unit_value_sum
    from (select c.*, s.warehouse_id, cast(unnest(generate_series(c.first_day,
          c.campaign_end_date, interval 1 day)) as date) as order_date
        from contracts as c join stores as s using (country_code, campaign_id)) as g
    group by all""",
)
def _(x):
    run = Run(x)
    grid = v2.daily_grid(run.contracts, run.warehouses, run.rules)
    return grid.groupBy(*GRID_GROUP).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("order_date").alias("day_count"),
        F.min("order_date").alias("first_day"),
        F.max("order_date").alias("last_day"),
        near(F.sum(F.coalesce("funding_unit_value", F.lit(0.0)))).alias("unit_value_sum"),
    )


FUNDING_LINES_SQL = """
sold as (
  select i.order_id, i.order_created_date_lt as order_date, i.global_entity_id, i.warehouse_id,
    i.sku, i.quantity_sold, i.unit_price_listed_lc, i.unit_discount_lc,
    i.unit_discount_lc > 0 as has_discount,
    i.promo_items_supplier_funded_lc as funding_v1_lc, i.campaign_id,
    a.require_discount_to_charge, a.missing_contract_fallback, a.funding_value_convention,
    a.join_strategy, a.funding_source
  from f_items as i join active as a on a.global_entity_id = i.global_entity_id
    and a.country_code = i.country_code
  where i.is_dark_store and i.is_successful and not i.is_failed and not i.is_cancelled
    and i.quantity_sold > 0
    and i.order_created_date_lt between date '1995-01-01' and date '2001-12-31')"""
SOLD_PLAIN = [
    "order_id", "order_date", "global_entity_id", "warehouse_id", "sku", "quantity_sold",
    "has_discount", "campaign_id",
]
SOLD_AMOUNTS = ["unit_price_listed_lc", "unit_discount_lc", "funding_v1_lc"]


@register(
    "order_lines_for_funding",
    f"with active as (select * from f_rules where is_active), {FUNDING_LINES_SQL}"
    f" select {', '.join(SOLD_PLAIN)}, {sql_rounded(*SOLD_AMOUNTS)} from sold",
)
def _(x):
    return Run(x).lines.select(*SOLD_PLAIN, *rounded(*SOLD_AMOUNTS))


MATCHED_SQL = f"""{STORES_SQL}, {FUNDING_LINES_SQL},
offers as (
  select distinct c.*, s.warehouse_id, s.warehouse_name
  from contracts as c join stores as s using (country_code, campaign_id)),
matched as (
  select l.*, o.campaign_id as funding_campaign_id, {", ".join("o." + c for c in v2.CONTRACT)}
  from sold as l left join offers as o on o.global_entity_id = l.global_entity_id
    and o.warehouse_id = l.warehouse_id and o.sku = l.sku
    and l.order_date between o.first_day and o.campaign_end_date
    and (l.join_strategy = 'date_warehouse_sku' or l.campaign_id = o.campaign_id))"""
MATCH_OUT = [
    "order_id", "order_date", "global_entity_id", "sku", "campaign_id", "funding_campaign_id",
    "contract_status", "funding_unit_value", "campaign_end_date", "warehouse_name",
    "join_strategy",
]


@register("match_funding", f"{MATCHED_SQL} select {', '.join(MATCH_OUT)} from matched")
def _(x):
    return Run(x).matched.select(*MATCH_OUT)


@register("match_funding_stored", QUERIES["match_funding"].plain)
def _(x):
    """The same against slots stored in buckets of the key, which do not move."""
    run = Run(x)
    placed = v2.placed_contracts(run.contracts, run.warehouses)
    slots = v2.contract_slots(placed, run.rules, FULL, run.dense)
    name = f"contract_slots_{uuid.uuid4().hex[:12]}"
    stored = write_bucketed(slots, name, v2.SLOT_KEY)
    return v2.match_slots(run.lines, stored, run.rules, FULL, run.dense).select(*MATCH_OUT)


RESOLVED_SQL = f"""{MATCHED_SQL},
resolved as (
  select * from matched qualify row_number() over (
    partition by global_entity_id, order_id, sku
    order by funding_unit_value desc nulls last,
      {", ".join(f"{c} asc nulls last" for c in v2.LINE_TIES)}) = 1)"""


@register("resolve_overlaps", f"{RESOLVED_SQL} select {', '.join(MATCH_OUT)} from resolved")
def _(x):
    return Run(x).resolved.select(*MATCH_OUT)


BLOCKS = "floor(r.quantity_sold / nullif(r.trigger_qty_threshold, 0))"
# A label per line, and the formula of each label; any other label is worth nothing.
BASIS_SQL = """case when r.require_discount_to_charge and not r.has_discount then 'nothing'
    when r.contract_status = 'missing' and r.missing_contract_fallback in ('skip', 'full_discount')
      then r.missing_contract_fallback
    when r.contract_status = 'explicit_zero' or r.funding_unit_value is null then 'nothing'
    else r.funding_value_convention end"""
BLOCKS_SQL = """least(floor(r.quantity_sold / nullif(r.trigger_qty_threshold, 0)), coalesce(
    nullif(r.benefit_qty_limit, 0), floor(r.quantity_sold / nullif(r.trigger_qty_threshold, 0))))"""
# least() skips NULLs here: without blocks there is no amount.
FORMULAS = {
    "full_discount": "r.unit_discount_lc * r.quantity_sold",
    "normalized": "r.funding_unit_value * r.quantity_sold",
    "per_benefit": f"""r.funding_unit_value * case when nullif(r.trigger_qty_threshold, 0) is not null
      then {BLOCKS_SQL} end""",
}
FORMULA_TABLE = ", ".join(f"'{label}': cast({formula} as double)" for label, formula in FORMULAS.items())
AMOUNT_SQL = f"""case when {BASIS_SQL} in ({", ".join(f"'{x}'" for x in FORMULAS)})
    then round((map {{{FORMULA_TABLE}}})[{BASIS_SQL}], 2) else 0 end"""


@register(
    "funding_amount",
    f"""select order_id, sku, contract_status, {sql_near(AMOUNT_SQL, 2)} as funding_total_lc
    from (select order_id, sku, quantity_sold, unit_discount_lc, unit_discount_lc > 0
        as has_discount, size % 2 = 0 as require_discount_to_charge,
      case size % 3 when 0 then 'missing' when 1 then 'explicit_zero' else 'configured' end
        as contract_status,
      case floor(size / 2) % 2 when 0 then 'skip' else 'full_discount' end
        as missing_contract_fallback,
      case floor(size / 4) % 3 when 0 then 'normalized' when 1 then 'per_benefit' else 'none' end
        as funding_value_convention,
      case when size % 5 > 0 then 0.25 * (size % 5) end as funding_unit_value,
      cast(case size % 7 when 0 then null else size % 7 - 1 end as double)
        as trigger_qty_threshold,
      cast(case size % 4 when 0 then null else size % 4 - 1 end as double) as benefit_qty_limit
      from (select *, cast(substr(sku, 2) as bigint) + cast(quantity_sold as bigint) as size
        from f_items) as i) as r""",
)
def _(x):
    size = F.substring("sku", 2, 30).cast("bigint") + F.col("quantity_sold").cast("bigint")
    items = x("f_items").withColumn("size", size)
    n = F.col("size")
    status = F.when(n % 3 == 0, "missing").when(n % 3 == 1, "explicit_zero")
    convention = F.when(F.floor(n / 4) % 3 == 0, "normalized")
    convention = convention.when(F.floor(n / 4) % 3 == 1, "per_benefit").otherwise("none")
    amount = funding_amount(
        require_discount=n % 2 == 0,
        has_discount=F.col("unit_discount_lc") > 0,
        contract_status=F.col("contract_status"),
        missing_fallback=F.when(F.floor(n / 2) % 2 == 0, "skip").otherwise("full_discount"),
        convention=convention,
        unit_value=F.when(n % 5 > 0, (n % 5) * 0.25),
        unit_discount=F.col("unit_discount_lc"),
        quantity=F.col("quantity_sold"),
        threshold=F.when(n % 7 != 0, (n % 7 - 1).cast("double")),
        limit=F.when(n % 4 != 0, (n % 4 - 1).cast("double")),
    )
    staged = items.withColumn("contract_status", status.otherwise("configured"))
    return staged.select(
        "order_id", "sku", "contract_status", near(amount, 2).alias("funding_total_lc")
    )


FUNDING_SQL = f"""{RESOLVED_SQL},
amounts as (select r.*, {AMOUNT_SQL} as funding_total_lc from resolved as r),
one_supplier as (
  select global_entity_id, sku, warehouse_id, supplier_name,
    cast(supplier_id as string) as supplier_id from f_master
  qualify row_number() over (partition by global_entity_id, sku, warehouse_id
    order by cast(supplier_id as string), supplier_name) = 1),
funding as (
  select r.*, s.supplier_id, s.supplier_name, ca.root_id, cf.root_id as funding_root_id,
    ca.campaign_subtype, cf.campaign_subtype as funding_campaign_subtype,
    round((r.unit_price_listed_lc - r.unit_discount_lc) * r.quantity_sold, 2) as net_sales_lc,
    case r.funding_source when 'negotiated' then r.funding_total_lc
      when 'promotool' then coalesce(r.funding_v1_lc, 0) end as funding_amount_lc,
    coalesce(r.funding_v1_lc, 0) as known_v1,
    case r.funding_source when 'negotiated' then r.funding_total_lc - coalesce(r.funding_v1_lc, 0)
      when 'promotool' then 0 end as delta_lc,
    r.contract_status = 'missing' as fallback_applied
  from amounts as r
    left join one_supplier as s on s.global_entity_id = r.global_entity_id and s.sku = r.sku
      and s.warehouse_id = r.warehouse_id
    left join f_campaigns as ca on ca.global_entity_id = r.global_entity_id
      and ca.campaign_id = r.campaign_id
    left join f_campaigns as cf on cf.global_entity_id = r.global_entity_id
      and cf.campaign_id = r.funding_campaign_id)"""
FUNDING_PLAIN = [
    "global_entity_id", "order_id", "order_date", "warehouse_id", "supplier_id",
    "supplier_name", "sku", "campaign_id", "funding_campaign_id", "root_id", "funding_root_id",
    "campaign_type", "campaign_subtype", "funding_campaign_subtype", "quantity_sold",
    "has_discount", "contract_status", "supplier_funding_type", "supplier_funding_value",
    "funding_unit_value", "trigger_qty_threshold", "benefit_qty_limit",
    "discount_type_resolved", "discount_value_resolved", "campaign_end_date", "warehouse_name",
    "fallback_applied",
]
FUNDING_AMOUNTS = ["net_sales_lc", "funding_total_lc", "funding_amount_lc", "delta_lc"]


@register(
    "order_funding",
    f"""{FUNDING_SQL} select {", ".join(FUNDING_PLAIN)}, {sql_rounded(*FUNDING_AMOUNTS)},
      {sql_near("known_v1")} as funding_v1_lc, join_strategy as join_method_used,
      funding_value_convention as funding_value_convention_used
    from funding""",
)
def _(x):
    return Run(x).funding.select(
        *FUNDING_PLAIN,
        *rounded(*FUNDING_AMOUNTS, "funding_v1_lc"),
        "join_method_used",
        "funding_value_convention_used",
    )


BILLING_SQL = f"""{FUNDING_SQL},
billed as (
  select f.*, case a.param_billing_period when 'order_date' then f.order_date
      when 'campaign_end_date' then f.campaign_end_date end as billed_on
  from funding as f join active as a using (global_entity_id)
  where f.funding_amount_lc > 0),
bills as (
  select global_entity_id, cast(date_trunc('month', billed_on) as date) as billing_month,
    supplier_id, supplier_name, warehouse_id, warehouse_name,
    count(distinct order_id) as total_orders, count(distinct sku) as total_skus,
    count(distinct campaign_id) as total_campaigns,
    {sql_near("sum(funding_amount_lc)", 2)} as total_funding_v2_lc,
    {sql_near("sum(known_v1)", 2)} as total_funding_v1_lc,
    {sql_near("sum(delta_lc)", 2)} as total_delta_lc,
    count(*) filter (where fallback_applied) as fallback_orders,
    date '2001-12-31' as run_date, '2.0' as method_version
  from billed where billed_on between date '1995-01-01' and date '2001-12-31'
  group by all)"""
BILLED = ["total_funding_v2_lc", "total_funding_v1_lc", "total_delta_lc"]


@register("billing", f"{BILLING_SQL} select * from bills")
def _(x):
    rows = Run(x).billing
    return rows.select(*[c for c in rows.columns if c not in BILLED], *rounded(*BILLED, digits=2))


@register(
    "reconcile_v1_v2",
    f"""{FUNDING_SQL} select global_entity_id,
      cast(date_trunc('month', order_date) as date) as order_month, count(*) as order_skus,
      {sql_near("sum(funding_amount_lc)", 2)} as funding_v2_lc,
      {sql_near("sum(known_v1)", 2)} as funding_v1_lc,
      {sql_near("sum(delta_lc)", 2)} as delta_lc
    from funding group by all""",
)
def _(x):
    rows = bill.reconcile(Run(x).funding)
    return rows.select(
        "global_entity_id", "order_month", "order_skus",
        *rounded("funding_v2_lc", "funding_v1_lc", "delta_lc", digits=2),
    )


@register(
    "run_metrics",
    f"""{BILLING_SQL},
    measured as (
      select 'rows' as metric, cast(count(*) as double) as value, count(*) >= 1000 as healthy
        from funding
      union all select 'funded_share', count(*) filter (where funding_total_lc > 0) / count(*),
        count(*) filter (where funding_total_lc > 0) / count(*) >= 0.15 from funding
      union all select 'funding_v1', sum(known_v1), sum(known_v1) <> 0 from funding
      union all select 'relative_delta', abs(sum(delta_lc)) / sum(known_v1),
        abs(sum(delta_lc)) / sum(known_v1) <= 0.5 from funding
      union all select 'billing_rows', count(*), count(*) >= 10 from bills)
    select metric, healthy, {sql_near("value", 3)} as value from measured""",
)
def _(x):
    run = Run(x)
    run.funding = materialise(run.funding, "order_funding")  # read by its own metrics and by billing
    report = run_metrics(run.funding, run.billing, {"rows": 1000, "billing_rows": 10})
    return report.select("metric", "healthy", near(F.col("value"), 3).alias("value"))


@register("funding_amount_sql", QUERIES["funding_amount"].plain)
def _(x):
    """The same in SQL text alone."""
    register_all(x.spark)
    x("f_items").createOrReplaceTempView("f_items")
    amounts = x.spark.sql(
        """WITH sized AS (SELECT *, cast(substr(sku, 2) AS BIGINT) + cast(quantity_sold AS BIGINT) AS sz FROM f_items),
        staged AS (SELECT *,
            element_at(array('missing', 'explicit_zero', 'configured'), cast(sz % 3 + 1 AS INT)) AS contract_status,
            element_at(array('normalized', 'per_benefit', 'none'), cast(sz div 4 % 3 + 1 AS INT)) AS convention,
            if(sz div 2 % 2 = 0, 'skip', 'full_discount') AS fallback,
            if(sz % 5 > 0, sz % 5 * 0.25D, NULL) AS unit_value,
            if(sz % 7 <> 0, sz % 7 - 1, NULL) AS threshold, if(sz % 4 <> 0, sz % 4 - 1, NULL) AS most
          FROM sized)
        SELECT order_id, sku, contract_status, funding_amount(
            funding_basis(sz % 2 = 0, unit_discount_lc > 0, contract_status, fallback, convention, unit_value),
            unit_value, unit_discount_lc, quantity_sold, threshold, most) AS funding_total_lc
        FROM staged"""
    )
    return amounts.withColumn("funding_total_lc", near(F.col("funding_total_lc"), 2))
