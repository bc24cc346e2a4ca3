"""Campaign tables: clean, nested, curated, and versions under their root."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundspark.functions.classify import campaign_subtype
from fundspark.functions.sql import register_all
from fundspark.operators import campaigns as ops
from fundspark.operators.nested import unfold
from suite.model import FULL, HEADER_TIMES, MONTHLY, QUERIES, Inputs, register, sql_text, text

# Campaign type, what it applies to, discount type, discount value, label; * is any.
SUBTYPE_LABELS = """
    ('Strikethrough', 'goods', 'ABSOLUTE', '*', 'Strikethrough $'),
    ('Strikethrough', 'goods', 'PERCENTAGE', '*', 'Strikethrough %'),
    ('SameItemBundle', 'goods', 'PERCENTAGE', 'full', 'Multibuy: Same Item - Free Item'),
    ('SameItemBundle', 'goods', 'PERCENTAGE', 'part', 'Multibuy: Same Item %'),
    ('SameItemBundle', 'goods', 'ABSOLUTE', '*', 'Multibuy: Same Item $'),
    ('SameItemBundle', 'DELIVERY_FEE', '*', '*', 'Multibuy: Same Item - Delivery Fee Discount'),
    ('MixAndMatch', 'goods', 'PERCENTAGE', 'full', 'Multibuy: Mix & Match - Free Item'),
    ('MixAndMatch', 'goods', 'PERCENTAGE', 'part', 'Multibuy: Mix & Match %'),
    ('MixAndMatch', 'goods', 'ABSOLUTE', '*', 'Multibuy: Mix & Match $'),
    ('MixAndMatch', 'DELIVERY_FEE', '*', '*', 'Multibuy: Mix & Match - Delivery Fee Discount'),
    ('BasketValue', 'DELIVERY_FEE', '*', '*', 'Basket Discount - Delivery'),
    ('BasketValue', 'goods', 'PERCENTAGE', 'full', 'Basket Discount - Free Item'),
    ('BasketValue', 'BASKET', 'PERCENTAGE', '*', 'Basket Discount %'),
    ('BasketValue', 'BASKET', 'ABSOLUTE', '*', 'Basket Discount $'),
    ('Generic', '*', '*', '*', 'Generic')"""
SUBTYPE_SQL = f"""(select label from (values {SUBTYPE_LABELS}) as t(kind, target, discount, worth, label)
  where kind = campaign_type and discount in ('*', discount_type)
    and target in ('*', case when applies_to in ('PRODUCTS', 'CHEAPEST_PRODUCTS') then 'goods' else applies_to end)
    and worth in ('*', case when discount_value = 100 then 'full' when discount_value < 100 then 'part' end))"""

SHAPED_SQL = f"""
shaped as (
  select country_code, global_entity_id, global_id as campaign_id, name as campaign_name,
    case when type in ('Generic', 'GENERIC', 'OldFashioned Campaign Type') then 'Generic'
      else type end as campaign_type,
    case when target_audience in ('RETURNING', 'ALL', 'SUBSCRIBED_USER', 'NEW_USER')
      or target_audience is null then target_audience else 'SEGMENT_USER' end as target_audience,
    case when target_audience not in ('RETURNING', 'ALL', 'SUBSCRIBED_USER', 'NEW_USER')
      then target_audience end as target_audience_id,
    applies_to, json_extract_string(discount, '$.type') as discount_type,
    try_cast(json_extract_string(discount, '$.value') as double) as discount_value,
    global_usage_limit, user_usage_limit, budget, total_trigger_threshold,
    externally_funded_percentage, creation_date as created_at_utc,
    updated_date as updated_at_utc, start_time as start_at_utc, end_time as end_at_utc,
    active as is_active, description as descriptions, display_name as display_names,
    benefit_qty_limit, trigger_qty_threshold, cart_item_usage_limit, reason, root_id,
    deactivated_at as deactivated_at_utc, root_creation_date as root_creation_at_utc,
    fixed_bundle_price, experiment_id, variation_name, creation_source, external_funder, state,
    not (updated_date < start_time and coalesce(not active, false)) as is_valid
  from f_campaigns_raw
  qualify row_number() over (partition by country_code, global_id
    order by creation_date desc nulls last) = 1)"""
PLAIN = [c for c in ops.HEADER if c not in HEADER_TIMES and c != "campaign_subtype"]


@register(
    "campaigns_clean",
    f"""with {SHAPED_SQL} select {", ".join(PLAIN)}, {sql_text(*HEADER_TIMES)},
    {SUBTYPE_SQL} as campaign_subtype from shaped""",
)
def _(x):
    clean = ops.campaigns_clean(x("f_campaigns_raw"))
    return clean.select(*PLAIN, *text(*HEADER_TIMES), "campaign_subtype")


@register(
    "campaign_subtype",
    f"""select campaign_type, applies_to, discount_type, {SUBTYPE_SQL} as campaign_subtype,
      count(*) as part_count
    from (select case p_partkey % 6 when 0 then 'Strikethrough' when 1 then 'SameItemBundle'
        when 2 then 'MixAndMatch' when 3 then 'BasketValue' when 4 then 'Generic' else 'Other' end
        as campaign_type,
      case p_size % 4 when 0 then 'PRODUCTS' when 1 then 'CHEAPEST_PRODUCTS'
        when 2 then 'DELIVERY_FEE' else 'BASKET' end as applies_to,
      case p_partkey % 5 when 0 then 'ABSOLUTE' when 1 then null else 'PERCENTAGE' end
        as discount_type,
      cast(case p_size % 3 when 0 then 100 when 1 then 20 end as double) as discount_value
      from part) as p group by all""",
)
def _(x):
    key, size = F.col("p_partkey"), F.col("p_size")

    def pick(number, names, default=None):
        col = F.when(F.lit(False), F.lit(None).cast("string"))
        for i, name in enumerate(names):
            col = col.when(number == i, F.lit(name))
        return col.otherwise(F.lit(default))

    shaped = x.base("part").select(
        pick(
            key % 6,
            ["Strikethrough", "SameItemBundle", "MixAndMatch", "BasketValue", "Generic"],
            "Other",
        ).alias("campaign_type"),
        pick(size % 4, ["PRODUCTS", "CHEAPEST_PRODUCTS", "DELIVERY_FEE"], "BASKET").alias(
            "applies_to"
        ),
        pick(key % 5, ["ABSOLUTE", None], "PERCENTAGE").alias("discount_type"),
        F.when(size % 3 == 0, 100.0).when(size % 3 == 1, 20.0).alias("discount_value"),
    )
    subtype = campaign_subtype(*[F.col(c) for c in shaped.columns])
    return (
        shaped.withColumn("campaign_subtype", subtype)
        .groupBy("campaign_type", "applies_to", "discount_type", "campaign_subtype")
        .agg(F.count(F.lit(1)).alias("part_count"))
    )


def nested(x: Inputs):
    return ops.campaigns_nested(
        x("f_campaigns"), x("f_benefits"), x("f_triggers"), x("f_campaign_vendors"), FULL
    )


CHILD_COUNTS = """
counted as (
  select country_code, campaign_id,
    sum(case when kind = 'b' then 1 else 0 end) as benefit_count,
    sum(case when kind = 't' then 1 else 0 end) as trigger_count,
    sum(case when kind = 'v' then 1 else 0 end) as vendor_count
  from (select country_code, campaign_id, 'b' as kind from f_benefits
    union all select country_code, campaign_id, 't' from f_triggers
    union all select country_code, campaign_id, 'v' from f_campaign_vendors) as c
  group by country_code, campaign_id)"""
HEADER_SQL = [c for c in ops.HEADER if c not in HEADER_TIMES]


@register(
    "campaigns_nested",
    f"""select country_code, campaign_id, 'benefit' as kind, sku as element_id,
      cast(supplier_funding_value as string) as detail from f_benefits
    union all select country_code, campaign_id, 'trigger', sku, cast(updated_at_utc as string)
      from f_triggers
    union all select country_code, campaign_id, 'vendor', catalog_global_vendor_id,
      cast(updated_at_utc as string) from f_campaign_vendors""",
)
def _(x):
    def elements(array, kind, identity, detail):
        return F.transform(
            array,
            lambda e: F.struct(
                F.lit(kind).alias("kind"),
                e[identity].alias("element_id"),
                e[detail].cast("string").alias("detail"),
            ),
        )

    everything = F.concat(
        elements("benefits", "benefit", "sku", "supplier_funding_value"),
        elements("triggers", "trigger", "sku", "updated_at_utc"),
        elements("vendors", "vendor", "catalog_global_vendor_id", "updated_at_utc"),
    )
    keep = ["country_code", "campaign_id"]
    return unfold(nested(x).withColumn("elements", everything), "elements", keep)


@register(
    "campaigns_curated",
    f"""with {CHILD_COUNTS} select {", ".join("c." + h for h in HEADER_SQL)},
      {sql_text(*HEADER_TIMES, prefix="c.")},
      cast(coalesce(benefit_count, 0) as bigint) as benefit_count,
      cast(coalesce(trigger_count, 0) as bigint) as trigger_count,
      cast(coalesce(vendor_count, 0) as bigint) as vendor_count
    from f_campaigns as c left join counted using (country_code, campaign_id)""",
)
def _(x):
    curated = ops.campaigns_curated(nested(x))
    sizes = {"benefits": "benefit_count", "triggers": "trigger_count", "vendors": "vendor_count"}
    return curated.select(
        *HEADER_SQL,
        *text(*HEADER_TIMES),
        *[F.size(a).cast("bigint").alias(n) for a, n in sizes.items()],
    )


IN_LIST = ", ".join(f"'{e}'" for e in MONTHLY.entities)
ELIGIBLE_SQL = f"""
eligible as (
  select * from f_campaigns
  where state = 'READY' and is_valid and global_entity_id in ({IN_LIST})
    and cast(end_at_utc as date) between date '1998-04-27' and date '1998-05-31'
    and not (global_entity_id = 'TB_N1' and regexp_matches(lower(campaign_name), 'a3|b5')))"""
ELIGIBLE_TIMES = ["created_at_utc", "start_at_utc", "end_at_utc"]
ELIGIBLE_PLAIN = [
    "global_entity_id", "country_code", "campaign_id", "root_id", "campaign_name",
    "campaign_type", "campaign_subtype", "reason",
]


def eligible(x: Inputs):
    return ops.eligible_campaigns(x("f_campaigns"), x.entities, MONTHLY)


@register(
    "eligible_campaigns",
    f"with {ELIGIBLE_SQL} select {', '.join(ELIGIBLE_PLAIN)}, {sql_text(*ELIGIBLE_TIMES)}"
    " from eligible",
)
def _(x):
    return eligible(x).select(*ELIGIBLE_PLAIN, *text(*ELIGIBLE_TIMES))


@register(
    "campaign_root_dates",
    """select global_entity_id, country_code, root_id,
      cast(min(created_at_utc) as string) as min_created_at_utc,
      cast(min(start_at_utc) as string) as min_start_at_utc,
      cast(max(end_at_utc) as string) as max_end_at_utc
    from f_campaigns where root_id is not null group by all""",
)
def _(x):
    dates = ops.campaign_root_dates(x("f_campaigns"))
    return dates.select(
        *ops.ROOT_KEYS, *text("min_created_at_utc", "min_start_at_utc", "max_end_at_utc")
    )


# Versions with what they inherit from their root; `source` holds the campaigns to roll up.
ROLLUP_SQL = """
dated as (
  select *, min(created_at_utc) over r as first_created, min(start_at_utc) over r as first_start,
    max(end_at_utc) over r as last_end
  from source where root_id is not null
  window r as (partition by global_entity_id, country_code, root_id)),
headed as (
  select d.global_entity_id, d.country_code, d.root_id,
    coalesce(r.campaign_id, d.root_id) as campaign_id,
    coalesce(r.campaign_name, d.campaign_name) as campaign_name,
    coalesce(r.campaign_type, d.campaign_type) as campaign_type,
    coalesce(r.campaign_subtype, d.campaign_subtype) as campaign_subtype,
    coalesce(r.reason, d.reason) as reason,
    first_created as campaign_created_at_utc, first_start as campaign_start_at_utc,
    last_end as campaign_end_at_utc, d.campaign_id as version_id,
    d.campaign_type as version_type, d.start_at_utc as version_start, d.end_at_utc as version_end
  from dated as d left join source as r on r.global_entity_id = d.global_entity_id
    and r.country_code = d.country_code and r.campaign_id = d.root_id and r.root_id = r.campaign_id)"""
ROLLUP_PLAIN = [
    "global_entity_id", "country_code", "root_id", "campaign_id", "campaign_name",
    "campaign_type", "campaign_subtype", "reason",
]
ROLLUP_TIMES = ["campaign_created_at_utc", "campaign_start_at_utc", "campaign_end_at_utc"]


@register(
    "campaign_version_rollup",
    f"""with source as (select * from f_campaigns), {ROLLUP_SQL}
    select {", ".join(ROLLUP_PLAIN)}, {sql_text(*ROLLUP_TIMES)},
      cast(sum(case when version_id <> root_id then 1 else 0 end) as bigint) as child_count,
      coalesce(string_agg(case when version_id <> root_id then version_id end, '|'
        order by version_id), '') as children
    from headed group by {", ".join(ROLLUP_PLAIN)}, {", ".join(ROLLUP_TIMES)}""",
)
def _(x):
    rollup = ops.campaign_version_rollup(x("f_campaigns"), FULL)
    return rollup.select(
        *ROLLUP_PLAIN,
        *text(*ROLLUP_TIMES),
        F.size("child_campaigns").cast("bigint").alias("child_count"),
        F.array_join("child_campaigns.campaign_id", "|").alias("children"),
    )


FLAT_SQL = """
flat as (
  select distinct global_entity_id, root_id, campaign_id, campaign_type, campaign_start_at_utc,
    campaign_end_at_utc from headed
  union
  select global_entity_id, root_id, version_id, version_type, version_start, version_end
  from headed where version_id <> root_id)"""


@register(
    "campaign_versions_flat",
    f"""with source as (select * from f_campaigns), {ROLLUP_SQL}, {FLAT_SQL}
    select global_entity_id, root_id, campaign_id, campaign_type,
      {sql_text("campaign_start_at_utc", "campaign_end_at_utc")} from flat""",
)
def _(x):
    flat = ops.campaign_versions_flat(ops.campaign_version_rollup(x("f_campaigns"), FULL))
    return flat.select(
        "global_entity_id", "root_id", "campaign_id", "campaign_type",
        *text("campaign_start_at_utc", "campaign_end_at_utc"),
    )


@register("campaign_subtype_sql", QUERIES["campaign_subtype"].plain)
def _(x):
    """The same in SQL text alone."""
    register_all(x.spark)
    x.base("part").createOrReplaceTempView("part")
    return x.spark.sql(
        """SELECT campaign_type, applies_to, discount_type,
          campaign_subtype(campaign_type, applies_to, discount_type, discount_value) AS campaign_subtype,
          count(*) AS part_count
        FROM (SELECT
            element_at(array('Strikethrough', 'SameItemBundle', 'MixAndMatch', 'BasketValue', 'Generic', 'Other'),
              cast(p_partkey % 6 + 1 AS INT)) AS campaign_type,
            element_at(array('PRODUCTS', 'CHEAPEST_PRODUCTS', 'DELIVERY_FEE', 'BASKET'),
              cast(p_size % 4 + 1 AS INT)) AS applies_to,
            element_at(array('ABSOLUTE', NULL, 'PERCENTAGE', 'PERCENTAGE', 'PERCENTAGE'),
              cast(p_partkey % 5 + 1 AS INT)) AS discount_type,
            element_at(array(100D, 20D, NULL), cast(p_size % 3 + 1 AS INT)) AS discount_value
          FROM part)
        GROUP BY ALL"""
    )
