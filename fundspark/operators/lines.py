"""Order lines: resolve identifiers, attach point-in-time facts, compute unit economics."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundspark.context import RunContext
from fundspark.functions.classify import country_of
from fundspark.functions.money import NUMERIC, coalesce_zero, convert, net_of_vat
from fundspark.operators.catalog import catalog_vendor_products
from fundspark.operators.dedup import first_per_key, newest_first, tie_break
from fundspark.operators.lineage import materialise
from fundspark.operators.nested import sorted_list
from fundspark.operators.skew import all_of, bounded_join, hot_keys, lookup_join, of_few_keys
from fundspark.operators.temporal import (
    OPEN_END,
    OPEN_START,
    SLICE,
    ChangeLog,
    History,
    asof_join,
    carry_asof,
    dense_keys,
    may_have_dense_keys,
    scd2_from_events,
    with_dense_slice,
    with_neighbour,
)

QUANTITIES = [
    "quantity_ordered", "quantity_picked_up", "quantity_delivered", "quantity_returned",
    "quantity_sold",
]
ORDER_TIME = "order_created_at_utc"
CATALOG_OPEN_END = datetime(2099, 12, 31, 23, 59, 59)


def _since(history: DataFrame, valid_from: str, ctx: RunContext) -> DataFrame:
    """Versions that started on or after ``ctx.history_start``; all without one."""
    if ctx.history_start is None:
        return history
    return history.where(F.to_date(valid_from) >= F.lit(ctx.history_start))


def _asof(ctx: RunContext) -> dict:
    return {"bounds": ctx.asof_bounds, "bucket_days": ctx.asof_bucket_days}


# --- identifiers and quantities -----------------------------------------------------------------


def weight_step(catalog: DataFrame, ctx: RunContext) -> DataFrame:
    """Smallest step in tags such as ``weighted_step-0.5``; malformed tags give NULL."""
    products = catalog_vendor_products(
        catalog.where(F.col("global_entity_id") == ctx.weight_step_entity)
    )
    key = ["global_entity_id", "global_catalog_id", "sku", "platform_vendor_id"]
    tags = products.select(*key, F.explode("tags.tag_name").alias("tag"))
    step = F.get(F.split("tag", "-"), F.lit(1)).try_cast(NUMERIC)
    steps = tags.where(F.lower("tag").like("weighted_step-%"))
    return steps.groupBy(*key).agg(F.min(step).alias("weight_step"))


def resolve_ids(
    lines: DataFrame, sku_history: DataFrame, catalog: DataFrame, ctx: RunContext
) -> DataFrame:
    """SKU and product ids: the line's own, else as of the order time from the history, else from
    the catalog. Intervals are closed, so both versions match at a boundary instant."""
    versions = catalog_vendor_products(catalog).withColumn("valid_to", F.lit(CATALOG_OPEN_END))
    ids = ["sku", "platform_product_id", "global_catalog_id"]
    placed = ["global_entity_id", "platform_vendor_id", "global_catalog_id"]
    from_catalog = asof_join(
        lines,
        versions,
        {c: c for c in placed},
        ORDER_TIME,
        valid_from="vendor_product_created_at_utc",
        valid_to="valid_to",
        values={f"__c_{c}": c for c in ids},
        closed="both",
        dense=dense_keys(versions, placed),
        **_asof(ctx),
    )
    known = _since(sku_history, "valid_from_utc", ctx)
    listed = ["global_entity_id", "platform_product_id", "platform_vendor_id"]
    both = asof_join(
        from_catalog,
        known,
        {c: c for c in listed},
        ORDER_TIME,
        values={f"__h_{c}": c for c in ids},
        closed="both",
        dense=dense_keys(known, listed),
        **_asof(ctx),
    )
    resolved = {c: F.coalesce(c, f"__h_{c}", f"__c_{c}") for c in ids}
    return both.select(
        *[resolved.get(c, F.col(c)).alias(c) for c in lines.columns],
        F.col("global_catalog_id").alias("__line_catalog_id"),
    )


def normalise_quantity(
    lines: DataFrame, steps: DataFrame, ctx: RunContext, catalog_key: str = "global_catalog_id"
) -> DataFrame:
    """Express quantities of weight-step products as a number of steps.

    Only one entity sells in steps. Lines of the others have no key for the lookup, so they are
    spread by a hash and the plan has one branch, whatever came before.
    """
    if not ctx.weight_step_entity:
        return lines
    mine = F.col("global_entity_id") == ctx.weight_step_entity
    keyed = lines.withColumn("__step_id", F.when(mine, F.col(catalog_key)))
    joined = lookup_join(
        keyed,
        steps,
        ["global_entity_id", "platform_vendor_id", "sku", "__step_id"],
        ["global_entity_id", "platform_vendor_id", "sku", "global_catalog_id"],
        spread_by=["order_id", "picking_order_item_id"],
    )
    in_steps = {
        q: F.when(
            F.col("weight_step").isNotNull(),
            F.round(F.try_divide(F.col(q), F.col("weight_step").cast("double")), 2),
        ).otherwise(F.col(q))
        for q in QUANTITIES
    }
    return joined.withColumns(in_steps).select(*lines.columns)


# --- validity intervals -------------------------------------------------------------------------


def warehouse_intervals(warehouses: DataFrame) -> DataFrame:
    """When which warehouse served a vendor. A migration ends one interval and starts the next.

    Migrations are taken in time order with the current pair last, which keeps intervals of a
    vendor that moved more than once free of overlaps.
    """
    pairs = warehouses.select(
        "global_entity_id", "warehouse_id", "is_dark_store", F.explode_outer("vendors").alias("v")
    ).select(
        "global_entity_id",
        "warehouse_id",
        "is_dark_store",
        F.coalesce("v.platform_vendor_id", "v.additional_platform_vendor_id").alias("join_key"),
        F.coalesce("v.migrated_at_utc", F.lit(OPEN_END)).alias("valid_to_utc"),
    )
    started = with_neighbour(
        pairs.distinct(),
        ["global_entity_id", "join_key"],
        "valid_to_utc",
        "valid_from_utc",
        following=False,
        ties=["warehouse_id", "is_dark_store"],
    )
    return started.withColumn("valid_from_utc", F.coalesce("valid_from_utc", F.lit(OPEN_START)))


def warehouse_asof(lines: DataFrame, intervals: DataFrame, ctx: RunContext) -> DataFrame:
    return asof_join(
        lines,
        intervals,
        {"fulfilled_by_entity": "global_entity_id", "platform_vendor_id": "join_key"},
        ORDER_TIME,
        values={"warehouse_id": "warehouse_id", "is_dark_store": "is_dark_store"},
        closed="both",
        **_asof(ctx),
    ).withColumn("is_dark_store", F.coalesce("is_dark_store", F.lit(False)))


def known_rates(events: DataFrame, last_day: date | None) -> DataFrame:
    if last_day is None:
        return events
    return events.where(F.to_date("timestamp_valid_from") <= F.lit(last_day))


def vat_intervals(events: DataFrame, last_day: date | None = None) -> DataFrame:
    """VAT rates as intervals; changes after ``last_day`` are not known yet."""
    changes = known_rates(events, last_day).select(
        "global_entity_id",
        "global_catalog_id",
        F.col("timestamp_valid_from").alias("valid_from_utc"),
        F.col("vat_rate").alias("history_vat_rate"),
    )
    return scd2_from_events(
        changes,
        ["global_entity_id", "global_catalog_id"],
        "valid_from_utc",
        ties=["history_vat_rate"],
    )


FULFILLED_PRODUCT = {
    "fulfilled_by_entity": "global_entity_id",
    "global_catalog_id": "global_catalog_id",
}
SOLD_PRODUCT = {c: c for c in ("global_entity_id", "global_catalog_id")}


def vat_asof(lines: DataFrame, intervals: DataFrame, ctx: RunContext) -> DataFrame:
    """VAT rate at order time, else the line's own rate."""
    joined = asof_join(
        lines, intervals, FULFILLED_PRODUCT, ORDER_TIME,
        values={"__vat": "history_vat_rate"}, **_asof(ctx),
    )
    rate = F.coalesce(F.col("__vat").cast(NUMERIC).cast("double"), F.col("vat_percentage"))
    return joined.withColumn("product_vat_rate", rate).drop("__vat")


def price_asof(lines: DataFrame, history: DataFrame, ctx: RunContext) -> DataFrame:
    """Listed price at order time (history, unit price, 0) and the discount against it."""
    known = _since(history, "valid_from_lt", ctx)
    return price_columns(
        asof_join(
            lines, known, FULFILLED_PRODUCT, ORDER_TIME,
            values={"__listed": "original_price_lc"}, dense=dense_keys(known, list(SOLD_PRODUCT)), **_asof(ctx),
        )
    ).drop("__listed")


def price_columns(lines: DataFrame) -> DataFrame:
    listed = coalesce_zero(F.col("__listed"), F.col("unit_price_lc"))
    saved = listed - F.col("unit_price_paid_lc")
    return lines.withColumns(
        {
            "unit_price_listed_lc": listed,
            "unit_discount_lc": F.when(saved > 0, saved).otherwise(F.lit(0.0)),
        }
    )


def cost_asof(lines: DataFrame, wac: DataFrame, ctx: RunContext) -> DataFrame:
    """Weighted average cost at order time; the unit cost falls back to the price."""
    joined = asof_join(
        lines,
        wac,
        {
            "fulfilled_by_entity": "global_entity_id",
            "warehouse_id": "warehouse_id",
            "sku": "sku",
        },
        ORDER_TIME,
        valid_from="valid_from",
        valid_to="valid_to",
        values={"wac": "wac"},
        closed="both",
        dense=dense_keys(wac, ["global_entity_id", "warehouse_id", "sku"]),
        **_asof(ctx),
    )
    return joined.withColumn("unit_cost_lc", F.coalesce("wac", "unit_price_lc"))


def sales_buffer_asof(
    lines: DataFrame, history: DataFrame, ctx: RunContext, last_day: date | None = None
) -> DataFrame:
    known = history
    if last_day is not None:
        known = history.where(F.to_date("valid_from_lt") <= F.lit(last_day))
    return asof_join(
        lines, known, SOLD_PRODUCT, ORDER_TIME,
        values={"sales_buffer": "sales_buffer"}, dense=dense_keys(known, list(SOLD_PRODUCT)), **_asof(ctx),
    )


# Output name, log field and type of each product attribute kept as a history.
ATTRIBUTES: Mapping[str, tuple[str, str]] = {
    "minimum_starting_weight": ("minimum_starting_weight", NUMERIC),
    "is_sold_by_weight": ("sold_by_weight", "boolean"),
    "is_sold_by_piece": ("sold_by_piece", "boolean"),
    "average_weight_per_piece": ("average_weight_per_piece", NUMERIC),
}
# Fields whose values may be malformed; those become NULL instead of an error.
LENIENT_FIELDS = ("average_weight_per_piece",)


def typed_value(field: str, kind: str):
    """How the logged text of a field is read."""
    return lambda value: value.try_cast(kind) if field in LENIENT_FIELDS else value.cast(kind)


def known_changes(log: DataFrame, ctx: RunContext) -> DataFrame:
    """Changes of the kept attributes up to the run date."""
    fields = [field for field, _ in ATTRIBUTES.values()]
    day = F.to_date("valid_from_lt")
    return log.where(F.col("updated_field").isin(fields) & (day <= F.lit(ctx.as_of)))


def attribute_changes(log: DataFrame, ctx: RunContext) -> DataFrame:
    """Last change per product, field and local day, up to the run date."""
    return first_per_key(
        known_changes(log, ctx).withColumn("__day", F.to_date("valid_from_lt")),
        ["global_entity_id", "global_catalog_id", "updated_field", "__day"],
        [*newest_first("valid_from_lt"), *tie_break("updated_value")],
    ).drop("__day")


def attribute_asof(lines: DataFrame, log: DataFrame, ctx: RunContext) -> DataFrame:
    """The four weight attributes in force at order time.

    All four joins use one key, so lines are shuffled for the first one only; products with many
    changes are cut into time slices. The field is part
    of the key the log is cleaned on, so each history cleans its own share of the log.
    """
    changes = attribute_changes(log, ctx)
    kept = lines.columns
    dense = dense_keys(log, list(SOLD_PRODUCT))
    if SLICE not in kept:
        lines = with_dense_slice(lines, list(SOLD_PRODUCT), ORDER_TIME, dense, **_asof(ctx))
    for out, (field, kind) in ATTRIBUTES.items():
        typed = typed_value(field, kind)(F.col("updated_value"))
        history = changes.where(F.col("updated_field") == field).withColumn("__value", typed)
        lines = asof_join(
            lines, history, SOLD_PRODUCT, ORDER_TIME, values={out: "__value"}, dense=dense, **_asof(ctx)
        )
    return lines.select(*kept, *ATTRIBUTES)


def product_histories(
    lines: DataFrame,
    *,
    vat: DataFrame,
    prices: DataFrame,
    sales_buffers: DataFrame,
    attribute_log: DataFrame,
    ctx: RunContext,
    last_day: date | None = None,
    hot: DataFrame | None = None,
    vat_events: DataFrame | None = None,
) -> DataFrame:
    """VAT, listed price, sales buffer and the four weight attributes of a product at order time.

    The same columns as ``vat_asof``, ``price_asof``, ``sales_buffer_asof`` and ``attribute_asof``
    one after another, from one merge of all seven histories: lines and versions move once, by
    product, and where a product has very many versions by time slice too. ``hot`` are the products to
    deal to several tasks (``hot_keys``), ``vat_events`` what ``vat`` was made from, up to ``last_day``:
    those are merged as they are.
    """
    if last_day is not None:
        sales_buffers = sales_buffers.where(F.to_date("valid_from_lt") <= F.lit(last_day))
    stored = [
        History(_since(prices, "valid_from_lt", ctx), FULFILLED_PRODUCT, {"__listed": "original_price_lc"}),
        History(sales_buffers, SOLD_PRODUCT, {"sales_buffer": "sales_buffer"}),
    ]
    common, asof = "global_catalog_id", _asof(ctx)
    counted = [vat if vat_events is None else vat_events, prices, sales_buffers, attribute_log]
    versions = reduce(DataFrame.unionAll, [df.select(common) for df in counted])
    if may_have_dense_keys(versions, common):
        # Their versions are cut into time slices, so all of them are cleaned before they move.
        dense = dense_keys(versions, [common])
        changes = attribute_changes(attribute_log, ctx)
        stored.append(History(vat, FULFILLED_PRODUCT, {"__vat": "history_vat_rate"}))
        for out, (field, kind) in ATTRIBUTES.items():
            value = typed_value(field, kind)(F.col("updated_value"))
            of_field = changes.where(F.col("updated_field") == field).withColumn("__value", value)
            stored.append(History(of_field, SOLD_PRODUCT, {out: "__value"}))
    else:
        dense, asof = None, {}
        casts = {out: (field, typed_value(field, kind)) for out, (field, kind) in ATTRIBUTES.items()}
        stored.append(
            ChangeLog(
                known_changes(attribute_log, ctx), SOLD_PRODUCT, "updated_value", casts,
                valid_to="valid_to_utc", kind="updated_field", seen="valid_from_lt",
            )
        )
        if vat_events is None:
            stored.append(History(vat, FULFILLED_PRODUCT, {"__vat": "history_vat_rate"}))
        else:
            known = known_rates(vat_events, last_day)
            casts = {"__vat": (None, lambda rate: rate)}
            stored.append(
                ChangeLog(known, FULFILLED_PRODUCT, "vat_rate", casts, valid_from="timestamp_valid_from")
            )
    carried = carry_asof(
        lines, stored, ORDER_TIME, common=common,
        spread_by=["order_id", "picking_order_item_id"], hot=hot, dense=dense, **asof,
    )
    rate = F.coalesce(F.col("__vat").cast(NUMERIC).cast("double"), F.col("vat_percentage"))
    return price_columns(carried.withColumn("product_vat_rate", rate)).drop("__vat", "__listed")


def weight_fields(lines: DataFrame) -> DataFrame:
    """Weights of weightable products, and the attributes as one struct."""
    by_weight = F.coalesce("is_sold_by_weight", F.lit(False))
    by_piece = F.coalesce("is_sold_by_piece", F.lit(False))
    weightable = by_weight | by_piece
    unit = F.lit("KG")

    def when_weightable(col: Column) -> Column:
        return F.when(weightable, col)

    return lines.withColumns(
        {
            "ordered_weight": when_weightable(F.col("quantity_ordered")),
            "delivered_weight": when_weightable(F.col("quantity_delivered")),
            "sold_weight": when_weightable(F.col("quantity_sold")),
            "returned_weight": when_weightable(F.col("quantity_returned")),
            "weight_unit": when_weightable(unit),
            "weightable_attributes": F.struct(
                by_weight.alias("is_sold_by_weight"),
                by_piece.alias("is_sold_by_piece"),
                weightable.alias("is_weightable"),
                unit.alias("weightable_unit"),
                F.col("minimum_starting_weight"),
                unit.alias("minimum_starting_weight_unit"),
                F.col("average_weight_per_piece"),
            ),
        }
    )


# --- money --------------------------------------------------------------------------------------


def fx_convert(
    df: DataFrame,
    fx: DataFrame,
    amounts: Mapping[str, str],
    *,
    on: tuple[str, str] = (ORDER_TIME, "currency_code"),
    fx_key: str = "currency_code",
) -> DataFrame:
    """Add the exchange rate of the day and ``amounts`` (output name to local column) in EUR."""
    when, code = on
    rates = fx.select(
        F.col("exchange_rate_date").alias("__day"),
        F.col(fx_key).alias("__code"),
        F.col("exchange_rate_value").alias("fx_rate"),
    ).distinct()
    keyed = df.withColumns({"__day": F.to_date(when), "__code": F.col(code)})
    # Three narrow columns: 200,000 rows are less than 10 MB.
    joined = bounded_join(keyed, rates, ["__day", "__code"], "left", max_rows=200_000, counted=fx)
    rate = F.col("fx_rate")
    eur = {name: convert(F.col(local), rate) for name, local in amounts.items()}
    return joined.drop("__day", "__code").withColumns(eur)


def unit_economics(lines: DataFrame) -> DataFrame:
    """Net amount, cost of goods and contribution of a line, in local currency and EUR.

    Cost of goods counts delivered minus returned, times 1000 for weightable products. The
    contribution counts delivered only, without that factor, and the funding of the first
    campaign match.
    """
    zero, thousand = F.lit(0.0), F.lit(1000)
    cost = F.coalesce("wac", zero)
    kept = F.coalesce(
        F.col("quantity_delivered") - F.coalesce("quantity_returned", zero), zero
    )
    weightable = F.col("is_sold_by_weight") | F.col("is_sold_by_piece")
    vat, rate = F.col("product_vat_rate"), F.col("fx_rate")
    paid, paid_eur = F.col("total_amt_paid_lc"), F.col("total_amt_paid_lc") / F.col("fx_rate")

    def cogs(unit: Column) -> Column:
        amount = unit * kept
        return F.when(weightable, (amount * thousand).cast(NUMERIC)).otherwise(
            amount.cast(NUMERIC)
        )

    def contribution(net: Column, unit: Column, funded: str) -> Column:
        return (net - unit * F.col("quantity_delivered") + F.coalesce(funded, zero)).cast(NUMERIC)

    net, net_eur = net_of_vat(paid, vat), net_of_vat(paid_eur, vat)
    return lines.withColumns(
        {
            "total_amt_paid_net_lc": net,
            "total_amt_paid_net_eur": net_eur,
            "amt_cogs_lc": cogs(cost),
            "amt_cogs_eur": cogs(cost / rate),
            "total_ppp_lc": contribution(net, cost, "__first_funded_lc"),
            "total_ppp_eur": contribution(net_eur, cost / rate, "__first_funded_eur"),
        }
    )


# --- campaigns on lines -------------------------------------------------------------------------

MATCH_AMOUNTS = [
    "promo_items_discount_lc", "promo_items_discount_eur", "promo_items_supplier_funded_lc",
    "promo_items_supplier_funded_eur", "order_items_supplier_funded_lc",
    "order_items_supplier_funded_eur",
]


def two_key_match(lines: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Campaign facts by catalog id; lines without a match there are tried by platform id.

    A NULL item id equals a NULL item id. Both times rows meet by order and item and the few of these
    are compared by product, so lines move once for both, and a popular product never gathers in one
    task.
    """
    carried = [*MATCH_AMOUNTS, "campaign_info", "combo_products"]

    def side(tag: str, product: str) -> DataFrame:
        return campaigns.select(
            F.col("global_entity_id").alias(f"__{tag}_entity"),
            F.lower("country_code").alias(f"__{tag}_country"),
            F.col("order_id").alias(f"__{tag}_order"),
            F.col(product).alias(f"__{tag}_product"),
            F.col("promo_order_item_id").alias(f"__{tag}_item"),
            *[F.col(c).alias(f"__{tag}_{c}") for c in carried],
        )

    def on(left: DataFrame, right: DataFrame, tag: str, product: str) -> list[Column]:
        return [
            left["global_entity_id"] == right[f"__{tag}_entity"],
            F.lower(left["country_code"]) == right[f"__{tag}_country"],
            left["order_id"] == right[f"__{tag}_order"],
            # Not an equality, which would become a part of what the lines are dealt by.
            right[f"__{tag}_product"].between(left[product], left[product]),
            left["promo_order_item_id"].eqNullSafe(right[f"__{tag}_item"]),
        ]

    by_catalog = side("a", "global_catalog_id")
    first = lines.join(
        by_catalog, all_of(on(lines, by_catalog, "a", "global_catalog_id")), "left"
    )
    by_platform = side("b", "platform_product_id")
    unmatched = first["__a_order"].isNull()
    both = first.join(
        by_platform,
        all_of([*on(first, by_platform, "b", "platform_product_id"), unmatched]),
        "left",
    )
    return both.select(
        *[first[c] for c in lines.columns],
        *[coalesce_zero(F.col(f"__a_{c}"), F.col(f"__b_{c}")).alias(c) for c in MATCH_AMOUNTS],
        F.coalesce("__a_campaign_info", "__b_campaign_info").alias("campaign_info"),
        F.coalesce("__a_combo_products", "__b_combo_products").alias("combo_products"),
        F.col("__a_order_items_supplier_funded_lc").alias("__first_funded_lc"),
        F.col("__a_order_items_supplier_funded_eur").alias("__first_funded_eur"),
    )


# From when, and where, the promo tool's item id can be trusted.
ITEM_ID_SINCE = "2024-02-07 11:36:00 Europe/Berlin"
ITEM_ID_REGION = "ap"
ITEM_ID_SPLIT_REGION = "eu"
ITEM_ID_COUNTRIES = ("at", "cz", "de", "fi", "hu", "no", "se", "sk", "tr")


def trusted_item_id(
    region: Column, entity: Column, created: Column, item: Column, since: str = ITEM_ID_SINCE
) -> Column:
    known_here = F.when(region == ITEM_ID_REGION, True).when(
        region == ITEM_ID_SPLIT_REGION, country_of(entity).isin(*ITEM_ID_COUNTRIES)
    )
    return F.when(known_here & (created >= F.expr(f"TIMESTAMP '{since}'")), item)


def _with_external(products: DataFrame, skus: DataFrame, external: DataFrame) -> DataFrame:
    """Add ``abs_discount_value_lt``, paid for a SKU of an order and campaign; several rows may match.

    ``skus`` has one row per product with all its SKUs. The few paid rows go to the products, not the
    lines to the SKUs, so lines move once, by order and product, as those that group them need it. A
    line whose product has several SKUs counts once per SKU, whether something was paid or not.
    """
    product = ["global_entity_id", "product_id"]
    of_sku = skus.select(*product, F.explode("__skus.sku").alias("sku"))
    paid = external.select(
        "global_entity_id", "order_id", "sku", "campaign_id", "abs_discount_value_lt"
    ).join(of_sku, ["global_entity_id", "sku"])
    paid = paid.select(
        F.col("global_entity_id").alias("__paid_entity"),
        F.col("order_id").alias("__paid_order"),
        F.col("product_id").alias("__paid_product"),
        F.col("campaign_id").alias("__paid_campaign"),
        F.col("sku").alias("__paid_sku"),
        "abs_discount_value_lt",
    )
    lines = bounded_join(products, skus.where(F.size("__skus") > 1), product, "left")
    lines = lines.withColumn("__sku", F.explode_outer("__skus")).drop("__skus")
    lines = lines.repartition("global_entity_id", "order_id", "product_id")
    campaign = lines["campaign_id"]
    # Not written as an equality, which would make the campaign a part of what lines are dealt by.
    same_campaign = paid["__paid_campaign"].between(campaign, campaign)
    on = [
        lines["global_entity_id"] == paid["__paid_entity"],
        lines["order_id"] == paid["__paid_order"],
        lines["product_id"] == paid["__paid_product"],
        same_campaign,
        lines["__sku"].isNull() | (lines["__sku"]["sku"] == paid["__paid_sku"]),
    ]
    return lines.join(paid, all_of(on), "left")


def order_line_campaigns(
    orders: DataFrame,
    catalog: DataFrame,
    external: DataFrame,
    *,
    dedupe_products: bool = False,
    item_id_since: str = ITEM_ID_SINCE,
) -> DataFrame:
    """Discount and funding per order and product, with its campaigns and combos as arrays.

    A product with several campaigns counts its own amounts once per campaign; that is how the
    figures are defined. ``dedupe_products`` counts them once instead. The arrays hold the
    campaigns of one basket line, which the clean feed keeps unique.
    """
    skus = materialise(
        catalog_vendor_products(catalog)
        .where(F.col("global_catalog_id").isNotNull())
        .groupBy("global_entity_id", F.col("global_catalog_id").alias("product_id"))
        .agg(F.collect_set(F.struct("sku")).alias("__skus")),
        "product-skus",
    )
    head = ["created_date", "created_at_utc", "region", "global_entity_id", "country_code",
            "order_id", "exchange_rate_value"]
    products = orders.select(*head, F.explode_outer("products").alias("p")).select(
        *head,
        "p.product_id", "p.platform_product_id", "p.promo_order_item_id", "p.parent_product_id",
        "p.product_qty", "p.product_unit_price", "p.subtotal", "p.total",
        "p.absolute_discount_lc", "p.distributed_discounted_price",
        F.posexplode_outer("p.campaigns").alias("__pos", "c"),
    ).select("*", "c.*").drop("c")
    joined = _with_external(products, skus, external)
    rate = F.col("exchange_rate_value")
    once = (F.coalesce("__pos", F.lit(0)) == 0) if dedupe_products else F.lit(True)
    funded = F.coalesce("abs_discount_value_lt", "supplier_funded_amount")
    item = trusted_item_id(
        F.col("region"), F.col("global_entity_id"), F.col("created_at_utc"),
        F.col("promo_order_item_id"), item_id_since,
    )
    campaign = F.struct(
        "campaign_id",
        F.col("product_unit_price").alias("product_unit_price_lc"),
        (F.col("product_unit_price") / rate).alias("product_unit_price_eur"),
        F.col("discount_lc").alias("campaign_discount_amt_lc"),
        (F.col("discount_lc") / rate).alias("campaign_discount_amt_eur"),
        funded.cast(NUMERIC).alias("campaign_supplier_funded_amt_lc"),
        (funded / rate).cast("double").alias("campaign_supplier_funded_amt_eur"),
        "trigger_qty",
        "benefit_qty",
    )
    combo = F.struct(
        F.col("parent_product_id").alias("combo_product_id"),
        F.col("product_qty").alias("combo_qty"),
        F.col("subtotal").alias("combo_amt_paid_lc"),
        (F.col("subtotal") / rate).alias("combo_amt_paid_eur"),
        F.col("distributed_discounted_price").alias("distributed_discounted_price_lc"),
        (F.col("distributed_discounted_price") / rate).alias("distributed_discounted_price_eur"),
    )
    grouped = joined.groupBy(
        F.col("created_date").alias("order_created_date_utc"),
        "global_entity_id",
        "country_code",
        "order_id",
        F.col("product_id").alias("global_catalog_id"),
        "platform_product_id",
        item.alias("promo_order_item_id"),
        "exchange_rate_value",
    ).agg(
        F.sum(F.when(once, F.col("product_qty"))).alias("quantity_sold"),
        F.sum(F.when(once, F.col("subtotal"))).alias("promo_items_before_discount_lc"),
        F.sum(F.when(once, F.col("absolute_discount_lc"))).alias("promo_items_discount_lc"),
        F.sum(F.when(once, F.col("total"))).alias("promo_items_paid_lc"),
        F.sum("supplier_funded_amount").alias("__tool"),
        F.sum("abs_discount_value_lt").alias("__external"),
        sorted_list(campaign).alias("campaign_info"),
        sorted_list(combo).alias("combo_products"),
    )
    local = {
        "promo_items_before_discount": F.col("promo_items_before_discount_lc"),
        "promo_items_discount": F.col("promo_items_discount_lc"),
        "promo_items_paid": F.col("promo_items_paid_lc"),
        "promo_items_supplier_funded": coalesce_zero(F.col("__tool")),
        "order_items_supplier_funded": coalesce_zero(F.col("__external"), F.col("__tool")),
    }
    columns = {}
    for name, amount in local.items():
        columns[f"{name}_lc"] = amount
        columns[f"{name}_eur"] = amount / rate
    return grouped.withColumns(columns).drop("__tool", "__external")


# --- the curated order line ---------------------------------------------------------------------

# The published columns of an order line, in their order.
OUTPUT = [
    "origin", "order_created_date_utc", "order_created_at_utc", "global_entity_id",
    "fulfilled_by_entity", "country_code", "order_id", "warehouse_id", "is_dark_store",
    "global_catalog_id", "platform_product_id", "picking_order_item_id", "sku",
    "promo_order_item_id", "replacement_picking_order_item_id", "platform_vendor_id",
    "vertical_type", "vertical_parent", "currency_code", "pricing_type", "is_custom",
    "order_updated_at_utc", "order_status", "picking_order_item_status",
    "is_checkout_confirmed", "pickup_issue", "is_modified_quantity", "is_modified_price",
    "min_quantity", "max_quantity", *QUANTITIES, "fx_rate", "sales_buffer", "unit_price_lc",
    "unit_price_eur", "unit_price_paid_lc", "unit_price_paid_eur", "total_amt_paid_lc",
    "total_amt_paid_eur", "product_vat_rate", "unit_cost_lc", "unit_cost_eur", "amt_cogs_lc",
    "amt_cogs_eur", *MATCH_AMOUNTS, "unit_price_listed_lc", "unit_price_listed_eur",
    "unit_discount_lc", "unit_discount_eur", "total_amt_paid_net_lc", "total_amt_paid_net_eur",
    "total_ppp_lc", "total_ppp_eur", "returns", "parent_order_id", "campaign_info",
    "combo_products", "ordered_weight", "delivered_weight", "sold_weight", "returned_weight",
    "weight_unit", "weighted_pieces_ordered", "weighted_pieces_picked_up",
    "weightable_attributes",
]

EUR_OF_LOCAL = {
    "unit_price_eur": "unit_price_lc",
    "unit_price_paid_eur": "unit_price_paid_lc",
    "total_amt_paid_eur": "total_amt_paid_lc",
    "unit_cost_eur": "unit_cost_lc",
    "unit_price_listed_eur": "unit_price_listed_lc",
    "unit_discount_eur": "unit_discount_lc",
}


def order_lines_curated(
    lines: DataFrame,
    *,
    sku_history: DataFrame,
    catalog: DataFrame,
    warehouses: DataFrame,
    vendors: DataFrame,
    wac: DataFrame,
    vat_events: DataFrame,
    price_history: DataFrame,
    sales_buffers: DataFrame,
    attribute_log: DataFrame,
    line_campaigns: DataFrame,
    fx: DataFrame,
    ctx: RunContext,
) -> DataFrame:
    """The full order line. The seven histories of a product are merged in one pass over the lines,
    which move once for all of them."""
    dated = lines.withColumn("country_code", country_of(F.col("global_entity_id")))
    stream = ctx.stream_range(1, 1)
    if stream is not None:
        kept = ctx.stream_range() if ctx.backfill else stream
        dated = dated.where(F.col("order_created_date_utc").between(*map(F.lit, kept)))
        near = F.col("order_created_date_utc").between(*map(F.lit, stream))
        line_campaigns = line_campaigns.where(near)
    last_day = stream[1] - timedelta(days=1) if stream is not None else None

    if few_days := stream is not None and not ctx.backfill:
        listed = {c: c for c in ("global_entity_id", "platform_product_id", "platform_vendor_id")}
        (sku_history,) = of_few_keys([sku_history], dated, listed)
    out = resolve_ids(dated, sku_history, catalog, ctx)
    if ctx.weight_step_entity:
        steps = weight_step(catalog, ctx)
        out = normalise_quantity(out, steps, ctx, catalog_key="__line_catalog_id")
    out = warehouse_asof(out.drop("__line_catalog_id"), warehouse_intervals(warehouses), ctx)
    places = vendors.select(
        "global_entity_id", "platform_vendor_id", "vertical_type", "vertical_parent"
    )
    out = out.join(places, ["global_entity_id", "platform_vendor_id"], "left")
    if few_days:
        # Few lines: written once, so that finding their products does not make them twice.
        out = materialise(out, "placed-lines")
        (wac,) = of_few_keys([wac], out, {"sku": "sku"})
        vat_events, price_history, sales_buffers, attribute_log = of_few_keys(
            [vat_events, price_history, sales_buffers, attribute_log],
            out,
            {"global_catalog_id": "global_catalog_id"},
        )
    out = cost_asof(out, wac, ctx)
    out = product_histories(
        out,
        vat=vat_intervals(vat_events, last_day),
        prices=price_history,
        sales_buffers=sales_buffers,
        attribute_log=attribute_log,
        ctx=ctx,
        last_day=last_day,
        # Ids that are resolved later are not counted; that only affects the balance.
        hot=hot_keys(dated, "global_catalog_id", ctx.hot_rows),
        vat_events=vat_events,
    )
    out = two_key_match(out, line_campaigns)
    out = fx_convert(out, fx, EUR_OF_LOCAL)
    out = unit_economics(out)
    out = weight_fields(out)
    zeroed = {q: coalesce_zero(F.col(q)) for q in QUANTITIES}
    return out.withColumns(zeroed).select(*OUTPUT)
