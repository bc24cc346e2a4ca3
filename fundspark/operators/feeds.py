"""Clean the raw promo-tool feeds: orders, items, order campaigns, vendors, external funding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundspark.functions.classify import uses_additional_id
from fundspark.operators.dedup import latest_per_key, merge_sources, newest_first, priority_merge

CART, APP = "cart", "app"

ORDER_KEYS = ["country_code", "promo_order_id"]
ITEM_KEYS = [*ORDER_KEYS, "product_id"]
ORDER_CAMPAIGN_KEYS = [*ORDER_KEYS, "campaign_id", "product_id"]
BENEFIT_KEYS = ["country_code", "global_entity_id", "campaign_id", "sku"]
TRIGGER_OLD_KEYS = ["country_code", "global_entity_id", "campaign_id", "product_id", "vendor_id"]

# Raw name of the columns that the clean tables call differently.
ORDER_NAMES = {
    "order_id": "promo_order_id",
    "platform_order_code": "order_id",
    "absolute_discount": "absolute_discount_lc",
    "delivery_absolute_discount": "delivery_absolute_discount_lc",
    "created_at": "created_at_utc",
    "modified_at": "updated_at_utc",
}
ITEM_NAMES = {
    "order_id": "promo_order_id",
    "order_item_id": "promo_order_item_id",
    "qty": "product_qty",
    "price": "product_unit_price",
    "absolute_discount": "absolute_discount_lc",
    "created_at": "created_at_utc",
    "modified_at": "updated_at_utc",
}
ORDER_CAMPAIGN_NAMES = {
    "order_id": "promo_order_id",
    "discount": "discount_lc",
    "created_at": "created_at_utc",
    "modified_at": "updated_at_utc",
}
BENEFIT_NAMES = {
    "discount": "discount_value",
    "supplier_fund_type": "supplier_funding_type",
    "supplier_fund_value": "supplier_funding_value",
    "created_at": "created_at_utc",
    "modified_at": "updated_at_utc",
}


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def combo_flag(parent: Column) -> Column:
    """A product sold inside another one."""
    return parent.isNotNull()


def orders_clean(cart: DataFrame, app: DataFrame) -> DataFrame:
    new = (
        renamed(cart, ORDER_NAMES)
        .withColumns(
            {
                "client_id": F.get_json_object("client_info", "$.client_id"),
                "session_id": F.get_json_object("client_info", "$.session_id"),
                "src": F.lit(CART),
            }
        )
        .drop("client_info")
    )
    old = renamed(app, ORDER_NAMES).withColumn("src", F.lit(APP))
    return merge_sources(new, old, ORDER_KEYS)


def order_items_clean(cart: DataFrame, app: DataFrame) -> DataFrame:
    """The flag stays NULL for the old feed, which does not know combos."""
    new = renamed(cart, ITEM_NAMES).withColumns(
        {"is_combo_product": combo_flag(F.col("parent_product_id")), "src": F.lit(CART)}
    )
    old = renamed(app, ITEM_NAMES).withColumn("src", F.lit(APP))
    return merge_sources(new, old, ITEM_KEYS)


def order_campaigns_clean(cart: DataFrame, app: DataFrame) -> DataFrame:
    new = renamed(cart, ORDER_CAMPAIGN_NAMES).withColumns(
        {"is_combo_product": combo_flag(F.col("parent_product_id")), "src": F.lit(CART)}
    )
    old = renamed(app, ORDER_CAMPAIGN_NAMES).withColumn("src", F.lit(APP))
    return merge_sources(new, old, ORDER_CAMPAIGN_KEYS)


def benefits_old_clean(raw: DataFrame) -> DataFrame:
    """Static old benefits; a missing creation time is the update time."""
    clean = renamed(raw, BENEFIT_NAMES)
    latest = latest_per_key(
        clean,
        ["country_code", "campaign_id", "sku"],
        "updated_at_utc",
        ties=["global_entity_id", "discount_value", "supplier_funding_value"],
    )
    return latest.withColumn("created_at_utc", F.coalesce("created_at_utc", "updated_at_utc"))


def benefits_merge(new_raw: DataFrame, old_clean: DataFrame) -> DataFrame:
    """The latest new row per campaign and SKU, or the old one where there is none. One rank finds
    both, so the new feed moves once."""
    new = renamed(new_raw, BENEFIT_NAMES)
    is_new = F.col("src_priority") == 1
    return priority_merge(
        [
            new.withColumns({"src": F.lit("New benefits"), "src_priority": F.lit(1)}),
            old_clean.withColumns({"src": F.lit("Old benefits"), "src_priority": F.lit(2)}),
        ],
        BENEFIT_KEYS,
        "src_priority",
        ties=["updated_at_utc", "discount_value", "supplier_funding_value", "is_deleted"],
        by=[
            F.when(is_new, F.col("updated_at_utc")).desc_nulls_last(),
            F.when(is_new, F.col("created_at_utc")).asc_nulls_last(),
        ],
    )


def triggers_old_clean(raw: DataFrame) -> DataFrame:
    """Latest row per product and vendor first, then the distinct SKUs over vendors."""
    latest = latest_per_key(raw, TRIGGER_OLD_KEYS, "modified_at", ties=["created_at", "sku"])
    return latest.select(
        "country_code",
        "global_entity_id",
        "campaign_id",
        F.coalesce("sku", "product_id").alias("sku"),
        F.col("created_at").alias("created_at_utc"),
        F.col("modified_at").alias("updated_at_utc"),
        "is_deleted",
    ).distinct()


def triggers_merge(new_clean: DataFrame, old_clean: DataFrame) -> DataFrame:
    """One row per campaign and SKU; the new source wins, then the latest update."""
    return priority_merge(
        [
            new_clean.withColumns({"src": F.lit("New triggers"), "src_priority": F.lit(1)}),
            old_clean.withColumns({"src": F.lit("Old triggers"), "src_priority": F.lit(2)}),
        ],
        BENEFIT_KEYS,
        "src_priority",
        ties=["created_at_utc"],
        by=newest_first("updated_at_utc"),
    )


def campaign_vendors_clean(raw: DataFrame) -> DataFrame:
    latest = latest_per_key(
        raw,
        ["country_code", "global_entity_id", "campaign_id", "vendor_id"],
        "updated_date",
        ties=["creation_date"],
    )
    return latest.select(
        "country_code",
        "global_entity_id",
        "campaign_id",
        F.col("vendor_id").alias("catalog_global_vendor_id"),
        F.col("creation_date").alias("created_at_utc"),
        F.coalesce("updated_date", "creation_date").alias("updated_at_utc"),
    )


# Fixed value: the entity that only carries test vendors.
TEST_ENTITIES = ("TEST_VA",)


def vendors_clean(raw: DataFrame, test_entities: tuple[str, ...] = TEST_ENTITIES) -> DataFrame:
    live = raw.where(~F.col("global_entity_id").isin(*test_entities))
    latest = latest_per_key(
        live,
        ["country_code", "global_entity_id", "vendor_id"],
        "synchronised_at",
        ties=["modified_at", "vendor_code"],
    )
    additional = uses_additional_id(F.col("global_entity_id"))
    return latest.select(
        "country_code",
        "global_entity_id",
        F.col("vendor_id").alias("catalog_global_vendor_id"),
        F.when(~additional, F.col("vendor_code")).alias("catalog_remote_vendor_id"),
        F.when(additional, F.col("vendor_code")).alias("catalog_additional_remote_vendor_id"),
        "name",
        F.col("created_at").alias("created_at_utc"),
        F.col("modified_at").alias("updated_at_utc"),
        F.col("deleted_at").alias("deleted_at_utc"),
        F.col("synchronised_at").alias("synchronized_at_utc"),
    )


def external_funding(raw: DataFrame) -> DataFrame:
    return raw.select(
        "global_entity_id",
        "country_code",
        "order_id",
        "sku",
        F.col("order_fulfilled_at").alias("order_fulfilled_at_utc"),
        "campaign_id",
        F.col("amount").alias("abs_discount_value_lt"),
    )
