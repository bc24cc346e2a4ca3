"""Product catalog: vendor products with flags, nested catalog, and who supplies what."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.context import RunContext
from fundspark.functions.money import NUMERIC
from fundspark.operators.dedup import first_per_key, latest_per_key, newest_first, tie_break
from fundspark.operators.nested import fold, unfold
from fundspark.operators.skew import bounded_join
from fundspark.sources.schemas import CHAIN_PRODUCT_FIELDS, VENDOR_PRODUCT_FIELDS


def vendor_warehouses(warehouses: DataFrame) -> DataFrame:
    """Current vendor-warehouse pairs; a pair that was migrated away is dropped."""
    pairs = unfold(
        warehouses,
        "vendors",
        ["global_entity_id", "warehouse_id", F.col("name").alias("warehouse_name"),
         "is_dark_store", "uses_new_locations"],
    )
    return (
        pairs.where(F.col("migrated_at_utc").isNull())
        .select(
            "global_entity_id",
            "warehouse_id",
            "warehouse_name",
            "is_dark_store",
            "uses_new_locations",
            F.coalesce("platform_vendor_id", "additional_platform_vendor_id").alias(
                "platform_vendor_id"
            ),
        )
        .distinct()
    )


def latest_sales_buffer(history: DataFrame, ctx: RunContext) -> DataFrame:
    known = history.where(F.to_date("valid_from_lt") <= F.lit(ctx.as_of + timedelta(days=1)))
    latest = latest_per_key(
        known,
        ["global_entity_id", "global_catalog_id"],
        ["valid_to_utc", "valid_from_utc", "src"],
        ties=["sales_buffer"],
    )
    return latest.select("global_entity_id", "global_catalog_id", "sales_buffer")


def current_vat(history: DataFrame, ctx: RunContext) -> DataFrame:
    started = F.to_date("timestamp_valid_from") <= F.lit(ctx.as_of + timedelta(days=1))
    return history.where(started & F.col("current_flag")).select(
        "global_entity_id", "global_catalog_id", "vat_rate"
    )


def vendor_products_flags(
    vendor_products: DataFrame,
    pairs: DataFrame,
    buffers: DataFrame,
    vat: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """Vendor products with warehouse, sales buffer, VAT rate and shelf location.

    The shelf location is looked up only for warehouses on the older location system, as part of
    the join condition: the others keep their row and get no location. Vendors of stores are few, so
    products do not move for their warehouse.
    """
    product = ["global_entity_id", "global_catalog_id"]
    vp = vendor_products.withColumnRenamed("sales_buffer", "own_buffer")
    placed = bounded_join(vp, pairs, ["global_entity_id", "platform_vendor_id"], "left")
    enriched = placed.withColumns(
        {
            "warehouse_id": F.coalesce("warehouse_id", F.lit("")),
            "is_dark_store": F.coalesce("is_dark_store", F.lit(False)),
        }
    )
    enriched = enriched.join(buffers, product, "left").join(vat, product, "left")
    spots = locations.select(
        F.col("warehouse_id").alias("__warehouse"),
        F.col("catalog_product_id").alias("__product"),
        "row", "rack", "shelf", "storage_type", "location_movement_request_strategy",
    )
    located = enriched.join(
        spots,
        (F.col("warehouse_id") == F.col("__warehouse"))
        & (F.col("global_catalog_id") == F.col("__product"))
        & ~F.col("uses_new_locations"),
        "left",
    )
    buffer = F.when(
        F.col("type") == "SHOP", F.coalesce("own_buffer", "sales_buffer", F.lit(0.0))
    ).otherwise(F.coalesce("sales_buffer", F.lit(0.0)))
    return located.withColumns(
        {"sales_buffer": buffer, "vat_rate": F.col("vat_rate").cast(NUMERIC)}
    ).drop("__warehouse", "__product", "own_buffer", "uses_new_locations", "type")


# Brands that count as own brand when the vendor category says so.
OWN_BRANDS = ("EveryDay", "unbranded", "ComboProduct Brand")
CHAIN_KEYS = ["global_entity_id", "catalog_chain_product_id"]


def catalog_nested(
    chain: DataFrame, vendor_products: DataFrame, sources: DataFrame, ctx: RunContext
) -> DataFrame:
    """Chain products with their vendor products as an array.

    The chain flag is a membership test on (entity, chain), so it can never multiply products.
    """
    created_by = F.struct(
        F.col("created_by_client").alias("client"),
        F.col("created_by_component").alias("component"),
    ).alias("vendor_product_created_by")
    documents = fold(
        vendor_products,
        CHAIN_KEYS,
        "vendor_products",
        F.struct(*VENDOR_PRODUCT_FIELDS, created_by),
        split_on=["catalog_vendor_product_id", "warehouse_id"],
        flags={"has_own_brand_category": "has_own_brand_category"},
    )
    known = sources.select(
        "global_entity_id", F.col("chain_id").alias("catalog_chain_id"), F.lit(True).alias("__in")
    ).distinct()
    own_brand = F.col("is_own_brand") | (
        F.col("brand_name_english").isin(*OWN_BRANDS) & F.col("has_own_brand_category")
    )
    joined = chain.join(documents, CHAIN_KEYS, "left")
    return bounded_join(joined, known, ["global_entity_id", "catalog_chain_id"], "left").select(
        *[c for c in CHAIN_PRODUCT_FIELDS if c not in ("is_own_brand",)],
        F.coalesce("product_description_english", "product_description_local").alias(
            "product_description"
        ),
        F.coalesce("brand_name_english", "brand_name_local").alias("brand_name"),
        F.coalesce("__in", F.lit(False)).alias("is_chain_from_dark_store"),
        own_brand.alias("is_own_brand_product"),
        "vendor_products",
    )


def catalog_vendor_products(catalog: DataFrame) -> DataFrame:
    """Flat (entity, sku, vendor product) rows of the nested catalog."""
    return unfold(catalog, "vendor_products", ["global_entity_id", "sku"])


def catalog_latest_by_vendor(catalog: DataFrame, entities: DataFrame) -> DataFrame:
    """Newest chain product per entity, SKU, warehouse and vendor, with a sorted barcode list."""
    barcodes = F.array_sort(F.array_distinct(F.transform("barcodes", lambda b: b["barcode"])))
    kept = bounded_join(catalog, entities, ["global_entity_id"])
    placed = kept.select(
        "global_entity_id", "country_code", "sku", "product_name", "brand_name",
        "master_product_created_at_utc", "chain_product_created_at_utc", "master_categories",
        F.array_join(barcodes, ",").alias("barcodes"),
        F.explode("vendor_products").alias("vp"),
    ).where("vp.warehouse_id IS NOT NULL AND vp.warehouse_id <> ''")
    flat = placed.select(
        "vp.warehouse_id", "vp.platform_vendor_id", "global_entity_id", "country_code", "sku",
        "product_name", "brand_name", "barcodes", "master_product_created_at_utc",
        "chain_product_created_at_utc", F.explode_outer("master_categories").alias("mc"),
    ).select(
        "*", F.col("mc.master_category_names.level_one").alias("category_level_one")
    ).drop("mc")
    newest = first_per_key(
        flat,
        ["global_entity_id", "sku", "warehouse_id", "platform_vendor_id"],
        [
            *newest_first("chain_product_created_at_utc"),
            *tie_break("category_level_one", "product_name", "country_code"),
        ],
    )
    return newest.drop("chain_product_created_at_utc")


PRODUCT_KEYS = ["global_entity_id", "country_code", "sku"]


def dc_mapping(replenishment: DataFrame, product_suppliers: DataFrame) -> DataFrame:
    """Distribution centre to the warehouses it serves, per product."""
    products = product_suppliers.select(*PRODUCT_KEYS).distinct()
    served = replenishment.where(F.col("dc_warehouse_id").isNotNull())
    served = served.select("country_code", "sku", "dc_warehouse_id", "warehouse_id").distinct()
    return served.join(products, ["country_code", "sku"]).select(
        *PRODUCT_KEYS, "dc_warehouse_id", "warehouse_id"
    )


def supplier_per_warehouse(
    product_suppliers: DataFrame, dc: DataFrame, entities: DataFrame
) -> DataFrame:
    """Suppliers per warehouse; a delivery to a distribution centre counts for the warehouses it
    serves instead.

    One left join gives both branches: without a match the warehouse stands for itself. The
    same supplier reaching a warehouse directly and through a centre gives two rows.
    """
    flat = unfold(
        unfold(
            bounded_join(product_suppliers, entities, ["global_entity_id"]),
            "suppliers",
            PRODUCT_KEYS,
        ).where("NOT is_supplier_deleted AND supplier_id IS NOT NULL"),
        "warehouses",
        [*PRODUCT_KEYS, "supplier_id"],
    ).where(F.col("warehouse_id").isNotNull())
    routes = dc.withColumnsRenamed({"warehouse_id": "served_id", "dc_warehouse_id": "warehouse_id"})
    routed = flat.join(routes, [*PRODUCT_KEYS, "warehouse_id"], "left")
    return (
        routed.select(
            *PRODUCT_KEYS,
            "supplier_id",
            F.coalesce("served_id", "warehouse_id").alias("warehouse_id"),
            "is_preferred_supplier",
            F.col("served_id").isNotNull().alias("via_dc"),
        )
        .distinct()
        .drop("via_dc")
    )


def preferred_supplier(suppliers: DataFrame) -> DataFrame:
    """One supplier per product and warehouse, the preferred one first.

    The age of the product cannot decide between suppliers of the same product in the same
    warehouse, so the catalog is not joined; equal suppliers are ordered by id.
    """
    best = first_per_key(
        suppliers,
        [*PRODUCT_KEYS, "warehouse_id"],
        [*newest_first("is_preferred_supplier"), *tie_break("supplier_id")],
    )
    return best.select(*PRODUCT_KEYS, "supplier_id", "warehouse_id")


def product_supplier_master(
    catalog_latest: DataFrame, preferred: DataFrame, crm: DataFrame
) -> DataFrame:
    """Catalog rows with supplier and CRM names; the numeric supplier id meets a string there.

    The catalog side is unique per product, warehouse and vendor, so repeated CRM accounts are
    the only possible repeats; they are removed before the join instead of after it.
    """
    place = [*PRODUCT_KEYS, "warehouse_id"]
    named = crm.select(
        "global_entity_id",
        "country_code",
        F.col("supplier_id").alias("__portal_id"),
        "global_supplier_id",
        "supplier_name",
    ).distinct()
    supplied = catalog_latest.join(preferred, place, "left").withColumn(
        "__portal_id", F.col("supplier_id").cast("string")
    )
    return supplied.join(named, ["global_entity_id", "country_code", "__portal_id"], "left").select(
        "global_entity_id", "country_code", "supplier_id", "global_supplier_id", "supplier_name",
        "sku", "product_name", "brand_name", "category_level_one", "barcodes", "warehouse_id",
        "platform_vendor_id", "master_product_created_at_utc",
    )
