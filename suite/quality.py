"""Data checks, published views and partition refresh."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fundspark.operators.lineage import shared_folder
from fundspark.operators.quality import (
    no_duplicates,
    no_nulls,
    statement_true,
    unique_by_concat,
)
from fundspark.sources.tables import shared_view
from fundspark.streaming.refresh import read_refreshed, refresh_partitions
from suite.model import register

NULL_COLUMNS = ["country_code", "order_item_id", "parent_product_id", "subtotal"]


@register(
    "dq_no_nulls",
    " union all ".join(
        f"select '{c}' as column_name, count(*) - count({c}) as violations,"
        f" count(*) = count({c}) as passed from f_cart_items"
        for c in NULL_COLUMNS
    ),
)
def _(x):
    return no_nulls(x("f_cart_items"), NULL_COLUMNS)


@register(
    "dq_no_duplicates",
    """select count(*) as duplicate_keys, cast(coalesce(sum(n - 1), 0) as bigint) as surplus_rows,
      count(*) = 0 as passed
    from (select count(*) as n from f_cart_items group by country_code, order_id, product_id
      having count(*) > 1) as repeated""",
)
def _(x):
    return no_duplicates(x("f_cart_items"), ["country_code", "order_id", "product_id"])


KEY = ["country_code", "order_id", "product_id"]


@register(
    "dq_statement_true",
    """select 'item_key' as check_name, (select count(*) from (
        select distinct country_code, order_id, product_id, coalesce(parent_product_id, 'null')
        from f_cart_items) as keys) = (select count(*) from f_cart_items) as passed""",
)
def _(x):
    statement = unique_by_concat(KEY, ["parent_product_id"])
    return statement_true(x("f_cart_items"), statement, "item_key")


@register(
    "entity_country_view",
    """select country_code, campaign_id, campaign_name, state from f_campaigns
    where global_entity_id in ('PY_N0', 'EF_AT')""",
)
def _(x):
    columns = ["country_code", "campaign_id", "campaign_name", "state"]
    return shared_view(x("f_campaigns"), columns, ["PY_N0", "EF_AT"])


@register(
    "refresh_partitions",
    """select order_id, cast(date_trunc('month', order_date) as date) as order_month,
      case when date_trunc('month', order_date) = date '1998-05-01' then 2 else 1 end as load_no
    from f_order_heads""",
)
def _(x):
    month = F.trunc("order_date", "month").alias("order_month")
    rows = x("f_order_heads").select("order_id", month)
    path = f"{shared_folder(x.spark)}/refresh-{uuid.uuid4().hex}"
    refresh_partitions(rows.withColumn("load_no", F.lit(1)), path, "order_month")
    may = rows.where(F.col("order_month") == "1998-05-01")
    refresh_partitions(may.withColumn("load_no", F.lit(2)), path, "order_month")
    return read_refreshed(x.spark, path).select("order_id", "order_month", "load_no")
