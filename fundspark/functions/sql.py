"""The run calendar, the campaign subtype and the funding amount for SQL text.

Scalar and table functions of the session, written in SQL, so Catalyst inlines them. The subtype is
made from the same fixed table as the Column function.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from fundspark.functions.calendar import register_sql_functions as register_window
from fundspark.functions.classify import GOODS, SUBTYPES

RUN_PARTITIONS = """run_partitions(d DATE) RETURNS TABLE (partition_date DATE)
    RETURN SELECT day FROM (SELECT run_window_start(d) AS first, run_window_end(d) AS last)
      LATERAL VIEW explode(sequence(first, last, INTERVAL 1 DAY)) AS day"""

FUNDED_BLOCKS = """funded_blocks(quantity DOUBLE, threshold DOUBLE, most DOUBLE) RETURNS DOUBLE
    RETURN CASE WHEN nullif(most, 0) IS NULL THEN cast(floor(quantity / nullif(threshold, 0)) AS DOUBLE)
      WHEN quantity IS NULL OR nullif(threshold, 0) IS NULL THEN NULL
      ELSE least(cast(floor(quantity / threshold) AS DOUBLE), most) END"""

# What an amount is based on: nothing, the whole discount, or the contract's value by a convention.
FUNDING_BASIS = """funding_basis(
      require_discount BOOLEAN, has_discount BOOLEAN, contract_status STRING, missing_fallback STRING,
      convention STRING, unit_value DOUBLE) RETURNS STRING
    RETURN CASE
      WHEN require_discount AND NOT has_discount THEN 'nothing'
      WHEN contract_status = 'missing' AND missing_fallback IN ('skip', 'full_discount') THEN missing_fallback
      WHEN contract_status = 'explicit_zero' OR unit_value IS NULL THEN 'nothing'
      ELSE convention END"""

FUNDING_AMOUNT = """funding_amount(
      basis STRING, unit_value DOUBLE, unit_discount DOUBLE, quantity DOUBLE, threshold DOUBLE, most DOUBLE)
      RETURNS DOUBLE
    RETURN CASE basis
      WHEN 'full_discount' THEN round(unit_discount * quantity, 2)
      WHEN 'normalized' THEN round(unit_value * quantity, 2)
      WHEN 'per_benefit' THEN round(unit_value * funded_blocks(quantity, threshold, most), 2)
      ELSE 0 END"""


def subtype_function() -> str:
    branches = []
    for kind, target, discount, value, label in SUBTYPES:
        tests = [f"campaign_type = '{kind}'"]
        if target is not None:
            names = GOODS if target == "goods" else (target,)
            tests.append(f"applies_to IN ({', '.join(repr(n) for n in names)})")
        if discount is not None:
            tests.append(f"discount_type = '{discount}'")
        if value is not None:
            tests.append("discount_value = 100" if value == "full" else "discount_value < 100")
        branches.append(f"WHEN {' AND '.join(tests)} THEN '{label}'")
    return f"""campaign_subtype(campaign_type STRING, applies_to STRING, discount_type STRING,
      discount_value DOUBLE) RETURNS STRING RETURN CASE {' '.join(branches)} END"""


def register_all(spark: SparkSession) -> None:
    """Make every function of the library callable from SQL text of this session."""
    register_window(spark)
    for body in (RUN_PARTITIONS, subtype_function(), FUNDED_BLOCKS, FUNDING_BASIS, FUNDING_AMOUNT):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {body}")
