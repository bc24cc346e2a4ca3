"""Money arithmetic with explicit NULL and zero handling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(38,9)"


def strict_least(*cols: Column) -> Column:
    """Smallest argument, NULL as soon as one argument is NULL."""
    known = reduce(lambda a, b: a & b, [c.isNotNull() for c in cols])
    return F.when(known, F.least(*cols))


def coalesce_zero(*cols: Column) -> Column:
    return F.coalesce(*cols, F.lit(0.0))


def convert(amount: Column, rate: Column) -> Column:
    """Local currency to EUR. NULL without a rate; a zero rate is an error."""
    return amount / rate


def net_of_vat(gross: Column, vat_percent: Column) -> Column:
    return gross / (1 + coalesce_zero(vat_percent) / 100)


def funded_blocks(quantity: Column, threshold: Column, limit: Column) -> Column:
    """Completed benefit blocks, at most ``limit`` (0 or NULL: unlimited).

    A NULL or zero threshold has no block size, so the result is NULL.
    """
    blocks = F.floor(quantity / F.nullif(threshold.cast("double"), F.lit(0.0))).cast("double")
    return strict_least(blocks, F.coalesce(F.nullif(limit.cast("double"), F.lit(0.0)), blocks))


def funding_amount(
    *,
    require_discount: Column,
    has_discount: Column,
    contract_status: Column,
    missing_fallback: Column,
    convention: Column,
    unit_value: Column,
    unit_discount: Column,
    quantity: Column,
    threshold: Column,
    limit: Column,
) -> Column:
    """What the supplier owes for one order line. The first rule that applies decides."""
    missing = contract_status == "missing"
    nothing = F.lit(0.0)
    rules = [
        (require_discount & ~has_discount, nothing),
        (missing & (missing_fallback == "skip"), nothing),
        (missing & (missing_fallback == "full_discount"), F.round(unit_discount * quantity, 2)),
        (contract_status == "explicit_zero", nothing),
        (unit_value.isNull(), nothing),
        (convention == "normalized", F.round(unit_value * quantity, 2)),
        (
            convention == "per_benefit",
            F.round(unit_value * funded_blocks(quantity, threshold, limit), 2),
        ),
    ]
    (first, amount), *rest = rules
    decision = F.when(first, amount)
    for condition, value in rest:
        decision = decision.when(condition, value)
    return decision.otherwise(nothing)
