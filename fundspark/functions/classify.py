"""Campaign classification and identifier routing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Audience kinds the promo tool knows by name, and spellings of the generic type.
NAMED_AUDIENCES = ("RETURNING", "ALL", "SUBSCRIBED_USER", "NEW_USER")
GENERIC_TYPES = ("Generic", "GENERIC", "OldFashioned Campaign Type")

# Campaign type, what it applies to, discount type, discount value, subtype.
# "goods" stands for PRODUCTS or CHEAPEST_PRODUCTS, None for "any".
GOODS = ("PRODUCTS", "CHEAPEST_PRODUCTS")
SUBTYPES = (
    ("Strikethrough", "goods", "ABSOLUTE", None, "Strikethrough $"),
    ("Strikethrough", "goods", "PERCENTAGE", None, "Strikethrough %"),
    ("SameItemBundle", "goods", "PERCENTAGE", "full", "Multibuy: Same Item - Free Item"),
    ("SameItemBundle", "goods", "PERCENTAGE", "part", "Multibuy: Same Item %"),
    ("SameItemBundle", "goods", "ABSOLUTE", None, "Multibuy: Same Item $"),
    ("SameItemBundle", "DELIVERY_FEE", None, None, "Multibuy: Same Item - Delivery Fee Discount"),
    ("MixAndMatch", "goods", "PERCENTAGE", "full", "Multibuy: Mix & Match - Free Item"),
    ("MixAndMatch", "goods", "PERCENTAGE", "part", "Multibuy: Mix & Match %"),
    ("MixAndMatch", "goods", "ABSOLUTE", None, "Multibuy: Mix & Match $"),
    ("MixAndMatch", "DELIVERY_FEE", None, None, "Multibuy: Mix & Match - Delivery Fee Discount"),
    ("BasketValue", "DELIVERY_FEE", None, None, "Basket Discount - Delivery"),
    ("BasketValue", "goods", "PERCENTAGE", "full", "Basket Discount - Free Item"),
    ("BasketValue", "BASKET", "PERCENTAGE", None, "Basket Discount %"),
    ("BasketValue", "BASKET", "ABSOLUTE", None, "Basket Discount $"),
    ("Generic", None, None, None, "Generic"),
)

# Entity prefixes whose vendor code is the additional remote id (`_` is a wildcard).
ADDITIONAL_ID_PREFIXES = ("PY_%", "TB_%", "HS_%")


def campaign_subtype(
    campaign_type: Column, applies_to: Column, discount_type: Column, discount_value: Column
) -> Column:
    """Subtype by the first matching row of SUBTYPES, NULL if none matches."""

    def matches(kind, target, discount, value) -> Column:
        tests = [campaign_type == kind]
        if target is not None:
            tests.append(applies_to.isin(*GOODS) if target == "goods" else applies_to == target)
        if discount is not None:
            tests.append(discount_type == discount)
        if value is not None:
            tests.append(discount_value == 100.0 if value == "full" else discount_value < 100.0)
        return reduce(lambda a, b: a & b, tests)

    return F.coalesce(*[F.when(matches(*rule), F.lit(label)) for *rule, label in SUBTYPES])


def normal_campaign_type(raw: Column) -> Column:
    return F.when(raw.isin(*GENERIC_TYPES), F.lit("Generic")).otherwise(raw)


def audience(raw: Column) -> tuple[Column, Column]:
    """Audience kind and, for a segment, its id."""
    is_segment = ~raw.isin(*NAMED_AUDIENCES)
    return F.when(is_segment, F.lit("SEGMENT_USER")).otherwise(raw), F.when(is_segment, raw)


def uses_additional_id(entity: Column) -> Column:
    return reduce(lambda a, b: a | b, [entity.like(p) for p in ADDITIONAL_ID_PREFIXES])


def country_of(entity: Column) -> Column:
    """Country code from an entity id such as ``AB_CD``; an id without `_` is an error."""
    return F.lower(F.split(entity, "_")[1])
