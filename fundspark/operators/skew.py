"""Joins and groupings that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundspark.operators.lineage import materialise

SALTS = 64


def is_small(df: DataFrame, max_rows: int) -> bool:
    """True when df has at most max_rows rows; every task sends one number."""
    return df.count() <= max_rows


def bounded_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    max_rows: int = 100_000,
    salts: int = SALTS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join to a right side that is expected to be small, on keys with few distinct values.

    Measured small: broadcast, so the left side is not shuffled at all. Otherwise the few keys
    are spread over ``salts`` sub-keys by repeating the right side, so that one country or one
    currency never becomes one task. ``counted`` is what to measure instead of the right side, a
    table it was derived from without adding rows: counting a stored table reads no rows.
    """
    on = list(on)
    if is_small(right if counted is None else counted, max_rows):
        return left.join(F.broadcast(right), on, how)
    others = [c for c in left.columns if c not in on]
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int"))
    copies = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "__salt"], how).drop("__salt")


def of_few_keys(
    tables: Sequence[DataFrame], facts: DataFrame, on: Mapping[str, str], *, max_rows: int = 1_000_000
) -> list[DataFrame]:
    """Of lookup tables the rows whose key occurs in ``facts``, if these have few keys; else all.

    ``on`` maps fact columns to columns of the tables. A run over few days then moves the versions of
    what was sold in them instead of all that are known. Hashes of the keys are broadcast, at most
    16 MB; a row that only shares its hash with a key stays, so no row that could match is lost.
    """
    types = [facts.schema[c].dataType for c in on]
    keys = facts.select(F.xxhash64(*on).alias("__wanted")).distinct()
    keys = materialise(keys, "wanted-keys")
    if not is_small(keys, max_rows):
        return list(tables)
    return [
        rows.withColumn("__wanted", F.xxhash64(*on.values()))
        .join(F.broadcast(keys), "__wanted", "left_semi")
        .select(*rows.columns)
        if [rows.schema[c].dataType for c in on.values()] == types
        else rows
        for rows in tables
    ]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    spread_by: Sequence[str],
) -> DataFrame:
    """Left join to a lookup table when many left rows have a NULL in the last key.

    Such rows match nothing, yet a shuffle would send all of them to one task. They get a hash
    of ``spread_by`` as a second key part instead, which no right row carries.
    """
    spread = F.when(F.col(left_keys[-1]).isNull(), F.xxhash64(*spread_by)).otherwise(F.lit(0))
    lhs = left.withColumn("__spread", spread)
    values = [c for c in right.columns if c not in right_keys]
    rhs = right.select(
        *[F.col(k).alias(f"__r{i}") for i, k in enumerate(right_keys)],
        F.lit(0).cast("bigint").alias("__r_spread"),
        *[F.col(c).alias(c) for c in values],
    )
    conditions = [lhs[k] == rhs[f"__r{i}"] for i, k in enumerate(left_keys)]
    joined = lhs.join(rhs, all_of([*conditions, lhs["__spread"] == rhs["__r_spread"]]), "left")
    return joined.select(*[lhs[c] for c in left.columns], *[rhs[c] for c in values])


def hot_keys(facts: DataFrame, key: str, hot_rows: int) -> DataFrame:
    """``key, __parts``: keys with more than ``hot_rows`` rows, and how many parts they make.

    At most rows / hot_rows keys, whatever the data. Counted with a partial count per task.
    """
    counted = facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    parts = F.ceil(F.col("__n") / F.lit(hot_rows)).cast("int")
    return counted.where(F.col("__n") > hot_rows).select(key, parts.alias("__parts"))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
