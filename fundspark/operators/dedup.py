"""Keep one row per key, and merge two feeds of the same entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundspark.operators.skew import all_of


def newest_first(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]


def tie_break(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key. Catalyst prunes each task to its own first rows before the shuffle, so a
    key that holds most of the rows sends one row per task."""
    ranked = df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("__rn") == 1).drop("__rn")


def latest_per_key(
    df: DataFrame, keys: Sequence[str], by: Sequence[str] | str, ties: Sequence[str] = ()
) -> DataFrame:
    by = [by] if isinstance(by, str) else by
    return first_per_key(df, keys, [*newest_first(*by), *tie_break(*ties)])


def priority_merge(
    sources: Sequence[DataFrame],
    keys: Sequence[str],
    priority: str,
    ties: Sequence[str] = (),
    by: Sequence[Column] = (),
) -> DataFrame:
    """Union of sources, one row per key from the source with the lowest priority number.

    ``by`` orders the rows of one source, so sources need not be unique: one rank finds the source
    and its row.
    """
    union = sources[0]
    for source in sources[1:]:
        union = union.unionByName(source, allowMissingColumns=True)
    return first_per_key(union, keys, [F.col(priority).asc_nulls_last(), *by, *tie_break(*ties)])


def merge_sources(
    new: DataFrame, old: DataFrame, keys: Sequence[str], ts: str = "created_at_utc"
) -> DataFrame:
    """Merge a new and an old feed of the same entity.

    Per key the latest instant over both feeds is found. All rows a feed holds at that instant
    are paired with all rows of the other feed there, and each column is the new feed's value,
    or the old one's where that is NULL. Several rows of one feed at that instant all survive.
    A key with a NULL part pairs with nothing and keeps only key and instant.

    Both feeds go through one shuffle: the rank that finds the latest instant also leaves the
    rows partitioned and sorted for the pairing.
    """
    columns = new.columns
    tagged = new.withColumn("__new", F.lit(True)).unionByName(
        old.withColumn("__new", F.lit(False)), allowMissingColumns=True
    )
    rank = F.rank().over(Window.partitionBy(*keys).orderBy(*newest_first(ts)))
    latest = tagged.withColumn("__rank", rank).where(F.col("__rank") == 1).drop("__rank")

    complete = all_of([F.col(k).isNotNull() for k in [*keys, ts]])
    values = [c for c in columns if c not in (*keys, ts)]
    left = latest.where(complete & F.col("__new")).select(
        *keys, F.col(ts).alias("__ts_n"), *[F.col(c).alias(f"__n_{c}") for c in values]
    )
    right = latest.where(complete & ~F.col("__new")).select(
        *keys, F.col(ts).alias("__ts_o"), *[F.col(c).alias(f"__o_{c}") for c in values]
    )
    merged = left.join(right, list(keys), "full_outer").select(
        *keys,
        F.coalesce("__ts_n", "__ts_o").alias(ts),
        *[F.coalesce(f"__n_{c}", f"__o_{c}").alias(c) for c in values],
    )
    unpaired = latest.where(~complete).select(*keys, ts).dropDuplicates(list(keys))
    return merged.unionByName(unpaired, allowMissingColumns=True).select(*columns)
