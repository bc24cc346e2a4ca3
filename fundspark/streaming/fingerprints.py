"""Which partitions changed since the last load, however late their rows came.

A partition's fingerprint is its number of rows and a sum of row hashes that no order or file layout
affects. Only partitions whose fingerprint differs are loaded again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundspark.sources.versions import has_version, read_version, replace_version
from fundspark.streaming.refresh import refresh_partitions


def fingerprints(rows: DataFrame, partition_column: str) -> DataFrame:
    """``partition, row_count, hash_sum, hash_mix``; one row per partition, sums per task first.

    Two sums of independent 64-bit hashes: equal for different rows with a chance of 2**-128 or so.
    """
    columns = sorted(rows.columns)
    one, two = F.xxhash64(*columns), F.xxhash64(F.lit("mix"), *columns)
    digits = "decimal(28,0)"
    return rows.groupBy(F.col(partition_column).alias("partition")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(one.cast(digits)).alias("hash_sum"),
        F.sum(two.cast(digits)).alias("hash_mix"),
    )


def changed_partitions(current: DataFrame, stored: DataFrame) -> DataFrame:
    """``partition, change``: ``new``, ``changed`` or ``gone`` against the stored fingerprints."""
    marks = ["row_count", "hash_sum", "hash_mix"]
    now = current.select(F.col("partition").alias("__p"), F.struct(*marks).alias("__now"))
    then = stored.select(F.col("partition").alias("__q"), F.struct(*marks).alias("__then"))
    both = now.join(then, F.col("__p").eqNullSafe(F.col("__q")), "full_outer")
    change = (
        F.when(F.col("__then").isNull(), "new")
        .when(F.col("__now").isNull(), "gone")
        .when(F.col("__now") != F.col("__then"), "changed")
    )
    found = both.select(F.coalesce("__p", "__q").alias("partition"), change.alias("change"))
    return found.where(F.col("change").isNotNull())


def refresh_changed(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    partition_column: str,
    marks_path: str,
    *,
    sort_by: Sequence[str] = (),
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Load exactly the partitions of ``rows`` that differ from the last load; returns which.

    The new fingerprints are published after the partitions are written: a run that ends before
    loads the same partitions again. A partition that is gone from the source is kept and reported;
    whoever runs this decides. ``extra`` columns are written but no part of the fingerprint, as a
    load stamp is. The list of changed partitions is bounded by the partitions of the
    table.
    """
    current = fingerprints(rows, partition_column)
    if has_version(spark, marks_path):
        stored = read_version(spark, marks_path)
    else:
        stored = spark.createDataFrame([], current.schema)
    current_path = f"{marks_path}/pending"
    current.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(current_path)
    current = spark.read.schema(current.schema).parquet(current_path)
    changes = changed_partitions(current, stored).collect()
    reload = [row["partition"] for row in changes if row["change"] != "gone"]
    if reload:
        known = [p for p in reload if p is not None]
        wanted = F.col(partition_column).isin(known)
        if len(known) < len(reload):
            wanted = wanted | F.col(partition_column).isNull()
        loaded = rows.where(wanted).withColumns(dict(extra or {}))
        refresh_partitions(loaded, path, partition_column, sort_by=sort_by)
    gone = [row["partition"] for row in changes if row["change"] == "gone"]
    kept = stored.where(F.col("partition").isin(gone)) if gone else None
    replace_version(current.unionByName(kept) if kept is not None else current, marks_path)
    return spark.createDataFrame(
        [(row["partition"], row["change"]) for row in changes],
        f"partition {current.schema['partition'].dataType.simpleString()}, change string",
    )
