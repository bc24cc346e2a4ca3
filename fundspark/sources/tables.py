"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundspark.sources.schemas import align
from fundspark.sources.versions import has_version, read_version, replace_version


def read_table(
    spark: SparkSession, path: str, ddl: str | None = None, version: int | None = None
) -> DataFrame:
    """Full scan of a Parquet table, optionally brought to a declared schema.

    Of a table that ``replace_table`` wrote, the newest version, or the one asked for.
    """
    df = read_version(spark, path, version) if has_version(spark, path) else spark.read.parquet(path)
    return align(df, ddl) if ddl else df


def read_partitions(
    spark: SparkSession, path: str, column: str, bounds: tuple[date, date] | None
) -> DataFrame:
    """Scan of a date-partitioned table that refuses to run without a partition range."""
    if bounds is None:
        raise ValueError(f"{path}: a range of {column} is required")
    low, high = bounds
    return spark.read.parquet(path).where(F.col(column).between(F.lit(low), F.lit(high)))


def parameter_table(spark: SparkSession, values: Sequence[str], name: str) -> DataFrame:
    """A list parameter as a one-column table."""
    schema = T.StructType([T.StructField(name, T.StringType())])
    return spark.createDataFrame([(v,) for v in values], schema)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], ddl: str) -> DataFrame:
    return spark.createDataFrame(list(rows), T.StructType.fromDDL(ddl))


def enabled_entities(spark: SparkSession, entities: Sequence[str]) -> DataFrame:
    return parameter_table(spark, entities, "global_entity_id")


def replace_table(
    df: DataFrame, path: str, *, cluster_by: Sequence[str] = (), ddl: str | None = None
) -> int:
    """Replace a table at once; returns the number of its new version.

    Until the last step readers see the old rows, also if writing fails. With ``cluster_by`` readers
    that filter on these keys skip files.
    """
    return replace_version(align(df, ddl) if ddl else df, path, cluster_by=cluster_by)


def shared_view(
    df: DataFrame, columns: Sequence[str], entities: Sequence[str], name: str | None = None
) -> DataFrame:
    """Published projection: fixed columns, rows of some entities only."""
    view = df.where(F.col("global_entity_id").isin(*entities)).select(*columns)
    if name:
        view.createOrReplaceTempView(name)
    return view
