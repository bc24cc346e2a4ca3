"""What the vector searches share: valid rows, query rows, the best k per query."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def valid_vectors(table: DataFrame, id_col: str, vector_col: str, *, zero: bool) -> DataFrame:
    """``id, v``: rows with an id and a non-empty vector of finite components.

    ``zero`` tells whether vectors of zeros take part.
    """
    rows = table.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & (F.size("v") > 0) & finite)
    return rows if zero else rows.where(F.exists("v", lambda x: x != 0))


def query_vectors(rows: DataFrame, is_query: Column) -> DataFrame:
    """One vector per query id; of rows that repeat an id, the smallest vector."""
    return rows.where(is_query).groupBy("id").agg(F.min("v").alias("v"))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def best_per_query(found: DataFrame, k: int, score: Column) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k first by ``score``, ties to the smaller vec_id."""
    window = Window.partitionBy("query_id").orderBy(score, "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
