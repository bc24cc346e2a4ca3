"""Exact top-k inner products by columnar branch and bound.

Candidates lie in vertical layout, one matrix per block of dimensions. A query adds up its product
block by block. What the blocks still to come can add is bounded by the product of the remaining
norms, so after each block every candidate has a lower and an upper bound; those whose upper bound
is below the k-th best lower bound go, and the survivors are compacted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.llm.vectors import best_per_query, matrix, query_vectors, valid_vectors

ROWS, QUERIES, BLOCKS = 16_384, 4_096, 8
FOUND = "query_id long, vec_id long, score long"
_LONG = np.iinfo(np.int64)


def quantise(vectors: np.ndarray, scale: float) -> np.ndarray:
    """Whole numbers ``floor(scale * x)``, held as doubles."""
    return np.floor(scale * vectors)


class Columns:
    """Candidates in vertical layout with the norms that remain after each block."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, blocks: int = BLOCKS):
        self.ids = ids
        # Dimensions with much mass first, so that bounds close early.
        order = np.argsort(-(vectors**2).sum(axis=0), kind="stable")
        self.dimensions = np.array_split(order, min(blocks, len(order)))
        self.parts = [np.ascontiguousarray(vectors[:, d]) for d in self.dimensions]
        mass = np.array([(part**2).sum(axis=1) for part in self.parts])
        after = np.cumsum(mass[::-1], axis=0)[::-1]
        self.remaining = [np.sqrt(after[b + 1]) for b in range(len(self.parts) - 1)]

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and products of the k best candidates other than ``own``; ties to smaller ids."""
        alive = np.flatnonzero(self.ids != own)
        partial = np.zeros(len(alive))
        for b, (part, dimensions) in enumerate(zip(self.parts, self.dimensions, strict=True)):
            q = query[dimensions]
            partial = partial + (part if len(alive) == len(part) else part[alive]) @ q
            if b == len(self.parts) - 1 or len(alive) <= k:
                continue
            rest = np.sqrt((query[np.concatenate(self.dimensions[b + 1 :])] ** 2).sum())
            bound = self.remaining[b][alive] * rest
            # A little slack covers the rounding of the norms.
            bound += 1e-9 * (bound + np.abs(partial)) + 0.5
            least = np.partition(partial - bound, len(alive) - k)[len(alive) - k]
            keep = partial + bound >= least
            if not keep.all():
                alive, partial = alive[keep], partial[keep]
        order = np.lexsort((self.ids[alive], -partial))[:k]
        return self.ids[alive[order]], partial[order]


def _exact(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int):
    """The same in unbounded whole numbers, for components whose products outgrow doubles."""
    whole = [int(x) for x in query]
    scores = [
        (-min(max(sum(a * int(b) for a, b in zip(whole, v, strict=True)), _LONG.min), _LONG.max), i)
        for i, v in zip(ids.tolist(), vectors, strict=True)
        if i != own
    ]
    best = sorted(scores)[:k]
    return np.array([i for _, i in best], np.int64), np.array([-s for s, _ in best], object)


def _cell(k: int, scale: float):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))]
        if len(queries) and len(rows):
            asked, ids = quantise(matrix(queries["v"]), scale), rows["id"].to_numpy()
            vectors = quantise(matrix(rows["v"]), scale)
            largest = np.abs(asked).max() * np.abs(vectors).max() * vectors.shape[1]
            columns = Columns(vectors, ids) if largest < 2**52 else None
            for own, query in zip(queries["id"], asked, strict=True):
                if columns:
                    found, score = columns.best(query, own, k)
                else:
                    found, score = _exact(vectors, ids, query, own, k)
                out.append((np.full(len(found), own), found, score.astype(np.int64)))
        query_id, vec_id, score = map(np.concatenate, zip(*out, strict=True))
        return pd.DataFrame({"query_id": query_id, "vec_id": vec_id, "score": score})

    return run


def top_products(
    table: DataFrame,
    *,
    k: int = 10,
    every: int = 100,
    scale: float = 1024.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every query row the k largest integer products.

    Queries are the rows whose id is divisible by ``every``. Queries and rows are cut into blocks
    that meet once each; a block of rows is at most about ``ROWS`` long, so no task grows with the
    table. Rows with a NULL id, or a vector that is NULL, empty or holds NULL or non-finite
    components, take no part; a query meets the rows of its own length only. Rows that repeat an
    id are candidates each, but never for the query of their id. Scores beyond 64 bits are held at
    the limit. No rows: an empty result.
    """
    rows = valid_vectors(table, id_col, vector_col, zero=True).withColumn("size", F.size("v"))
    asked = query_vectors(rows, F.col("id") % every == 0).withColumn("size", F.size("v"))
    count, queries = rows.count(), asked.count()
    down, across = max(1, -(-count // ROWS)), max(1, -(-queries // QUERIES))
    hashed = F.xxhash64("id")
    left = asked.withColumn("across", F.pmod(hashed, F.lit(across))).withColumn(
        "down", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))
    )
    right = rows.withColumn("down", F.pmod(F.xxhash64("id", "v"), F.lit(down)).cast("int"))
    right = right.withColumn("across", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    left = left.withColumn("across", F.col("across").cast("int"))
    key = ["size", "down", "across"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_cell(k, scale), FOUND)
    return best_per_query(found, k, F.desc("score"))
