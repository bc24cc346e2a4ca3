"""Bounded training samples that are the same on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 2**40


def hashed_sample(rows: DataFrame, keys: str | Sequence[str], size: int, seed: int) -> DataFrame:
    """About ``size`` rows, those with the smallest hashes of ``keys``; all if there are fewer.

    Rows that repeat all keys count once, so no row that stands very often fills the sample, and
    the number exceeds ``size`` by more than 10 % about never. The rows are counted first; repeats
    go before the shuffle, and no task sees more than its own.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    total = rows.count()
    if total > size:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(SCALE)) < SCALE * size // total)
    return rows.dropDuplicates(keys)
