"""How much of a table a Python worker is given at a time."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROWS, BYTES = 1_000, 4 << 20
SETTING = "spark.sql.execution.arrow"


@contextmanager
def bounded_batches(spark: SparkSession, rows: int = ROWS, most: int = BYTES) -> Iterator[None]:
    """Batches of at most ``rows`` rows and about ``most`` bytes for what is run inside.

    Whole texts and shingle sets are wide rows: by default a worker holds 10,000 of them, several
    times over, and so does the Arrow buffer of its executor. The session gets its settings back.
    """
    wanted = {f"{SETTING}.maxRecordsPerBatch": str(rows), f"{SETTING}.maxBytesPerBatch": str(most)}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
