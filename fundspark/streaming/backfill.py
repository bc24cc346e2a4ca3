"""Backfill of a long range in chunks, with a ledger of finished ones.

A chunk's partitions are replaced first and entered in the ledger afterwards. A run that ends in
between writes that chunk once more and with the same result; chunks in the ledger are not touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundspark.context import RunContext
from fundspark.streaming.refresh import refresh_partitions

DAY = timedelta(days=1)
LEDGER = "job string, version string, first_date date, last_date date, attempt string"


@dataclass(frozen=True, order=True)
class Chunk:
    """Closed range of partition dates."""

    first: date
    last: date


def open_chunks(wanted: Chunk, finished: Iterable[Chunk], days: int) -> list[Chunk]:
    """What of ``wanted`` is not finished yet, in chunks of at most ``days`` days, in time order.

    Finished ranges may have been cut differently, overlap, or reach beyond the wanted one.
    """
    if days < 1:
        raise ValueError("a chunk has at least one day")
    gaps, start = [], wanted.first
    for done in sorted(finished):
        if done.last < start or done.first > wanted.last:
            continue
        if done.first > start:
            gaps.append(Chunk(start, done.first - DAY))
        start = max(start, done.last + DAY)
    if start <= wanted.last:
        gaps.append(Chunk(start, wanted.last))
    chunks = []
    for gap in gaps:
        first = gap.first
        while first <= gap.last:
            last = min(first + (days - 1) * DAY, gap.last)
            chunks.append(Chunk(first, last))
            first = last + DAY
    return chunks


class Ledger:
    """Table of finished chunks: one small file per entry, only ever added to."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)

    def entries(self) -> DataFrame:
        return self.spark.read.schema(LEDGER).parquet(self.path)

    def finished(self, job: str, version: str) -> list[Chunk]:
        """At most one row per chunk of this job comes to the driver."""
        own = self.entries().where((F.col("job") == job) & (F.col("version") == version))
        rows = own.select("first_date", "last_date").distinct().collect()
        return [Chunk(row["first_date"], row["last_date"]) for row in rows]

    def enter(self, job: str, version: str, chunk: Chunk) -> None:
        row = (job, version, chunk.first, chunk.last, uuid.uuid4().hex)
        self.spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").parquet(self.path)


def run_backfill(
    build: Callable[[RunContext], DataFrame],
    ctx: RunContext,
    *,
    path: str,
    partition_column: str,
    ledger: Ledger,
    job: str,
    version: str = "1",
    chunk_days: int = 31,
    sort_by: Iterable[str] = (),
) -> list[Chunk]:
    """Load ``ctx.backfill_start`` to ``ctx.backfill_end`` chunk by chunk; returns the chunks written.

    ``build`` gets the context of one chunk and returns its rows; rows outside the chunk are
    refused, they would replace partitions that another chunk owns. ``version`` names the definition
    of the table: after a change all chunks are open again.
    """
    if not ctx.backfill or ctx.backfill_start is None or ctx.backfill_end is None:
        raise ValueError("a chunked backfill needs a range")
    wanted = Chunk(ctx.backfill_start, ctx.backfill_end)
    chunks = open_chunks(wanted, ledger.finished(job, version), chunk_days)
    for chunk in chunks:
        rows = build(replace(ctx, backfill_start=chunk.first, backfill_end=chunk.last))
        day = F.col(partition_column)
        inside = F.coalesce(day.between(F.lit(chunk.first), F.lit(chunk.last)), F.lit(False))
        message = F.concat(F.lit(f"outside {chunk.first} to {chunk.last}: "), F.coalesce(day.cast("string"), F.lit("NULL")))
        kept = rows.withColumn(partition_column, F.when(inside, day).otherwise(F.raise_error(message).cast("date")))
        refresh_partitions(kept, path, partition_column, sort_by=list(sort_by))
        ledger.enter(job, version, chunk)
    return chunks
