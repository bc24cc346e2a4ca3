"""Run parameters and the session settings the operators rely on."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime, time, timedelta

from pyspark.sql import SparkSession

# Settings the operators count on. Skewed join partitions are split at run time, also where joins
# on one key follow each other without a shuffle between them: such a chain moves its rows once
# more, but only if a skewed partition was measured. On write only the partitions present in a
# batch are replaced.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Recording the Python call site of every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "fundspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@dataclass(frozen=True)
class RunContext:
    """Everything a run is told from outside. Nothing below reads the clock.

    ``as_of`` is the run date. ``date_in``/``date_fin`` bound the rule-driven funding run.
    ``backfill`` without a range means the whole table; with a range, that range.
    """

    as_of: date
    date_in: date | None = None
    date_fin: date | None = None
    lookback_days: int = 7
    backfill: bool = False
    backfill_start: date | None = None
    backfill_end: date | None = None
    entities: tuple[str, ...] = ()
    excluded_warehouses: tuple[str, ...] = ()
    excluded_vendors: tuple[str, ...] = ()
    # Campaign names matching the pattern are left out, for that entity only.
    name_exclusion_entity: str | None = None
    name_exclusion_pattern: str | None = None
    # Product and price versions that started earlier are ignored, if a run asks for it.
    history_start: date | None = None
    # The one entity whose quantities are sold in weight steps.
    weight_step_entity: str | None = None
    # Width of the time slices that as-of joins add to their key.
    asof_bucket_days: int = 365
    match_bucket_days: int = 64
    # A product with more lines in a run is dealt to several tasks.
    hot_rows: int = 2_000_000

    # When the run started, as its caller says; midnight of the run date without.
    started_at: datetime | None = None

    @property
    def load_time(self) -> datetime:
        return self.started_at or datetime.combine(self.as_of, time(0), UTC)

    @property
    def window(self) -> tuple[date, date]:
        """Closed ``(start, end)`` of the campaigns this run concludes."""
        from fundspark.functions.calendar import run_window_dates

        return run_window_dates(self.as_of)

    @property
    def funding_start(self) -> date:
        return self.date_in or date(self.as_of.year, 1, 1)

    @property
    def funding_end(self) -> date:
        return self.date_fin or self.as_of

    def stream_range(self, pad_before: int = 0, pad_after: int = 0) -> tuple[date, date] | None:
        """Partition dates this run reads, or None for the whole table."""
        if not self.backfill:
            first = self.as_of - timedelta(days=self.lookback_days + pad_before)
            return first, self.as_of + timedelta(days=pad_after)
        if self.backfill_start is None or self.backfill_end is None:
            return None
        return (
            self.backfill_start - timedelta(days=pad_before),
            self.backfill_end + timedelta(days=pad_after),
        )

    @property
    def asof_bounds(self) -> tuple[date, date] | None:
        """Dates the facts of this run lie in; sets how as-of joins slice time.

        A run over the whole table without dates gets the ten years up to the run date; older
        facts share the first slice.
        """
        if (stream := self.stream_range(1, 1)) is not None:
            return stream
        ten_years_ago = self.as_of - timedelta(days=3652)
        return self.date_in or ten_years_ago, self.date_fin or self.as_of
