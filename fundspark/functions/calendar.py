"""Run calendar: which campaigns and which sink partitions one run date covers."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def run_window_columns(day: Column) -> dict[str, Column]:
    """Flags and bounds of the run window for a date column.

    Month start that is no Monday: this week's Monday up to the last day of the month.
    Monday among days 2-7 of a month: the 1st up to yesterday. Any other day: last week.
    """
    monday = F.trunc(day, "week")
    dom = F.dayofmonth(day)
    is_monday = F.weekday(day) == 0
    month_start = (dom == 1) & ~is_monday
    first_monday = is_monday & dom.between(2, 7)
    return {
        "is_first_of_month_not_monday": month_start,
        "is_first_monday_after_first": first_monday,
        "filter_start_date": F.when(month_start, monday)
        .when(first_monday, F.trunc(day, "month"))
        .otherwise(F.date_sub(monday, 7)),
        "filter_end_date": F.when(month_start, F.last_day(day)).otherwise(
            F.when(first_monday, F.date_sub(day, 1)).otherwise(F.date_sub(monday, 1))
        ),
    }


def run_window(dates: DataFrame, day: str = "input_date") -> DataFrame:
    return dates.withColumns(run_window_columns(F.col(day)))


def run_window_dates(day: date) -> tuple[date, date]:
    """The same window for one run date, as plain dates that Catalyst folds into literals."""
    monday = day - timedelta(days=day.weekday())
    if day.day == 1 and day != monday:
        next_month = (day.replace(day=28) + timedelta(days=4)).replace(day=1)
        return monday, next_month - timedelta(days=1)
    if day == monday and 2 <= day.day <= 7:
        return day.replace(day=1), day - timedelta(days=1)
    return monday - timedelta(days=7), monday - timedelta(days=1)


def date_series(start: Column, end: Column) -> Column:
    """Array of the dates from start to end; empty instead of an error when start > end."""
    return F.when(start <= end, F.sequence(start, end)).otherwise(F.array().cast("array<date>"))


def run_partitions(dates: DataFrame, day: str = "input_date") -> DataFrame:
    """One row per run date and sink partition the run replaces."""
    window = run_window_columns(F.col(day))
    series = date_series(window["filter_start_date"], window["filter_end_date"])
    return dates.withColumn("partition_date", F.explode(series))


SQL_FUNCTIONS = {
    "run_window_start": """(d DATE) RETURNS DATE RETURN CASE
        WHEN day(d) = 1 AND weekday(d) <> 0 THEN trunc(d, 'week')
        WHEN day(d) BETWEEN 2 AND 7 AND weekday(d) = 0 THEN trunc(d, 'month')
        ELSE date_sub(trunc(d, 'week'), 7) END""",
    "run_window_end": """(d DATE) RETURNS DATE RETURN CASE
        WHEN day(d) = 1 AND weekday(d) <> 0 THEN last_day(d)
        WHEN day(d) BETWEEN 2 AND 7 AND weekday(d) = 0 THEN date_sub(d, 1)
        ELSE date_sub(trunc(d, 'week'), 1) END""",
}


def register_sql_functions(spark: SparkSession) -> None:
    """Make the run window callable from SQL text."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
