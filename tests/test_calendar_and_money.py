from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from fundspark.functions.calendar import date_series, run_window, run_window_dates
from fundspark.functions.money import funding_amount, strict_least

WINDOWS = [
    (date(2025, 7, 16), date(2025, 7, 7), date(2025, 7, 13)),
    (date(2025, 7, 1), date(2025, 6, 30), date(2025, 7, 31)),
    (date(2025, 9, 1), date(2025, 8, 25), date(2025, 8, 31)),
    (date(2025, 9, 8), date(2025, 9, 1), date(2025, 9, 7)),
    (date(2025, 8, 4), date(2025, 8, 1), date(2025, 8, 3)),
    (date(2024, 2, 29), date(2024, 2, 19), date(2024, 2, 25)),
    (date(2024, 2, 1), date(2024, 1, 29), date(2024, 2, 29)),
    (date(2024, 12, 1), date(2024, 11, 25), date(2024, 12, 31)),
]


@pytest.mark.parametrize(("day", "start", "end"), WINDOWS)
def test_run_window_golden(day, start, end):
    assert run_window_dates(day) == (start, end)


def test_column_and_plain_window_agree(spark):
    days = [(date(2023, 12, 25) + timedelta(days=i),) for i in range(800)]
    rows = run_window(spark.createDataFrame(days, "input_date date")).collect()
    for r in rows:
        assert (r.filter_start_date, r.filter_end_date) == run_window_dates(r.input_date)


def test_date_series_is_empty_when_reversed(spark):
    df = spark.createDataFrame(
        [(date(2024, 1, 1), date(2024, 1, 3)), (date(2024, 1, 3), date(2024, 1, 1))],
        "a date, b date",
    )
    assert [len(r[0]) for r in df.select(date_series(F.col("a"), F.col("b"))).collect()] == [3, 0]


def amount(spark, **values):
    given = dict(
        require_discount=True, has_discount=True, contract_status="configured",
        missing_fallback="skip", convention="normalized", unit_value=0.5, unit_discount=1.0,
        quantity=10.0, threshold=3.0, limit=1.0,
    )
    given.update(values)
    types = {"unit_value": "double", "threshold": "double", "limit": "double"}
    columns = {k: F.lit(v).cast(types[k]) if k in types else F.lit(v) for k, v in given.items()}
    return spark.range(1).select(funding_amount(**columns)).first()[0]


def test_funding_amount_worked_examples(spark):
    block = dict(convention="per_benefit", unit_value=2.0, quantity=8.0)
    assert amount(spark) == 5.0
    assert amount(spark, **block) == 2.0
    assert amount(spark, **block, limit=0.0) == 4.0
    assert amount(spark, **block, threshold=None) is None
    assert amount(spark, has_discount=False) == 0.0
    assert amount(spark, contract_status="missing") == 0.0
    assert amount(spark, contract_status="missing", missing_fallback="full_discount") == 10.0
    assert amount(spark, contract_status="explicit_zero") == 0.0
    assert amount(spark, unit_value=None) == 0.0
    assert amount(spark, convention="other") == 0.0


def test_strict_least(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(strict_least(F.col("a"), F.col("b"))).collect()] == [1.0, None]
