"""Whole runs over the small test tables."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from fundspark.plans import funding_v1, funding_v2
from suite import ORACLES, QUERY_NAMES, run_query
from suite.check import TABLES, rows_of
from suite.funding import Run
from suite.model import FULL, MONTHLY

SF = "/root/testdata/sf0.001"
CHECKED = ["run_window", "merge_sources_items", "campaigns_nested", "supplier_statement", "billing"]


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, database, name):
    df = run_query(name, spark, SF)
    cursor = database.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert mine == rows_of(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERY_NAMES) == set(ORACLES)


def test_grid_and_interval_give_the_same_funding(inputs):
    run = Run(inputs)
    grid = funding_v2.daily_grid(run.contracts, run.warehouses, run.rules)
    by_grid = funding_v2.match_funding_by_grid(run.lines, grid, run.rules)
    resolved = funding_v2.with_funding_amount(funding_v2.resolve_overlaps(by_grid))
    direct = funding_v2.with_funding_amount(run.resolved)
    columns = ["order_id", "sku", "funding_campaign_id", "funding_unit_value", "funding_total_lc"]
    a, b = resolved.select(*columns), direct.select(*columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_billing_sums_up_to_order_funding(inputs):
    run = funding_v2.run_funding_v2(
        funding_v2.FundingV2Inputs(
            rules=inputs("f_rules"),
            campaigns=inputs("f_campaigns"),
            benefits=inputs("f_benefits"),
            campaign_vendors=inputs("f_campaign_vendors"),
            catalog=inputs.catalog,
            orders=inputs.orders,
            product_master=inputs("f_master"),
        ),
        FULL,
    )
    billed = run["billing"].agg(F.sum("total_funding_v2_lc")).first()[0]
    funded = run["order_funding"].where(
        "funding_amount_lc > 0 AND (campaign_end_date IS NULL"
        " OR campaign_end_date BETWEEN '1995-01-01' AND '2001-12-31')"
    )
    rules = inputs("f_rules").select("global_entity_id", "param_billing_period")
    # An amount without a campaign has no billing month where the campaign's end decides.
    kept = funded.join(rules, "global_entity_id").where(
        "param_billing_period = 'order_date' OR campaign_end_date IS NOT NULL"
    )
    assert billed == pytest.approx(kept.agg(F.sum("funding_amount_lc")).first()[0], abs=0.5)


def test_v1_run_produces_statements(spark, inputs):
    run = funding_v1.run_funding_v1(
        funding_v1.FundingV1Inputs(
            campaigns=inputs("f_campaigns"),
            catalog=inputs.catalog,
            product_suppliers=inputs.product_suppliers,
            replenishment=inputs("f_replenishment"),
            crm=inputs("f_crm"),
            orders=inputs.orders,
            entities=inputs.entities,
        ),
        MONTHLY,
    )
    total = run["sku_funding"].agg(F.sum("supplier_funded_amount_lc")).first()[0] or 0.0
    skus = run["statements"].select(F.explode("campaigns").alias("c")).select(
        F.explode("c.skus").alias("s")
    )
    nested = skus.agg(F.sum("s.supplier_funded_amount_lc")).first()[0] or 0.0
    assert nested == pytest.approx(total)
