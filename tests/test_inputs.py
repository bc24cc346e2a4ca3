"""How the input tables are derived: the same rows as their texts say, without moving wide rows."""

from __future__ import annotations

import re
from datetime import datetime

import pytest

from suite.fixtures import FIXTURES, direct_inputs
from suite.model import BASE, Inputs

DDL = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_brand string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string",
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Repeated customers, parts and nations; lines without part or supplier."""
    day = datetime(1998, 5, 1)
    rows = {
        "region": [(0, "A"), (1, "B")],
        "nation": [(0, "x", 0), (3, "y", 1), (3, "y", 1), (4, "z", None)],
        "customer": [(k, (0, 3, 3, 4, None)[k % 5]) for k in range(90)] + [(1, 3)],
        "supplier": [(k, f"s{k}", 0) for k in range(7)] + [(2, "other", 0)],
        "part": [(k, f"p{k}", f"b{k % 3}") for k in range(12)] + [(5, "twin", None), (5, "p5", "b2")],
        "orders": [
            (k, k % 95 if k % 17 else None, "FOP"[k % 3], 10.0 * k, day, "1") for k in range(200)
        ],
        "lineitem": [
            (k % 200, k % 12 if k % 19 else None, k % 7 if k % 23 else None, 1 + k % 7, 1.0 + k % 5,
             3.0 * (1 + k % 11), (k % 4) / 10, 0.1, "ANR"[k % 3])
            for k in range(900)
        ],
    }
    folder = tmp_path_factory.mktemp("tables")
    for name, ddl in DDL.items():
        spark.createDataFrame(rows[name], ddl).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def plainly(spark, folder: str, name: str):
    """A table straight from the texts."""
    for table in direct_inputs(FIXTURES[name]):
        plainly(spark, folder, table)
    for table in BASE:
        if re.search(rf"\b{table}\b", FIXTURES[name]):
            spark.read.parquet(f"{folder}/{table}.parquet").createOrReplaceTempView(table)
    rows = spark.sql(FIXTURES[name])
    rows.createOrReplaceTempView(name)
    return rows


DERIVED = [
    "f_sales", "f_order_heads", "f_pair", "f_assort", "f_slots", "f_crm", "f_suppliers_flat", "f_master",
    "f_catalog", "f_items", "f_locations", "f_chain_products",
]


@pytest.mark.parametrize("name", DERIVED)
def test_derived_tables_are_what_their_texts_say(spark, tables, name):
    found, wanted = Inputs(spark, tables)(name), plainly(spark, tables, name)
    assert found.columns == wanted.columns
    assert wanted.count() > 0
    assert found.exceptAll(wanted).count() == 0 and wanted.exceptAll(found).count() == 0


def test_wide_rows_are_not_dealt_again(spark, tables):
    """Documents are grouped where their narrow rows were dealt to, not by fixed numbers of tasks."""
    x = Inputs(spark, tables)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        dealt_by = {"catalog": "n, pkey", "product_suppliers": "n, pkey", "orders": "l_orderkey"}
        for document, keys in dealt_by.items():
            plan = getattr(x, document)._jdf.queryExecution().executedPlan().toString()
            assert "RoundRobin" not in plan and "InMemoryTableScan" not in plan
            first = re.sub(r"#\d+L?", "", plan[plan.index("Exchange ") :].splitlines()[0])
            assert f"hashpartitioning({keys}, " in first
            assert document == "orders" or "REPARTITION_BY_NUM" in first  # not merged by narrow size
    finally:
        spark.conf.unset(threshold)
