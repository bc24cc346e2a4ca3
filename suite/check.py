"""Compare queries with their SQL on DuckDB: ``python -m suite.check SF [NAME ...]``."""

from __future__ import annotations

import sys
import time

import duckdb

from fundspark.context import build_session
from suite import ORACLES, QUERY_NAMES, run_query

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, float):
        return f"{value:.6g}" if value == value else "nan"
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, int):
        return f"{float(value):.6g}" if abs(value) > 10**9 else str(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> str:
    start = time.time()
    df = run_query(name, spark, sf_dir)
    mine = rows_of(df.columns, [tuple(r) for r in df.collect()])
    spark_time = time.time() - start
    if name not in ORACLES:
        return f"rows {len(mine)} (no SQL) {spark_time:.1f}s"
    start = time.time()
    cursor = con.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    theirs = rows_of(columns, cursor.fetchall())
    timing = f"{spark_time:.1f}s / {time.time() - start:.1f}s"
    if sorted(df.columns) != sorted(columns):
        differ = set(df.columns) ^ set(columns)
        return f"COLUMNS DIFFER {sorted(differ)}"
    if mine == theirs:
        return f"ok {len(mine)} rows {timing}"
    in_mine, in_theirs = set(mine), set(theirs)
    only_mine = [r for r in mine if r not in in_theirs]
    only_theirs = [r for r in theirs if r not in in_mine]
    names = sorted(columns)
    return (
        f"DIFFER {len(mine)} vs {len(theirs)} {timing}\n  columns {names}\n"
        f"  spark {len(only_mine)} {only_mine[:3]}\n  sql   {len(only_theirs)} {only_theirs[:3]}"
    )


def main() -> None:
    scale, *names = sys.argv[1:]
    sf_dir = f"/root/testdata/{scale}"
    spark = build_session(
        "check",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    for name in names or QUERY_NAMES:
        try:
            print(name, compare(spark, con, name, sf_dir), flush=True)
        except Exception as error:
            print(name, "ERROR", type(error).__name__, str(error)[:1500], flush=True)


if __name__ == "__main__":
    main()
