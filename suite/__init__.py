"""Queries over the test tables with an independent SQL text for each."""

from __future__ import annotations

from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from suite.model import QUERIES, Inputs

for _module in ("feeds", "campaigns", "catalog", "lines", "funding", "quality", "curated"):
    import_module(f"suite.{_module}")

QUERY_NAMES = list(QUERIES)
ORACLES = {name: q.oracle for name, q in QUERIES.items() if q.oracle}


def run_query(name: str, spark: SparkSession, sf_dir: str, store: str | None = None) -> DataFrame:
    return QUERIES[name].build(Inputs(spark, sf_dir, store))
