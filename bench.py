"""Time the headline queries on already derived tables and print one JSON line.

The derived inputs are written once to a fresh folder, as the tables a run would read; writing
them is not timed. Every query is planned and executed in full, without sending rows to the
driver. Planning time, with the size probes some operators run, is part of the figure. Each figure
is the median of RUNS warm runs, after one that is not counted.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from fundspark.context import build_session  # noqa: E402
from suite import QUERIES  # noqa: E402
from suite.fixtures import BASE, FIXTURES, needed  # noqa: E402
from suite.model import Inputs  # noqa: E402

HEADLINE = [
    "run_partitions", "merge_sources_orders", "merge_sources_items", "campaigns_clean",
    "benefits_merge", "campaigns_nested", "order_line_campaigns", "orders_nested_promos",
    "vat_asof", "order_lines_curated", "supplier_statement", "campaigns_utilised", "match_funding",
    "order_funding", "billing",
]
RUNS = 2


def derive(spark, sf_dir: str, store: str, names: list[str]) -> None:
    """Write the derived tables of these queries once; later ones read the earlier ones."""
    files = spark.sparkContext.defaultParallelism
    for table in BASE:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    documents = {"f_catalog", "f_items", "f_promo_flat"}
    wanted = needed(" ".join([*documents, *[QUERIES[n].oracle or "" for n in names]]))
    for name in wanted:
        spark.sql(FIXTURES[name]).repartition(files).write.parquet(f"{store}/{name}")
        spark.read.parquet(f"{store}/{name}").createOrReplaceTempView(name)
    flat = Inputs(spark, sf_dir, store)
    for name in ("catalog", "orders", "promo_orders"):
        document = getattr(flat, f"build_{name}")()
        document.repartition(files).write.parquet(f"{store}/{name}")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    store = tempfile.mkdtemp(prefix="bench-")
    started = time.time()
    derive(spark, sf_dir, store, names)
    print(f"derived inputs in {time.time() - started:.0f}s", file=sys.stderr)
    seconds = {}
    warm_up = Inputs(spark, sf_dir, store)("f_items")
    warm_up.groupBy("global_entity_id").count().write.format("noop").mode("overwrite").save()
    for name in names:
        runs = []
        for _ in range(RUNS + 1):
            start = time.time()
            inputs = Inputs(spark, sf_dir, store)
            QUERIES[name].build(inputs).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
