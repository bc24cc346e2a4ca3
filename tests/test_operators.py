"""Operators against brute force, with hot keys, NULL keys and boundary instants."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fundspark.context import RunContext
from fundspark.operators.dedup import merge_sources
from fundspark.operators.lineage import materialise
from fundspark.operators.nested import fold, fold_many, unfold
from fundspark.operators.quality import no_nulls
from fundspark.operators.rules import country_rules
from fundspark.operators.skew import bounded_join, lookup_join
from fundspark.operators.temporal import asof_join, scd2_from_events
from fundspark.sources.tables import read_partitions, replace_table
from fundspark.streaming.refresh import read_refreshed, refresh_partitions

T0 = datetime(2020, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def merge_by_hand(new, old, keys):
    """Key spine at the latest instant, each feed paired on key and instant."""
    spine = {}
    for r in new + old:
        key = tuple(r[k] for k in keys)
        spine[key] = max(spine.get(key, datetime.min), r["ts"])
    out = []
    for key, ts in spine.items():
        def at(feed):
            if None in key:
                return [None]
            hits = [r for r in feed if tuple(r[k] for k in keys) == key and r["ts"] == ts]
            return hits or [None]

        for n in at(new):
            for o in at(old):
                value = n["v"] if n and n["v"] is not None else (o["v"] if o else None)
                out.append((*key, ts, value))
    return sorted(out, key=str)


def test_merge_sources_matches_the_definition(spark):
    rng = random.Random(7)

    def feed(n):
        return [
            {
                "k": rng.choice(["hot", "hot", "a", "b", "c", None]),
                "p": rng.randint(0, 3),
                "ts": T0 + timedelta(days=rng.randint(0, 2)),
                "v": rng.choice([None, 1, 2, 3]),
            }
            for _ in range(n)
        ]

    new, old = feed(40), feed(40)
    ddl = "k string, p int, ts timestamp, v int"
    frames = [
        spark.createDataFrame([(r["k"], r["p"], r["ts"], r["v"]) for r in f], ddl)
        for f in (new, old)
    ]
    merged = merge_sources(*frames, ["k", "p"], ts="ts").select("k", "p", "ts", "v")
    assert rows(merged) == merge_by_hand(new, old, ["k", "p"])


def test_merge_is_idempotent_and_keeps_combo_rows(spark):
    ddl = "o string, p string, parent string, ts timestamp"
    data = [("1", "A1", "A", T0), ("1", "A2", "A", T0), ("1", "A1", None, T0)]
    df = spark.createDataFrame(data, ddl)
    once = merge_sources(df, df.limit(0), ["o", "p"], ts="ts")
    assert rows(once) == rows(df)
    assert rows(merge_sources(once, df.limit(0), ["o", "p"], ts="ts")) == rows(once)


@pytest.mark.parametrize("slice_by", ["month", None])
def test_scd2_intervals_do_not_overlap(spark, slice_by):
    rng = random.Random(3)
    days = sorted(rng.sample(range(900), 120))
    data = [("hot", T0 + timedelta(days=d)) for d in days]
    data += [("x", T0), ("y", T0 + timedelta(days=5)), ("y", T0 + timedelta(days=300))]
    events = spark.createDataFrame(data, "k string, ts timestamp")
    got = scd2_from_events(events, ["k"], "ts", valid_to="end", slice_by=slice_by).collect()
    for key in ("hot", "x", "y"):
        mine = sorted((r.ts, r.end) for r in got if r.k == key)
        assert [e for _, e in mine] == [s for s, _ in mine[1:]] + [datetime(2030, 1, 1)]


@pytest.mark.parametrize("closed", ["left", "both"])
@pytest.mark.parametrize("bucket_days", [None, 10, 400])
def test_asof_join_matches_brute_force(spark, closed, bucket_days):
    rng = random.Random(11)
    facts = [
        (i, rng.choice(["hot", "hot", "a", None]), T0 + timedelta(days=rng.randint(-30, 400)))
        for i in range(150)
    ]
    history = []
    for i in range(60):
        start = T0 + timedelta(days=rng.randint(-60, 380))
        history.append((rng.choice(["hot", "hot", "a"]), start, start + timedelta(days=rng.randint(-3, 90)), i))
    got = asof_join(
        spark.createDataFrame(facts, "id int, k string, ts timestamp"),
        spark.createDataFrame(history, "k string, f timestamp, t timestamp, v int"),
        {"k": "k"},
        "ts",
        valid_from="f",
        valid_to="t",
        values={"v": "v"},
        closed=closed,
        bounds=(date(2020, 1, 1), date(2020, 12, 31)),
        bucket_days=bucket_days,
    ).select("id", "v")
    expected = []
    for i, k, ts in facts:
        hits = [
            v for hk, f, t, v in history
            if hk == k and f <= ts and (ts <= t if closed == "both" else ts < t)
        ]
        expected += [(i, v) for v in hits or [None]]
    assert rows(got) == sorted(expected, key=str)


def test_hot_document_stays_one(spark):
    data = [("hot", i) for i in range(9500)] + [("cold", i) for i in range(5)] + [(None, 1)]
    df = spark.createDataFrame(data, "k string, v int").withColumn("w", F.when(F.col("v") > 2, F.col("v")))
    folded = fold(df, ["k"], "items", F.struct("v"), split_on=["v"])
    assert {r.k: len(r["items"]) for r in folded.collect()} == {"hot": 9500, "cold": 5, None: 1}
    assert rows(unfold(folded, "items", ["k"])) == rows(df.select("k", "v"))
    sparse = fold(df, ["k"], "items", F.col("w"), split_on=["v"])
    assert {r.k: r["items"] for r in sparse.where("k is null or k = 'cold'").collect()} == {None: [], "cold": [3, 4]}


def test_fold_many_keeps_every_child(spark):
    a = spark.createDataFrame([("p", f"s{i}", i) for i in range(40)], "k string, sku string, x int")
    b = spark.createDataFrame([("p", "v1"), ("q", "v2")], "k string, sku string")
    folded = fold_many(
        {"a": (a, ["sku", "x"]), "b": (b, ["sku"])}, ["k"], split_on="sku"
    )
    assert rows(unfold(folded, "a", ["k"])) == rows(a)
    assert rows(unfold(folded, "b", ["k"])) == rows(b)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_bounded_join_gives_the_same_beyond_its_bound(spark, how):
    left = spark.createDataFrame([(i % 3, i) for i in range(60)], "k int, v int")
    right = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c")], "k int, w string")
    expected = rows(left.join(right, ["k"], how))
    assert rows(bounded_join(left, right, ["k"], how)) == expected
    assert rows(bounded_join(left, right, ["k"], how, max_rows=2, salts=5)) == expected


def test_lookup_join_keeps_null_keys(spark):
    left = spark.createDataFrame([(1, "e", "c1"), (2, "e", None), (3, "e", "zz")], "id int, e string, c string")
    right = spark.createDataFrame([("e", "c1", "root")], "e string, c string, r string")
    got = lookup_join(left, right, ["e", "c"], ["e", "c"], ["id"]).select("id", "r")
    assert rows(got) == [(1, "root"), (2, None), (3, None)]


def test_two_active_rules_for_one_entity_are_an_error(spark):
    rules = spark.createDataFrame([("E", True), ("E", True)], "global_entity_id string, is_active boolean")
    with pytest.raises(ValueError, match="more than one active"):
        country_rules(rules)


def test_unknown_column_in_a_check_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown columns"):
        no_nulls(spark.range(1), ["created_date"])


def test_refresh_replaces_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    ddl = "d date, v int"
    one, two = date(2024, 1, 1), date(2024, 1, 2)
    refresh_partitions(spark.createDataFrame([(one, 1), (two, 2)], ddl), path, "d")
    later = spark.createDataFrame([(two, 5)], ddl).withColumn("note", F.lit("n"))
    refresh_partitions(later, path, "d", sort_by=["v"])
    got = read_refreshed(spark, path).select("d", "v", "note")
    assert rows(got) == [(one, 1, None), (two, 5, "n")]
    with pytest.raises(ValueError, match="required"):
        read_partitions(spark, path, "d", None)
    assert read_partitions(spark, path, "d", (one, one)).count() == 1


def test_replace_and_materialise_keep_rows(spark, tmp_path):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    replace_table(df, str(tmp_path / "r"), cluster_by=["k"])
    assert spark.read.parquet(str(tmp_path / "r")).count() == 100
    assert materialise(df, "numbers").count() == 100


def test_stream_ranges():
    ctx = RunContext(as_of=date(2024, 3, 10))
    assert ctx.stream_range() == (date(2024, 3, 3), date(2024, 3, 10))
    assert ctx.stream_range(1, 1) == (date(2024, 3, 2), date(2024, 3, 11))
    assert RunContext(as_of=date(2024, 3, 10), backfill=True).stream_range() is None


def skewed_joins(df):
    """Sort-merge joins of the executed plan that were split at run time."""
    frame = df.select("*")
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin(skew=true)")


def test_chained_asof_joins_are_split_at_a_hot_product(spark):
    """Four in five facts are of one product; both joins of a chain on one key are split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        product = F.when(F.col("id") % 5 < 4, F.lit(0)).otherwise(F.col("id") % 97).cast("int")
        moment = F.timestamp_seconds(F.lit(1_577_836_800) + F.col("id") % 86_400)
        facts = spark.range(0, 200_000, 1, 8).select(
            F.col("id").alias("line"), product.alias("product"), moment.alias("at")
        )
        history = spark.range(97).select(
            F.col("id").cast("int").alias("product"),
            F.lit(datetime(2019, 1, 1)).alias("valid_from_utc"),
            F.lit(datetime(2021, 1, 1)).alias("valid_to_utc"),
            (F.col("id") * 2).alias("value"),
        )
        out = facts
        for name in ("one", "two"):
            out = asof_join(out, history, {"product": "product"}, "at", values={name: "value"})
        assert out.where("one = product * 2 and two = product * 2").count() == 200_000
        assert skewed_joins(out) == 2
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_run_over_the_whole_table_slices_its_asof_joins():
    ctx = RunContext(as_of=date(2024, 3, 10), backfill=True)
    assert ctx.asof_bounds == (date(2014, 3, 11), date(2024, 3, 10))
