"""What runs leave behind and how they go on after a loss; as-of by merge and carry."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from functools import reduce

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundspark.context import RunContext
from fundspark.functions.sql import register_all
from fundspark.operators.lines import sales_buffer_asof
from fundspark.operators.nested import fold
from fundspark.operators.quality import TableChecks, checked_table
from fundspark.operators.skew import hot_keys
from fundspark.operators.temporal import History, _in_slices, asof_join, carry_asof, dense_keys
from fundspark.sources.catalogs import SchemaDrift, read_contracted, resolve
from fundspark.sources.tables import read_table, replace_table
from fundspark.sources.versions import expire_versions, read_version, versions
from fundspark.sources.views import publish_to_groups, publish_view, undeclared
from fundspark.streaming.backfill import Chunk, Ledger, open_chunks, run_backfill
from fundspark.streaming.fingerprints import changed_partitions, fingerprints, refresh_changed
from fundspark.streaming.refresh import read_refreshed

START = datetime(2020, 1, 1)
FACTS = "id int, product string, seller string, ship string, at timestamp"
VERSIONS = "entity string, product string, start timestamp, stop timestamp, v int"


def random_facts(rng, n):
    products = ["p0"] * 6 + [f"p{i}" for i in range(6)] + [None]
    return [
        (i, rng.choice(products), rng.choice("ab"), rng.choice(["a", "b", None]),
         rng.choice([None, *[START + timedelta(hours=rng.randint(0, 3000)) for _ in range(9)]]))
        for i in range(n)
    ]


def random_history(rng):
    """Versions without overlaps, some with gaps between them, some empty, some of no product."""
    rows = []
    for entity in "ab":
        for product in [*(f"p{i}" for i in range(6)), None]:
            at = START + timedelta(hours=rng.randint(0, 500))
            for n in range(rng.randint(0, 8)):
                stop = at + timedelta(hours=rng.choice([0, 5, 300, 700]))
                rows.append((entity, product, at, stop, n if n % 4 else None))
                at = stop + timedelta(hours=rng.choice([0, 0, 50]))
    return rows


def three_histories(spark, seed=1):
    rng = random.Random(seed)
    facts = spark.createDataFrame(random_facts(rng, 400), FACTS)
    tables = [spark.createDataFrame(random_history(rng), VERSIONS) for _ in range(3)]
    keys = [{"seller": "entity", "product": "product"}, {"ship": "entity", "product": "product"}]
    histories = [
        History(table, keys[i % 2], {f"v{i}": "v"}, valid_from="start", valid_to="stop")
        for i, table in enumerate(tables)
    ]
    return facts, histories


SLICES = {"bounds": (date(2020, 1, 1), date(2020, 5, 1)), "bucket_days": 20}


@pytest.mark.parametrize("sliced", [{}, SLICES])
@pytest.mark.parametrize("hot_rows", [None, 10])
def test_carry_equals_the_chain_of_joins(spark, sliced, hot_rows):
    facts, histories = three_histories(spark)
    hot = hot_keys(facts, "product", hot_rows) if hot_rows else None
    found = carry_asof(facts, histories, "at", common="product", spread_by=["id"], hot=hot, **sliced)
    chain = facts
    for h in histories:
        live = h.rows.where("start < stop")
        chain = asof_join(chain, live, h.on, "at", valid_from="start", valid_to="stop", values=h.values, **sliced)
    assert found.columns == chain.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, chain.collect()))
    assert carry_asof(facts.limit(0), histories, "at", common="product", spread_by=["id"], **sliced).count() == 0


@pytest.mark.parametrize("most", [0, 5, 1_000])
def test_only_keys_with_many_versions_are_cut_into_slices(spark, most):
    """The same rows whichever keys are cut; versions of the others move once, not once per slice."""
    facts, histories = three_histories(spark)
    by_product = reduce(DataFrame.unionAll, [h.rows.select("product") for h in histories])
    dense = dense_keys(by_product, ["product"], most)
    settings = {"common": "product", "spread_by": ["id"], **SLICES}
    whole = carry_asof(facts, histories, "at", **settings)
    assert sorted(map(str, carry_asof(facts, histories, "at", dense=dense, **settings).collect())) == sorted(
        map(str, whole.collect())
    )
    for h in histories:
        join = {"valid_from": "start", "valid_to": "stop", "values": h.values, "closed": "both", **SLICES}
        every = asof_join(facts, h.rows, h.on, "at", **join)
        cut = dense_keys(h.rows, list(h.on.values()), most)
        found = asof_join(facts, h.rows, h.on, "at", dense=cut, **join)
        assert found.columns == every.columns
        assert sorted(map(str, found.collect())) == sorted(map(str, every.collect()))


def test_versions_of_ordinary_products_move_once(spark):
    """Ten years in slices of one: a version is one row before it moves, not ten; a dense key's are cut."""
    history = spark.range(300).selectExpr(
        "cast(id as string) as global_catalog_id", "'a' as global_entity_id",
        "timestamp'2019-01-01 00:00:00' as valid_from_utc", "timestamp'2031-01-01 00:00:00' as valid_to_utc",
        "timestamp'2019-01-01 00:00:00' as valid_from_lt", "cast(id as double) as sales_buffer",
    )
    keys, ctx = ["global_entity_id", "global_catalog_id"], RunContext(as_of=date(2029, 12, 31), date_in=date(2020, 1, 1), backfill=True)
    for most, rows in ((1, 300), (0, 300 * 11)):
        cut = _in_slices(
            history, keys, "valid_from_utc", F.col("valid_to_utc"), dense_keys(history, keys, most),
            ctx.asof_bounds, ctx.asof_bucket_days, "slot",
        )
        assert cut.count() == rows
    facts = spark.range(300).selectExpr(
        "cast(id as string) as global_catalog_id", "'a' as global_entity_id", "timestamp'2024-01-01 00:00:00' as order_created_at_utc"
    )
    found = sales_buffer_asof(facts, history, ctx)
    assert found.where("sales_buffer = cast(global_catalog_id as double)").count() == 300
    assert "__dense" in found._jdf.queryExecution().optimizedPlan().toString()


def test_facts_move_once_for_all_histories(spark):
    facts, histories = three_histories(spark)
    carried = carry_asof(facts, histories, "at", common="product", spread_by=["id"], **SLICES)
    plan = carried._jdf.queryExecution().executedPlan().toString()
    above, _, _ = plan.partition("Union")
    assert above.count("Exchange") == 1 and "REPARTITION_BY_COL" in above and above.count("Window") >= 2


@pytest.fixture
def partitions_as_dealt(spark):
    """Small partitions are not put together, skewed ones not split."""
    names = [f"spark.sql.adaptive.{name}.enabled" for name in ("coalescePartitions", "skewJoin")]
    for name in names:
        spark.conf.set(name, "false")
    yield
    for name in names:
        spark.conf.set(name, "true")


def test_a_hot_product_is_dealt_to_several_tasks(spark, partitions_as_dealt):
    """Four facts in five on one product; no skew setting of the session has a part in it."""
    facts = spark.range(20_000).selectExpr(
        "cast(id as int) as id", "if(id % 5 < 4, 'hot', concat('p', id % 50)) as product", "'a' as seller",
        "'a' as ship", "timestamp'2020-01-01 00:00:00' + make_interval(0, 0, 0, 0, id % 700) as at",
    )
    rows = [("a", "hot", START, START + timedelta(hours=400), 1), ("a", "hot", START + timedelta(hours=400), datetime(2030, 1, 1), 2)]
    history = History(spark.createDataFrame(rows, VERSIONS), {"seller": "entity", "product": "product"}, {"v": "v"}, "start", "stop")
    hot = hot_keys(facts, "product", 1_000)
    assert [tuple(r) for r in hot.collect()] == [("hot", 16)]
    found = carry_asof(facts, [history], "at", common="product", spread_by=["id"], hot=hot)
    by_task = found.where("product = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(by_task) >= 3 and max(r["count"] for r in by_task) < 12_000
    wrong = found.where("product = 'hot' and v <> if(at < timestamp'2020-01-17 16:00:00', 1, 2)")
    assert wrong.count() == 0 and found.where("product = 'hot' and v is null").count() == 0
    assert found.count() == 20_000


# --- backfill -----------------------------------------------------------------------------------------


def day(n):
    return date(2020, 1, 1) + timedelta(days=n)


def test_open_chunks():
    wanted = Chunk(day(0), day(9))
    assert open_chunks(wanted, [], 4) == [Chunk(day(0), day(3)), Chunk(day(4), day(7)), Chunk(day(8), day(9))]
    done = [Chunk(day(4), day(7)), Chunk(day(-5), day(0)), Chunk(day(6), day(6)), Chunk(day(50), day(60))]
    assert open_chunks(wanted, done, 4) == [Chunk(day(1), day(3)), Chunk(day(8), day(9))]
    assert open_chunks(wanted, [Chunk(day(-1), day(20))], 4) == []
    with pytest.raises(ValueError):
        open_chunks(wanted, [], 0)


def test_a_lost_backfill_goes_on_where_it_was(spark, tmp_path):
    source = spark.range(100).select(F.col("id").alias("row"), F.date_add(F.lit(day(0)), (F.col("id") % 20).cast("int")).alias("day"))
    ctx = RunContext(as_of=day(30), backfill=True, backfill_start=day(0), backfill_end=day(19))
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    settings = {"path": str(tmp_path / "t"), "partition_column": "day", "ledger": ledger, "job": "t", "chunk_days": 5}

    def load(number, lost_from=None):
        def build(chunk):
            if lost_from is not None and chunk.backfill_start >= lost_from:
                raise ConnectionError("driver lost")
            inside = F.col("day").between(F.lit(chunk.backfill_start), F.lit(chunk.backfill_end))
            return source.where(inside).withColumn("load_no", F.lit(number))

        return build

    with pytest.raises(ConnectionError):
        run_backfill(load(1, day(10)), ctx, **settings)
    assert run_backfill(load(2), ctx, **settings) == [Chunk(day(10), day(14)), Chunk(day(15), day(19))]
    stored = read_refreshed(spark, settings["path"])
    assert stored.where(f"(day < date'{day(10)}') <> (load_no = 1)").count() == 0
    assert sorted(r["row"] for r in stored.collect()) == list(range(100))
    assert run_backfill(load(3), ctx, **settings) == []
    assert len(run_backfill(load(4), ctx, version="2", **settings)) == 4
    with pytest.raises(PySparkException):  # rows of another chunk's days
        run_backfill(lambda chunk: source, ctx, version="3", **settings)
    with pytest.raises(ValueError):
        run_backfill(load(1), RunContext(as_of=day(0)), **settings)


def test_only_changed_partitions_are_loaded(spark, tmp_path):
    path, marks = str(tmp_path / "t"), str(tmp_path / "marks")
    rows = [(i, f"m{i % 4}", None if i == 2 else f"x{i}") for i in range(40)]

    def load(rows, number):
        df = spark.createDataFrame(rows, "id int, month string, text string").repartition(3)
        changes = refresh_changed(spark, df, path, "month", marks, extra={"load_no": F.lit(number)})
        return {r["partition"]: r["change"] for r in changes.collect()}

    def loads():
        return {r["month"]: r["load_no"] for r in read_refreshed(spark, path).select("month", "load_no").distinct().collect()}

    assert load(rows, 1) == {f"m{i}": "new" for i in range(4)}
    assert load(rows[::-1], 2) == {} and set(loads().values()) == {1}
    late = [*rows, (40, "m1", "late"), (41, "m9", "new month")]
    late[7] = (7, "m3", "mended")
    assert load(late, 3) == {"m1": "changed", "m3": "changed", "m9": "new"}
    assert loads() == {"m0": 1, "m1": 3, "m2": 1, "m3": 3, "m9": 3}
    assert load([r for r in late if r[1] != "m0"], 4) == {"m0": "gone"} and loads()["m0"] == 1
    twice = fingerprints(spark.createDataFrame([(1, "a"), (1, "a")], "id int, month string"), "month")
    once = fingerprints(spark.createDataFrame([(1, "a")], "id int, month string"), "month")
    assert [r["change"] for r in changed_partitions(twice, once).collect()] == ["changed"]


# --- tables -------------------------------------------------------------------------------------------


def test_a_failing_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert replace_table(spark.range(5), path) == 1
    opened = read_table(spark, path)
    broken = spark.range(1000, 1010).withColumn("id", F.when(F.col("id") > 1008, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(PySparkException):
        replace_table(broken, path)
    assert read_table(spark, path).count() == 5
    assert replace_table(spark.range(7), path, cluster_by=["id"]) == 2
    assert (opened.count(), read_table(spark, path).count(), read_version(spark, path, 1).count()) == (5, 7, 5)
    assert replace_table(read_table(spark, path).where("id > 1"), path) == 3  # a table made from itself
    assert expire_versions(spark, path, keep=1) == [1, 2] and [n for n, _ in versions(spark, path)] == [3]
    assert read_table(spark, path).count() == 5
    with pytest.raises(ValueError):
        read_version(spark, path, 1)
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    assert read_table(spark, str(tmp_path / "plain")).count() == 3


def test_clustered_files_are_skipped(spark, tmp_path, partitions_as_dealt):
    path = str(tmp_path / "t")
    rows = spark.range(20_000).selectExpr("cast(id * 7919 % 20000 as int) as key", "id")
    replace_table(rows.repartition(8), path, cluster_by=["key"])
    import glob

    import pyarrow.parquet as pq

    folder = versions(spark, path)[-1][1]
    bounds = []
    for name in glob.glob(f"{folder}/*.parquet"):
        group = pq.ParquetFile(name).metadata.row_group(0)
        stats = next(group.column(c).statistics for c in range(group.num_columns) if group.column(c).path_in_schema == "key")
        bounds.append((stats.min, stats.max))
    assert len(bounds) > 1 and sum(low <= 777 <= high for low, high in bounds) == 1


def test_checks_are_gathered_while_writing(spark):
    rows = [("a", 1, None, 5.0), ("a", 1, None, -1.0), ("a", 1, "x", None), (None, 2, "x", 1.0), ("b", None, "x", 1.0)]
    df = spark.createDataFrame(rows, "country string, id int, parent string, total double")
    checks = TableChecks(
        not_null=("country", "id"), key=("country", "id"), optional=("parent",), strict=True,
        statements={"total_not_negative": "total >= 0"},
    )
    table, report = checked_table(df, "checked", checks)
    assert sorted(map(str, table.collect())) == sorted(map(str, df.collect()))
    assert {(c, s): (n, ok) for _, c, s, n, ok in report} == {
        ("not_null", "country"): (1, False), ("not_null", "id"): (1, False),
        ("statement", "total_not_negative"): (2, False), ("unique", "country, id, parent"): (3, False),
    }
    _, clean = checked_table(df.limit(0), "empty", checks)
    assert all(ok for *_, ok in clean) and len(clean) == 4
    with pytest.raises(ValueError):
        checked_table(df, "wrong", TableChecks(not_null=("nothing",)))


def test_contracts_are_kept_or_refused(spark, tmp_path):
    roots = {"partner": str(tmp_path)}
    spark.range(3).selectExpr("id", "cast(id as string) as name", "1 as more").write.parquet(str(tmp_path / "db/t"))
    good = read_contracted(spark, "partner.db.t", "name string, id bigint", roots)
    assert good.columns == ["name", "id"] and good.count() == 3
    with pytest.raises(SchemaDrift, match="id is bigint, not int; gone is missing"):
        read_contracted(spark, "partner.db.t", "id int, gone string", roots)
    with pytest.raises(ValueError):
        resolve(spark, "t", roots)
    spark.sql("CREATE DATABASE IF NOT EXISTS other_team")
    spark.range(4).write.mode("overwrite").saveAsTable("other_team.numbers")
    assert read_contracted(spark, "other_team.numbers", "id bigint").count() == 4


def test_views_show_declared_columns_and_own_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("PY_A", 1, "it's"), ("EF_B", 2, "b"), ("HS_C", 3, "c")]
    replace_table(spark.createDataFrame(rows, "global_entity_id string, id int, secret string"), path)
    columns = {"id": "the reader's id", "global_entity_id": ""}
    made = publish_to_groups(spark, "shown", path, columns, {"one": ["PY_A", "HS_C"], "none": []})
    assert made == ["shown_one"]
    other = spark.newSession()
    assert [tuple(r) for r in other.table("shown_one").orderBy("id").collect()] == [(1, "PY_A"), (3, "HS_C")]
    comments = {r["col_name"]: r["comment"] for r in other.sql("DESCRIBE shown_one").collect()}
    assert comments["id"] == "the reader's id"
    assert undeclared(spark.table("shown_one"), {"id": "", "gone": ""}) == ["gone"]
    with pytest.raises(ValueError):
        publish_view(spark, "empty", path, {})


def test_flags_come_with_the_fold(spark):
    rows = [("k", 1, True), ("k", 2, False), ("l", 1, False), ("m", 1, None), ("m", 2, None)]
    df = spark.createDataFrame(rows, "key string, id int, flag boolean")
    found = fold(df, ["key"], "all", F.struct("id"), split_on=["id"], flags={"any": "flag"}).collect()
    assert {r["key"]: (r["any"], len(r["all"])) for r in found} == {"k": (True, 2), "l": (False, 1), "m": (None, 2)}


def test_sql_functions_of_odd_values(spark):
    register_all(spark)
    one = spark.sql(
        """SELECT funded_blocks(7, 2, 0) AS a, funded_blocks(7, 2, 2) AS b, funded_blocks(7, 0, 2) AS c,
          funded_blocks(NULL, 2, 2) AS d, funding_basis(true, false, 'configured', 'skip', 'normalized', 1D) AS e,
          funding_basis(NULL, NULL, 'missing', 'other', 'normalized', NULL) AS f,
          funding_amount('per_benefit', 2D, 0D, 7D, 0D, 1D) AS g, funding_amount('else', 2D, 0D, 7D, 0D, 1D) AS h,
          campaign_subtype('Generic', NULL, NULL, NULL) AS i, campaign_subtype('BasketValue', 'BASKET', NULL, 1D) AS j"""
    ).first()
    assert tuple(one) == (3.0, 2.0, None, None, "nothing", "nothing", None, 0.0, "Generic", None)
    days = spark.sql("SELECT count(*) AS n, min(partition_date) AS low FROM run_partitions(DATE'2024-05-01')").first()
    assert tuple(days) == (33, date(2024, 4, 29))


def test_only_lines_move_to_stored_slots(spark, inputs):
    from fundspark.plans import funding_v2 as v2
    from fundspark.sources.bucketed import drop_bucketed, write_bucketed
    from suite.funding import Run
    from suite.model import FULL

    run = Run(inputs)
    slots = v2.contract_slots(v2.placed_contracts(run.contracts, run.warehouses), run.rules, FULL)
    stored = write_bucketed(slots, "slots_of_a_test", v2.SLOT_KEY)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matched = v2.match_slots(run.lines, stored, run.rules, FULL)
        plan = matched._jdf.queryExecution().executedPlan().toString().splitlines()
        scan = next(i for i, line in enumerate(plan) if "FileScan" in line and "slots_of_a_test" in line)
        depth, above = len(plan[scan]) - len(plan[scan].lstrip(" :+-")), []
        for line in reversed(plan[:scan]):
            own = len(line) - len(line.lstrip(" :+-"))
            if own < depth:
                depth = own
                above.append(line.strip(" :+-"))
        above = above[: next(i for i, line in enumerate(above) if line.startswith("SortMergeJoin"))]
        assert not any(line.startswith("Exchange") for line in above) and "Bucketed: true" in plan[scan]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert matched.count() == run.matched.count()
    drop_bucketed(spark, "slots_of_a_test")


def test_a_run_with_violations_leaves_its_report_only(spark, tmp_path):
    from fundspark.operators.quality import REPORT
    from fundspark.plans.targets import ChecksFailed, Target, leave_tables, read_left

    targets = {"whole": Target(cluster_by=("id",)), "daily": Target("day")}
    rows = spark.range(6).selectExpr("id", "date_add(date'2020-01-01', cast(id % 3 as int)) as day")
    good = spark.createDataFrame([("whole", "unique", "id", 0, True)], REPORT)
    bad = spark.createDataFrame([("whole", "unique", "id", 2, False)], REPORT)
    root = str(tmp_path / "run")
    leave_tables({"whole": rows, "daily": rows, "report": good}, root, targets)
    with pytest.raises(ChecksFailed, match="whole.unique"):
        leave_tables({"whole": rows.limit(1), "daily": rows.limit(1), "report": bad}, root, targets)
    assert read_left(spark, root, "whole", targets).count() == 6
    later = rows.where("day = date'2020-01-02'").limit(1)
    leave_tables({"whole": later, "daily": later, "report": good}, root, targets)
    assert read_left(spark, root, "whole", targets).count() == 1
    assert read_left(spark, root, "daily", targets).count() == 5
    assert read_table(spark, f"{root}/report").first()["passed"]
