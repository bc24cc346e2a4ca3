"""Steps that used to move rows more often than their work needs: the same rows, fewer shuffles."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fundspark.operators import feeds
from fundspark.operators import lines as ops
from fundspark.operators.catalog import catalog_vendor_products, vendor_products_flags
from fundspark.operators.lines import order_line_campaigns
from fundspark.operators.nested import fold, fold_many
from fundspark.operators.skew import of_few_keys
from fundspark.operators.temporal import dense_keys, may_have_dense_keys
from fundspark.plans import funding_v2 as v2
from suite import run_query
from suite.funding import Run
from suite.model import FULL, Inputs

T0 = datetime(2020, 1, 1)
KEYS = ["country_code", "global_entity_id", "campaign_id", "sku"]


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def equal(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_elements_move_once_to_their_document(spark):
    df = spark.createDataFrame([("k", 2, None), ("k", 1, True), (None, 3, False)], "k string, v int, f boolean")
    one = fold(df, ["k"], "all", F.struct("v"), split_on=["v"], flags={"any": "f"})
    many = fold_many({"a": (df, ["v"]), "b": (df, ["v", "f"])}, ["k"], split_on="v")
    assert executed(one).count("Exchange hashpartitioning") == 1
    assert executed(many).count("Exchange hashpartitioning") == 1
    assert {r["k"]: ([e["v"] for e in r["all"]], r["any"]) for r in one.collect()} == {"k": ([1, 2], True), None: ([3], False)}


def first_of(rows, order):
    found = {}
    for row in sorted(rows, key=order):
        found.setdefault(row[:4], row)
    return sorted(found.values(), key=str)


def late(t):
    """Newest first, NULL last."""
    return (t is None, -t.timestamp() if t else 0)


def early(t):
    return (t is None, t.timestamp() if t else 0)


def test_both_feeds_are_ranked_at_once(spark):
    days = [None, *[T0 + timedelta(days=d) for d in (1, 2)]]
    keys = [(c, "E", "x", s) for c in ("a", None) for s in ("1", "2", None)]
    new = [(*k, up, at, 1.0 * n) for n, k in enumerate(keys[:4]) for up in days for at in days]
    old = [(*k, days[2], days[1], 9.0) for k in keys]
    deleted = F.explode(F.array(F.lit(True), F.lit(False)))  # rows alike but for this: the live one counts
    ddl = "country_code string, global_entity_id string, campaign_id string, sku string, {} timestamp, {} timestamp, {} double"
    raw = spark.createDataFrame(new, ddl.format("modified_at", "created_at", "discount"))
    raw = raw.withColumn("supplier_fund_value", F.lit(1.0)).withColumn("is_deleted", deleted)
    clean = spark.createDataFrame(old, ddl.format("updated_at_utc", "created_at_utc", "discount_value")).withColumn(
        "supplier_funding_value", F.lit(1.0)
    ).withColumn("is_deleted", F.lit(False))
    merged = feeds.benefits_merge(raw, clean)
    assert executed(merged).count("Exchange hashpartitioning") == 1
    wanted = first_of([(*r, 1) for r in new] + [(*r, 2) for r in old], lambda r: (r[7], late(r[4]), early(r[5])))
    out = [*KEYS, "updated_at_utc", "created_at_utc", "discount_value", "src_priority"]
    assert sorted((tuple(r) for r in merged.select(*out).collect()), key=str) == wanted
    assert merged.where("is_deleted").isEmpty()

    times = "country_code string, global_entity_id string, campaign_id string, sku string, updated_at_utc timestamp, created_at_utc timestamp"
    triggers = feeds.triggers_merge(
        spark.createDataFrame([r[:6] for r in new], times), spark.createDataFrame([r[:6] for r in old + new], times)
    )
    assert executed(triggers).count("Exchange hashpartitioning") == 1
    both = [(*r[:6], 1) for r in new] + [(*r[:6], 2) for r in old + new]
    wanted = first_of(both, lambda r: (r[6], late(r[4]), early(r[5])))
    out = [*KEYS, "updated_at_utc", "created_at_utc", "src_priority"]
    assert sorted((tuple(r) for r in triggers.select(*out).collect()), key=str) == wanted


def test_products_do_not_move_for_their_warehouse(spark, no_broadcast):
    products = spark.createDataFrame(
        [("E", "v1", "p", "SHOP", 1.0), ("E", "v2", "p", "SHOP", None), ("E", None, "q", "X", 2.0)],
        "global_entity_id string, platform_vendor_id string, global_catalog_id string, type string, sales_buffer double",
    )
    pairs = spark.createDataFrame(
        [("E", "v1", "w1", "one", True, False), ("E", "v1", "w2", "two", True, True), ("F", "v2", "w3", "x", True, False)],
        "global_entity_id string, platform_vendor_id string, warehouse_id string, warehouse_name string,"
        " is_dark_store boolean, uses_new_locations boolean",
    )
    buffers = spark.createDataFrame([("E", "p", 3.0)], "global_entity_id string, global_catalog_id string, sales_buffer double")
    vat = spark.createDataFrame([("E", "p", "7")], "global_entity_id string, global_catalog_id string, vat_rate string")
    spots = spark.createDataFrame(
        [("w1", "p", "r1"), ("w2", "p", "r2")], "warehouse_id string, catalog_product_id string, row string"
    ).selectExpr("*", "'k' as rack", "'s' as shelf", "'a' as storage_type", "'n' as location_movement_request_strategy")
    flagged = vendor_products_flags(products, pairs, buffers, vat, spots)
    assert "BroadcastHashJoin [global_entity_id" in executed(flagged)
    found = flagged.select("platform_vendor_id", "warehouse_id", "sales_buffer", "row").collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [("v1", "w1", 1.0, "r1"), ("v1", "w2", 1.0, None), ("v2", "", 3.0, None), (None, "", 0.0, None)], key=str
    )


def test_only_contracts_of_dense_skus_are_cut(inputs):
    run = Run(inputs)
    placed = v2.placed_contracts(run.contracts, run.warehouses).where("campaign_end_date >= '1995-01-01'").cache()
    lines = run.lines.cache()
    none, every = (dense_keys(inputs("f_benefits"), ["sku"], most) for most in (10**9, 0))
    in_run = placed.where("campaign_start_date <= '2001-12-31'").count()
    assert v2.contract_slots(placed, run.rules, FULL, none).count() == in_run
    cut = v2.match_funding(lines, placed, run.rules, FULL)
    assert v2.contract_slots(placed, run.rules, FULL, every).count() > in_run
    odd = lines.withColumn("order_date", F.date_sub("order_date", 900))  # also days before the run
    for dense in (none, every):
        assert equal(cut, v2.match_funding(lines, placed, run.rules, FULL, dense))
    assert equal(v2.match_funding(odd, placed, run.rules, FULL), v2.match_funding(odd, placed, run.rules, FULL, none))
    assert cut.where("funding_campaign_id is not null").count() > 0


def test_run_metrics_reads_the_funding_it_wrote(spark):
    found = run_query("run_metrics", spark, "/root/testdata/sf0.001")
    assert any("/order_funding-" in f for f in found.inputFiles())
    assert not any("/lineitem" in f for f in found.inputFiles())


def test_lines_move_once_to_their_order_and_product(spark, no_broadcast):
    """Products of one SKU, of several, of none; paid for one of them, twice, or for nothing."""
    catalog = spark.createDataFrame(
        [("EF_AT", "s1", [("p1",), (None,)]), ("EF_AT", "s2", [("p2",), ("p1b",)]), ("EF_AT", "s3", [("p2",)]), ("EF_AT", None, [("p2",), ("p3",)])],
        "global_entity_id string, sku string, vendor_products array<struct<global_catalog_id string>>",
    )
    campaign = [("c1", 2.0, 1.0, 1.0, 1.0), ("c2", 3.0, None, 1.0, 1.0), (None, 1.0, None, 1.0, 1.0)]
    product = [(p, "x", "i", None, 1.0, 2.0, 4.0, 3.0, 1.0, 3.0, campaign) for p in ("p1", "p2", "p3", "p4", None)]
    orders = spark.createDataFrame(
        [(T0.date(), T0, "eu", "EF_AT", "at", o, 2.0, product if o != "o3" else None) for o in ("o1", "o2", "o3", None)],
        """created_date date, created_at_utc timestamp, region string, global_entity_id string, country_code string,
        order_id string, exchange_rate_value double, products array<struct<product_id string, platform_product_id string,
        promo_order_item_id string, parent_product_id string, product_qty double, product_unit_price double,
        subtotal double, total double, absolute_discount_lc double, distributed_discounted_price double,
        campaigns array<struct<campaign_id string, discount_lc double, supplier_funded_amount double,
        trigger_qty double, benefit_qty double>>>>""",
    )
    paid = [("EF_AT", "o1", s, c, float(i)) for i, (s, c) in enumerate([("s1", "c1"), ("s2", "c1"), ("s2", "c1"), ("s3", "c2"), (None, "c1"), ("s1", None)])]
    external = spark.createDataFrame(
        paid, "global_entity_id string, order_id string, sku string, campaign_id string, abs_discount_value_lt double"
    )
    found = order_line_campaigns(orders, catalog, external)
    # One for the lines, two to find the products of what was paid, one for what was paid.
    assert executed(found).count("Exchange hashpartitioning") == 4
    skus = catalog_vendor_products(catalog).where("global_catalog_id is not null")
    skus = skus.selectExpr("global_entity_id", "global_catalog_id as product_id", "sku").distinct()
    flat = orders.selectExpr("global_entity_id", "order_id", "explode_outer(products) as p")
    flat = flat.selectExpr("global_entity_id", "order_id", "p.product_id", "p.product_qty", "explode_outer(p.campaigns) as c")
    flat = flat.selectExpr("*", "c.campaign_id").join(skus, ["global_entity_id", "product_id"], "left")
    flat = flat.join(external, ["global_entity_id", "order_id", "sku", "campaign_id"], "left")
    wanted = flat.groupBy("order_id", "product_id").agg(
        F.sum("product_qty").alias("q"), F.coalesce(F.sum("abs_discount_value_lt"), F.sum("c.supplier_funded_amount"), F.lit(0.0)).alias("f")
    )
    assert equal(found.select("order_id", "global_catalog_id", "quantity_sold", "order_items_supplier_funded_lc"), wanted)
    assert wanted.where("order_id = 'o1' and product_id = 'p2'").first()["q"] == 10.0


def test_promo_orders_are_nested_where_their_lines_are(spark, no_broadcast):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    made, by_text = inputs._one_pass("f_promo_flat", "okey"), inputs("f_promo_flat")
    assert equal(made.drop("__key"), by_text) and made.drop("__key").schema.names == by_text.schema.names
    # Lines, orders twice, customers, nations and regions; nothing for the documents.
    assert executed(inputs.promo_orders).count("Exchange hashpartitioning") <= 6


def test_versions_move_once_with_their_lines(spark, no_broadcast, monkeypatch):
    """Changes of one day and of one instant, values that cannot be read, versions without a duration."""
    day, ctx = timedelta(days=1), replace(FULL, as_of=date(2022, 1, 1), date_fin=date(2022, 1, 1))
    times = [T0 + i * day / 4 for i in range(-8, 24)] + [datetime(2030, 1, 1), datetime(2031, 1, 1)]
    products = ["p", "q", "r", None]
    lines = spark.createDataFrame(
        [("A", "B" if i % 3 else "A", p, f"o{i}", f"{p}{i}", t, 3.0, 10.0, 4.0) for p in products for i, t in enumerate(times)],
        "global_entity_id string, fulfilled_by_entity string, global_catalog_id string, order_id string,"
        " picking_order_item_id string, order_created_at_utc timestamp, vat_percentage double, unit_price_lc double, unit_price_paid_lc double",
    )
    where = [(e, p) for e in ("A", "B", None) for p in products]
    # Twice at one instant, without a time, and after the last end.
    rates = [(None, "9"), (T0, "7"), (T0, "5"), (T0, None), (T0 + day, "8"), (datetime(2030, 6, 1), "6")]
    events = spark.createDataFrame(
        [(e, p, t, r) for e, p in where for t, r in (rates if p != "q" else rates[:-1])],
        "global_entity_id string, global_catalog_id string, timestamp_valid_from timestamp, vat_rate string",
    )
    prices = spark.createDataFrame([(e, p, T0, T0 + day, T0, 11.0) for e, p in where], "global_entity_id string, global_catalog_id string, valid_from_utc timestamp, valid_to_utc timestamp, valid_from_lt timestamp, original_price_lc double")
    buffers = prices.withColumnRenamed("original_price_lc", "sales_buffer")
    # The newest of a day counts, by local time, even where it holds for no time at all.
    changes = [(T0 - day, T0, T0 - day), (T0, T0 + day, T0), (T0 + day / 4, T0 + 2 * day, T0 + day / 4),
               (T0 + day, T0 + day, T0 + day * 1.3), (T0 + day, T0 + 4 * day, T0 + day), (T0 + 2 * day, T0 + 4 * day, T0 + 2 * day), (None, T0 + 9 * day, T0 + 4.5 * day),
               (T0 + 4 * day, T0 + 5 * day, T0 + 4 * day), (T0 + 3 * day, T0 + 9 * day, None)]
    values = {"minimum_starting_weight": "0.5", "sold_by_weight": "true", "sold_by_piece": "false", "average_weight_per_piece": "heavy", "other": "x"}
    log = spark.createDataFrame(
        [(e, p, f, v if i % 4 or f.startswith("sold") else "2", *c) for e, p in where for f, v in values.items() for i, c in enumerate(changes)],
        "global_entity_id string, global_catalog_id string, updated_field string, updated_value string,"
        " valid_from_utc timestamp, valid_to_utc timestamp, valid_from_lt timestamp",
    )
    vat = ops.vat_intervals(events)
    given = {"vat": vat, "prices": prices, "sales_buffers": buffers, "attribute_log": log, "ctx": ctx, "vat_events": events}
    found = ops.product_histories(lines, **given)
    # One for lines and versions alike.
    assert executed(found).count("Exchange hashpartitioning") == 1
    plain = ops.vat_asof(lines, vat, ctx)
    plain = ops.attribute_asof(ops.sales_buffer_asof(ops.price_asof(plain, prices, ctx), buffers, ctx), log, ctx)
    plain = plain.select(*found.columns)
    assert found.count() == lines.count() and found.where("is_sold_by_weight").count() > 0
    assert equal(found, plain)
    assert equal(found, ops.product_histories(lines, **given, hot=spark.createDataFrame([("p", 3)], "global_catalog_id string, __parts int")))
    # With keys of very many versions all is cleaned first and cut into slices of time.
    monkeypatch.setattr(ops, "may_have_dense_keys", lambda *_: True)
    monkeypatch.setattr(ops, "dense_keys", lambda rows, keys: dense_keys(rows, keys, 5))
    assert equal(found, ops.product_histories(lines, **given))


def test_a_key_with_very_many_versions_is_found(spark):
    rows = spark.range(20_000).selectExpr("cast(id as string) as k").unionAll(spark.range(1_500).selectExpr("'x' as k"))
    assert may_have_dense_keys(rows, "k") and not may_have_dense_keys(rows.where("k <> 'x'"), "k")
    assert not may_have_dense_keys(rows.selectExpr("cast(null as string) as k"), "k") and not may_have_dense_keys(rows.limit(0), "k")


def test_lines_move_once_for_both_campaign_keys(spark, no_broadcast):
    line = "global_entity_id string, country_code string, order_id string, global_catalog_id string, platform_product_id string, promo_order_item_id string"
    ids = [(g, p, i) for g in ("g1", "g2", None) for p in ("p1", "p2", None) for i in ("i", None)]
    lines = spark.createDataFrame([("A", c, o, *x) for c in ("at", "AT", None) for o in ("o1", "o2", None) for x in ids], line)
    campaigns = spark.createDataFrame(
        [("A", "At", o, *x, *[float(n)] * len(ops.MATCH_AMOUNTS), [str(n)], ["c"])
         for o in ("o1", None) for n, x in enumerate([("g1", "p1", "i"), ("g1", "p1", "i"), ("g1", None, None), ("g9", "p2", None), (None, "p2", "i")])],
        f"{line}, {', '.join(f'{c} double' for c in ops.MATCH_AMOUNTS)}, campaign_info array<string>, combo_products array<string>",
    )
    found = ops.two_key_match(lines, campaigns)
    # One for the lines, one each time for the campaigns.
    assert executed(found).count("Exchange hashpartitioning") <= 3
    amount, wanted = ops.MATCH_AMOUNTS[0], []
    rows = [r.asDict() for r in campaigns.collect()]
    for r in lines.collect():
        def match(key):
            same = [c for c in rows if None not in (r["country_code"], r["order_id"], r[key], c["order_id"], c[key])
                    and c["country_code"].lower() == r["country_code"].lower() and c["promo_order_item_id"] == r["promo_order_item_id"]]
            return [c for c in same if c["order_id"] == r["order_id"] and c[key] == r[key]]

        of_line = match("global_catalog_id") or match("platform_product_id") or [{amount: 0.0}]
        wanted += [(*r, c[amount]) for c in of_line]
    assert sorted(map(tuple, found.select(*lines.columns, amount).collect()), key=str) == sorted(wanted, key=str)


def test_only_versions_of_wanted_keys_move(spark):
    facts = spark.createDataFrame([("a", "1"), ("a", None), (None, "2"), ("a", "1")], "e string, k string")
    rows = spark.createDataFrame([(e, k, v) for e in ("a", "b", None) for k in ("1", "2", None) for v in (1, 2)], "entity string, k string, v int")
    other = rows.withColumn("k", F.col("k").cast("int"))  # compared by value, so not by its hash
    kept, whole = of_few_keys([rows, other], facts, {"e": "entity", "k": "k"})
    on = [facts["e"] == kept["entity"], facts["k"] == kept["k"]]
    assert equal(facts.join(kept, on).select(kept["*"]), facts.join(rows, [facts["e"] == rows["entity"], facts["k"] == rows["k"]]).select(rows["*"]))
    assert kept.where("entity = 'b'").isEmpty() and kept.columns == rows.columns and equal(whole, other)
    assert equal(of_few_keys([rows], facts, {"e": "entity"}, max_rows=1)[0], rows)


def test_a_daily_run_merges_what_it_sold(spark, monkeypatch):
    seen = []
    merge = ops.carry_asof
    monkeypatch.setattr(ops, "carry_asof", lambda facts, histories, *a, **b: seen.append(histories) or merge(facts, histories, *a, **b))
    found = run_query("order_lines_curated_daily", spark, "/root/testdata/sf0.001")
    sold = found.select("global_catalog_id").distinct().count()
    known = Inputs(spark, "/root/testdata/sf0.001")("f_buffer_history").select("global_catalog_id").distinct().count()
    buffers = next(h.rows for h in seen[0] if "sales_buffer" in getattr(h, "values", {}))
    kept = buffers.select("global_catalog_id").distinct().count()
    # The run also reads the day behind the one it shows.
    assert 0 < sold and kept < known / 20
