"""Later batches: accumulated points, translation fixes, moved orders,
incremental aggregates equal to a full rebuild."""

from __future__ import annotations

import json
import os

import pytest

import fixtures
from strata.operators.batching import write_batches
from strata.plans import aggs
from strata.plans.run import list_batches, run_batch
from strata.sources.lake import Lake


def _table(df, key):
    return {r[key]: tuple(str(v) for v in r) for r in df.collect()}


@pytest.fixture(scope="module")
def three(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("inc"))
    batches = os.path.join(root, "batches")
    fixtures.batch_1(batches)
    fixtures.batch_2(batches)
    fixtures.batch_3(batches)
    lake = Lake(spark, os.path.join(root, "lake"), buckets=4)
    for b in list_batches(lake, batches):
        run_batch(lake, batches, b)
    return lake, batches


def test_points_accumulate_over_batches(three):
    lake, batches = three
    g = lake.read("silver", "geolocation").collect()[0]
    assert g.n_points == 4 and g.lat == pytest.approx((-23.5 - 23.7 - 23.6 - 23.8) / 4)
    run_batch(lake, batches, "2017-03")  # replay: still 4 points
    assert lake.read("silver", "geolocation").collect()[0].n_points == 4


def test_translation_fix_reaches_products(three):
    lake, _ = three
    p2 = [r for r in lake.read("silver", "product").collect() if r.product_id == "p2"][0]
    assert p2.category_en == "no_translation" and p2._batch_id == "2017-03"
    versions = sorted(
        (str(r.effective_from), r.category_en) for r in lake.read("gold", "dim_product").collect() if r.product_id == "p2"
    )
    assert versions == [("1900-01-01 00:00:00", "sem_traducao"), ("2017-03-01 00:00:00", "no_translation")]


def test_quarantine_keeps_raw_record(three):
    lake, _ = three
    q = [r for r in lake.read("silver", "quarantine_order_item").collect() if r.order_id == "o2" and r.order_item_id == 2]
    assert json.loads(q[0]._raw)["price"] == "abc"


def test_incremental_aggregates_equal_full_rebuild(three):
    lake, _ = three
    fact = lake.read("gold", "fact_order_items")
    # o7 moved from 2017-02-15 to 2017-03-02: the old day lost its only order
    daily = lake.read("gold", "agg_daily_sales")
    assert 20170215 not in {r.purchase_date_key for r in daily.collect()}
    assert _table(daily, "purchase_date_key") == _table(aggs.agg_daily_sales(fact), "purchase_date_key")
    ltv = lake.read("gold", "agg_customer_ltv")
    assert _table(ltv, "customer_key") == _table(aggs.agg_customer_ltv(fact), "customer_key")


def test_soft_checks_logged(three):
    lake, _ = three
    rows = {r.soft_check: r for r in lake.read_batch("ops", "soft_checks", "2017-01").collect()}
    assert set(rows) == {"delivered before purchase", "approved before purchase", "shipping limit before purchase"}
    assert rows["shipping limit before purchase"].rows_flagged >= 1


def test_partitioned_batch_layout(spark, tmp_path):
    """Batches written by the partitioned writer (one folder per source,
    ``batch_id=`` inside) load like per-month folders."""
    raw = str(tmp_path / "raw")
    fixtures.batch_1(raw)
    out = str(tmp_path / "split")
    orders = spark.read.option("header", True).csv(os.path.join(raw, "2017-01", "olist_orders_dataset.csv"))
    from strata.operators.batching import split_by_month

    write_batches(split_by_month(orders, "order_purchase_timestamp"), os.path.join(out, "orders"))
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    # the month is the first 7 characters of any non-empty text, as the
    # splitter defines it, so the malformed timestamp gets its own batch
    assert list_batches(lake, out) == ["2017-01", "not a d"]
    log = run_batch(lake, out, "2017-01")
    bronze = [r for r in log if r[1] == "bronze"]
    assert bronze == [r for r in bronze if r[2] == "orders"] and bronze[0][3] == 3
    assert lake.read("silver", "order").count() == 3


def test_type1_dimensions_equal_full_rebuild(three, spark):
    """c2 moved from person u1 to u3 in 2017-03; s2 arrived at a zip whose
    points changed: the bucket-wise refresh equals a full rebuild."""
    from strata.plans import dims
    from strata.plans.gold import silver

    lake, _ = three
    customers, orders, geo = silver(lake, "customer"), silver(lake, "order"), silver(lake, "geolocation")
    want = dims.dim_customer(customers, orders, geo)
    got = lake.read("gold", "dim_customer")
    assert _table(got, "customer_unique_id") == _table(want.select(*got.columns), "customer_unique_id")
    rows = {r.customer_unique_id: r for r in got.collect()}
    assert set(rows) == {"u1", "u2", "u3"}
    assert rows["u1"].zip_prefix == "01310" and rows["u3"].zip_prefix == "12345"  # u1 back on c1
    want_s = dims.dim_seller(silver(lake, "seller"), geo)
    got_s = lake.read("gold", "dim_seller")
    assert _table(got_s, "seller_id") == _table(want_s.select(*got_s.columns), "seller_id")


def test_moved_record_refreshes_its_old_person(spark, tmp_path):
    """Only the staged previous value links the move to u1: the batch holds
    nothing else (no orders, no points)."""
    batches = str(tmp_path / "batches")
    d1 = fixtures.batch_1(batches)  # u1 = {c1, c2}; c2 bought last, so u1 lives at c2's zip
    fixtures.write_csv(d1, "order_items", [fixtures.item("o1", "1", "p1", "10.00"), fixtures.item("o2", "3", "p1", "9.00")])
    fixtures.write_csv(
        os.path.join(batches, "2017-02"),
        "customers",
        [{"customer_id": "c2", "customer_unique_id": "u3", "customer_zip_code_prefix": "123456",
          "customer_city": "rio de janeiro", "customer_state": "rj"}],
    )
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    run_batch(lake, batches, "2017-01")
    assert {r.customer_unique_id: r.zip_prefix for r in lake.read("gold", "dim_customer").collect()}["u1"] == "12345"
    run_batch(lake, batches, "2017-02")
    rows = {r.customer_unique_id: r.zip_prefix for r in lake.read("gold", "dim_customer").collect()}
    assert rows == {"u1": "01310", "u2": "20000", "u3": "12345"}
    # the fact of c2's order now points at u3, and lifetime value follows
    keys = {r.customer_unique_id: r.customer_key for r in lake.read("gold", "dim_customer").collect()}
    fact = {(r.order_id, r.order_item_id): r.customer_key for r in lake.read("gold", "fact_order_items").collect()}
    assert fact[("o2", 3)] == keys["u3"] and fact[("o1", 1)] == keys["u1"]
    fact_df = lake.read("gold", "fact_order_items")
    assert _table(lake.read("gold", "agg_customer_ltv"), "customer_key") == _table(
        aggs.agg_customer_ltv(fact_df), "customer_key"
    )


def test_prune_rerun_removes_keys_that_are_gone(spark, tmp_path):
    """Default re-runs are upsert-only; with prune=True a re-run with fewer
    rows removes the missing keys from silver, facts, aggregates and the
    type-1 dimension."""
    batches = str(tmp_path / "batches")
    d = fixtures.batch_1(batches)
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    run_batch(lake, batches, "2017-01")
    assert lake.read("gold", "fact_order_items").filter("order_id = 'o1' AND order_item_id = 2").count() == 1
    # corrected delivery: item o1/2 withdrawn, sellers file now empty
    fixtures.write_csv(d, "order_items", [fixtures.item("o1", "1", "p1", "11.00", limit="2017-01-11 00:00:00"),
                                          fixtures.item("o3", "1", "p9", "20.00"), fixtures.item("o9", "1", "p1", "30.00")])
    fixtures.write_csv(d, "sellers", [])
    run_batch(lake, batches, "2017-01")  # upsert-only: nothing removed
    assert lake.read("silver", "order_item").filter("order_id = 'o1' AND order_item_id = 2").count() == 1
    run_batch(lake, batches, "2017-01", prune=True)
    assert lake.read("silver", "order_item").filter("order_id = 'o1' AND order_item_id = 2").count() == 0
    fact = lake.read("gold", "fact_order_items")
    assert fact.filter("order_id = 'o1' AND order_item_id = 2").count() == 0
    assert _table(lake.read("gold", "agg_daily_sales"), "purchase_date_key") == _table(
        aggs.agg_daily_sales(fact.drop("_batch_id")), "purchase_date_key"
    )
    assert lake.read("silver", "seller") is None and lake.read("gold", "dim_seller") is None  # no rows left
    # pruning again changes nothing
    before = _table(lake.read("gold", "fact_order_items"), "order_item_id")
    run_batch(lake, batches, "2017-01", prune=True)
    assert _table(lake.read("gold", "fact_order_items"), "order_item_id") == before
