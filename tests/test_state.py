"""State that keeps gold up to date without reading history: parts and sums of
the aggregates, points per zip and batch, rows of an order in the same buckets."""

from __future__ import annotations

import glob
import json
import os

import fixtures
import pytest
from pyspark.sql import functions as F
from test_replay import customer, point, seller

from strata.plans import aggs
from strata.plans.conform import ENTITIES
from strata.plans.run import replay_quarantine, run_batch
from strata.sources.lake import Lake

DAYS = ["2017-01-%02d 10:00:00" % d for d in range(1, 13)]
BASE = {
    "customers": [customer(f"c{i}") for i in range(12)],
    "sellers": [seller("s1")],
    "geolocation": [point("1", "-23.0", "-46.0"), point("1", "-22.0", "-45.0"), point("2", "-20.0", "-45.0")],
    "products": [fixtures.product("p1", "a", "100")],
    "orders": [fixtures.order(f"o{i}", f"c{i // 3}", DAYS[i]) for i in range(12)],
    "order_items": [fixtures.item(f"o{i}", str(n), "p1", f"{i + n}.00") for i in range(12) for n in (1, 2)]
    + [fixtures.item("o2", "3", "p1", "-5.00"), fixtures.item("o2", "1", "p1", "-6.00"), fixtures.item("o3", "3", "p1", "x")],
    "order_payments": [{"order_id": f"o{i}", "payment_sequential": "1", "payment_type": "boleto", "payment_installments": "1", "payment_value": "5.00"} for i in range(12)],
}


def batch(root, name, **tables):
    for source, rows in tables.items():
        fixtures.write_csv(os.path.join(root, name), source, rows)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("state")
    batch(str(root / "batches"), "2017-01", **BASE)
    lake = Lake(spark, str(root / "lake"), buckets=8)
    lake.batches = str(root / "batches")
    run_batch(lake, lake.batches, "2017-01")
    return lake


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()))


def assert_equals_rebuild(lake):
    fact = lake.read("gold", "fact_order_items")
    assert rows(lake.read("gold", "agg_daily_sales")) == rows(aggs.agg_daily_sales(fact))
    assert rows(lake.read("gold", "agg_customer_ltv")) == rows(aggs.agg_customer_ltv(fact))


def spoil(lake, layer, name, but):
    """Overwrite the data pages (not the footers) of all buckets but some."""
    for path in glob.glob(f"{lake.path(layer, name)}/_bucket=*/*.parquet"):
        if int(path.split("_bucket=")[1].split("/")[0]) in but:
            continue
        with open(path, "r+b") as f:
            data = f.read()
            end = len(data) - 8 - int.from_bytes(data[-8:-4], "little")
            f.seek(4)
            f.write(b"\xff" * (end - 4))
        crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
        if os.path.exists(crc):
            os.remove(crc)


def test_broken_runs_and_retracted_extremes(spark, lake, monkeypatch):
    """The first order of a person moves to another person and day; the run
    breaks off while the state is replaced; the batch then comes corrected."""
    assert_equals_rebuild(lake)
    batch(lake.batches, "2017-02", orders=[fixtures.order("o0", "c5", "2017-02-03 10:00:00"), fixtures.order("o5", "c1", "2016-12-01 10:00:00")])
    replace, calls = lake.replace_buckets, []

    def broken(*args):
        calls.append(args)
        raise RuntimeError("lost")

    monkeypatch.setattr(lake, "replace_buckets", broken)
    with pytest.raises(RuntimeError):
        run_batch(lake, lake.batches, "2017-02")
    assert calls and lake.marker(lake.path("state", "part_agg_daily_sales"), "_replace")
    lake.register()  # beside a marked batch
    monkeypatch.setattr(lake, "replace_buckets", replace)
    batch(lake.batches, "2017-02", orders=[fixtures.order("o0", "c6", "2017-02-04 10:00:00")])
    run_batch(lake, lake.batches, "2017-02")
    assert_equals_rebuild(lake)
    ltv = {r.customer_key: r for r in lake.read("gold", "agg_customer_ltv").collect()}
    fact = lake.read("gold", "fact_order_items")
    key = fact.filter("order_id = 'o1'").first().customer_key
    assert (ltv[key].first_purchase_date_key, ltv[key].orders) == (20170102, 2)  # o0 had been the first
    assert not lake.marker(lake.path("state", "part_agg_daily_sales"), "_replace")


def test_replayed_rejects_reach_the_fact(lake):
    """A changed rule lets refunds in: one is a new item, one has the key of an
    item its batch has given; an unreadable price stays out."""
    entity = ENTITIES["order_item"]
    rules = [("price unreadable", entity.rules[0][1].replace("price >= 0", "price IS NOT NULL"))]
    assert lake.read("silver", "quarantine_order_item").count() == 3
    counts = replay_quarantine(lake, "order_item", rules)
    assert {b: (c.rows_in, c.rows_out, c.rows_quarantined) for b, c in counts.items()} == {"2017-01": (3, 1, 1)}
    left = lake.read("silver", "quarantine_order_item").collect()
    assert [(r.order_id, r._reject_reason, json.loads(r._raw)["price"]) for r in left] == [("o3", "price unreadable", "x")]
    items = {(r.order_id, r.order_item_id): float(r.price) for r in lake.read("gold", "fact_order_items").collect()}
    assert items["o2", 3] == -5.0 and items["o2", 1] == 3.0 and len(items) == 25
    assert_equals_rebuild(lake)
    assert [(r.tbl, r.rows_out, r.rows_left) for r in lake.read("ops", "replays").collect()] == [("order_item", 1, 1)]


def test_a_batch_reads_only_the_buckets_of_its_orders(spark, lake):
    tables = [("gold", "fact_order_items"), ("gold", "fact_payments"), ("silver", "order_item"), ("silver", "order_payment"), ("silver", "order")]
    one = spark.createDataFrame([("o9",)], "order_id string")
    held = {t: lake.buckets_holding(*t, one, ["order_id", "x"] if t[1] != "order" else ["order_id"]) for t in tables}
    assert len({tuple(b) for b in held.values()}) == 1  # the same bucket everywhere
    want = rows(aggs.agg_daily_sales(lake.read("gold", "fact_order_items").withColumn("price", F.when(F.col("order_id") == "o9", 50).otherwise(F.col("price")).cast("decimal(12,2)"))))
    for t in tables:
        spoil(lake, *t, held[t])
    with pytest.raises(Exception):  # noqa: B017
        lake.read("gold", "fact_order_items").collect()
    items = [fixtures.item("o9", str(n), "p1", "50.00") for n in (1, 2)]
    batch(lake.batches, "2017-03", order_items=items, geolocation=[point("2", "-21.0", "-44.0")])
    spoil_bronze(lake)
    run_batch(lake, lake.batches, "2017-03")
    got = rows(lake.read("gold", "agg_daily_sales"))
    assert got == want
    geo = {r.zip_prefix: (r.lat, r.lng, r.n_points) for r in lake.read("silver", "geolocation").collect()}
    assert geo == {"00001": (-22.5, -45.5, 2), "00002": (-20.5, -44.5, 2)}


def spoil_bronze(lake):
    """No batch may read the points of earlier ones."""
    for path in glob.glob(f"{lake.path('bronze', 'geolocation')}/_batch_id=2017-01/*.parquet"):
        os.remove(path)
