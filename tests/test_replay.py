"""Replays, corrections, withdrawals and broken runs over a small lake."""

from __future__ import annotations

import os
import shutil

import fixtures
import pytest
from pyspark.sql import functions as F

from strata.plans import gold
from strata.plans.run import run_batch
from strata.sources.csv import read_raw
from strata.sources.lake import Lake
from strata.sources.specs import SOURCES
from strata.streaming import run_stream


def customer(cid, zip_="1"):
    return {"customer_id": cid, "customer_unique_id": f"u{cid}", "customer_zip_code_prefix": zip_, "customer_city": "x", "customer_state": "sp"}


def seller(sid, zip_="1"):
    return {"seller_id": sid, "seller_zip_code_prefix": zip_, "seller_city": "x", "seller_state": "sp"}


def point(zip_, lat, lng):
    return {"geolocation_zip_code_prefix": zip_, "geolocation_lat": lat, "geolocation_lng": lng, "geolocation_city": "x", "geolocation_state": "sp"}


BASE = {
    "customers": [customer("c1"), customer("c2")],
    "sellers": [seller("s1")],
    "geolocation": [point("1", "-23.0", "-46.0"), point("2", "-22.0", "-45.0")],
    "products": [fixtures.product("p1", "a", "100"), fixtures.product("p2", "a", "200")],
    "orders": [fixtures.order("o1", "c1", "2017-01-05 10:00:00"), fixtures.order("o2", "c2", "2017-01-06 10:00:00")],
    "order_items": [fixtures.item("o1", "1", "p1", "11.00"), fixtures.item("o2", "1", "p2", "22.00")],
}


def batch(root, name, **tables):
    for source, rows in tables.items():
        fixtures.write_csv(os.path.join(root, name), source, rows)


@pytest.fixture(scope="module")
def first_batch(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("first")
    batch(str(root / "batches"), "2017-01", **BASE)
    run_batch(Lake(spark, str(root / "lake"), buckets=3), str(root / "batches"), "2017-01")
    return root


@pytest.fixture()
def started(spark, first_batch, tmp_path):
    """A lake of its own after the first batch (tables are folders)."""
    shutil.copytree(first_batch, tmp_path / "own")
    return Lake(spark, str(tmp_path / "own" / "lake"), buckets=3), str(tmp_path / "own" / "batches")


def prices(lake):
    return {r.order_id: float(r.price) for r in lake.read("gold", "fact_order_items").collect()}


def daily(lake):
    return {r.purchase_date_key: float(r.gmv) for r in lake.read("gold", "agg_daily_sales").collect()}


def test_corrected_older_batch_reaches_the_fact(started):
    lake, batches = started
    batch(batches, "2017-02", orders=[fixtures.order("o1", "c1", "2017-01-05 10:00:00", status="shipped")])
    run_batch(lake, batches, "2017-02")
    batch(batches, "2017-01", order_items=[fixtures.item("o1", "1", "p1", "99.00"), fixtures.item("o2", "1", "p2", "22.00")])
    run_batch(lake, batches, "2017-01")
    assert prices(lake) == {"o1": 99.0, "o2": 22.0}
    assert daily(lake) == {20170105: 99.0, 20170106: 22.0}
    row = lake.read("gold", "fact_order_items").filter("order_id = 'o1'").first()
    assert row.order_status == "shipped"


def test_pruning_a_withdrawn_order_and_customer(started):
    lake, batches = started
    batch(batches, "2017-01", orders=BASE["orders"][:1])
    run_batch(lake, batches, "2017-01", prune=True)
    assert prices(lake) == {"o1": 11.0} and daily(lake) == {20170105: 11.0}
    batch(batches, "2017-01", customers=BASE["customers"][1:])
    run_batch(lake, batches, "2017-01", prune=True)
    key = lake.read("gold", "fact_order_items").first().customer_key
    assert key == -1 and {r.customer_unique_id for r in lake.read("gold", "dim_customer").collect()} == {"uc2"}


def test_replayed_points_reach_the_seller(started):
    lake, batches = started
    batch(batches, "2017-02", geolocation=[point("1", "-24.0", "-46.0")])
    run_batch(lake, batches, "2017-02")
    assert lake.read("gold", "dim_seller").first().lat == pytest.approx(-23.5)
    batch(batches, "2017-01", geolocation=[point("1", "-20.0", "-46.0"), point("2", "-22.0", "-45.0")])
    run_batch(lake, batches, "2017-01")
    assert lake.read("gold", "dim_seller").first().lat == pytest.approx(-22.0)


def test_withdrawn_points_lose_their_centroid(started):
    lake, batches = started
    batch(batches, "2017-01", geolocation=[point("2", "-21.0", "-45.0")])
    run_batch(lake, batches, "2017-01")
    assert {r.zip_prefix: r.lat for r in lake.read("silver", "geolocation").collect()} == {"00002": -21.0}
    assert lake.read("gold", "dim_seller").first().lat is None
    batch(batches, "2017-01", geolocation=[])
    run_batch(lake, batches, "2017-01")
    left = lake.read("silver", "geolocation")
    assert left is None or left.count() == 0


def test_corrected_first_batch_keeps_one_version(started):
    lake, batches = started
    batch(batches, "2017-01", products=[fixtures.product("p1", "a", "150"), fixtures.product("p2", "a", "200"), fixtures.product("p3", "b", "1")])
    run_batch(lake, batches, "2017-01")
    rows = {r.product_id: r for r in lake.read("gold", "dim_product").collect() if r.product_key != -1}
    assert len(rows) == 3 and rows["p1"].weight_g == 150
    assert {r.effective_from.year for r in rows.values()} == {1900} and all(r.is_current for r in rows.values())


def test_a_broken_run_is_mended_by_the_next(started, monkeypatch):
    lake, batches = started
    moved = [fixtures.order("o1", "c1", "2017-01-20 10:00:00")]
    batch(batches, "2017-02", orders=moved)
    refresh = gold.refresh_aggregates

    def broken(*_):
        raise RuntimeError("executor lost")

    monkeypatch.setattr(gold, "refresh_aggregates", broken)
    with pytest.raises(RuntimeError):
        run_batch(lake, batches, "2017-02")
    monkeypatch.setattr(gold, "refresh_aggregates", refresh)
    run_batch(Lake(lake.spark, lake.root, buckets=3), batches, "2017-02")
    assert daily(lake) == {20170120: 11.0, 20170106: 22.0}
    assert not [n for n in lake.list_dirs(f"{lake.root}/ops") if n.startswith(("stage_", "prev_")) and lake.list_dirs(f"{lake.root}/ops/{n}")]


def test_daily_batch_ids(spark, tmp_path):
    batches, lake = str(tmp_path / "batches"), Lake(spark, str(tmp_path / "lake"), buckets=3)
    batch(batches, "2017-01-05", **BASE)
    batch(batches, "2017-01-06", products=[fixtures.product("p1", "a", "300")])
    for b in ("2017-01-05", "2017-01-06"):
        run_batch(lake, batches, b)
    assert prices(lake) == {"o1": 11.0, "o2": 22.0}
    assert sorted(str(r.effective_from) for r in lake.read("gold", "dim_product").filter("product_id = 'p1'").collect()) == ["1900-01-01 00:00:00", "2017-01-06 00:00:00"]


def test_calendar_follows_the_data(started):
    lake, batches = started
    days = lambda: {r.year for r in lake.read("gold", "dim_date").select("year").distinct().collect()}
    assert days() == {2017}
    batch(batches, "2019-03", orders=[fixtures.order("o9", "c1", "2019-03-01 00:00:00")])
    run_batch(lake, batches, "2019-03")
    assert days() == {2017, 2018, 2019}


def test_emptied_slice_is_dropped_and_others_stay(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=3)
    df = spark.range(5).withColumn("v", F.lit("x"))
    assert lake.replace_batch(df, "bronze", "t", "2017-01") == 5 and lake.replace_batch(df, "bronze", "t", "2017-02") == 5
    assert lake.replace_batch(df.limit(0), "bronze", "t", "2017-01") == 0
    assert lake.read("bronze", "t").select("_batch_id").distinct().collect() == [("2017-02",)]
    keyed = spark.range(40).selectExpr("id AS k", "1 AS v")
    lake.replace_keyed(keyed, "gold", "t", ["k"])
    lake.refresh_keyed(keyed.limit(0), keyed.filter("k < 39"), "gold", "t", ["k"])
    assert lake.read("gold", "t").collect() == [(39, 1)]


def test_rebucketing_keeps_rows_and_upserts(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=3)
    lake.upsert_keyed(spark.range(40).selectExpr("id AS k", "1 AS v"), "gold", "t", ["k"])
    lake.rebucket("gold", "t", ["k"], 7)
    lake.upsert_keyed(spark.range(20, 60).selectExpr("id AS k", "2 AS v"), "gold", "t", ["k"])
    assert lake.bucket_count(lake.path("gold", "t")) == 7
    assert {r.k: r.v for r in lake.read("gold", "t").collect()} == {k: 1 + (k >= 20) for k in range(60)}


def test_register_replaces_only_its_own_tables(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=3)
    lake.overwrite(spark.range(3), "gold", "own_things")
    lake.overwrite(spark.range(3), "gold", "their_things")
    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    spark.sql(f"CREATE TABLE gold.their_things USING parquet LOCATION '{tmp_path}/elsewhere' AS SELECT 7 AS x")
    try:
        with pytest.raises(ValueError, match="their_things"):
            lake.register()
        assert spark.table("gold.their_things").collect() == [(7,)]
    finally:
        spark.sql("DROP TABLE gold.their_things")
    assert set(lake.register()) == {"gold.own_things", "gold.their_things"} == set(lake.register())
    for t in ("own_things", "their_things"):
        spark.sql(f"DROP TABLE gold.{t}")


def test_each_lake_streams_all_files(spark, tmp_path):
    batches = str(tmp_path / "batches")
    batch(batches, "2017-01", sellers=[seller("s1")])
    for name in ("one", "two"):
        lake = Lake(spark, str(tmp_path / name), buckets=3)
        run_stream(spark, lake, batches).awaitTermination()
        assert lake.read("silver", "seller").count() == 1


# ---- raw files --------------------------------------------------------------
def test_part_files_with_other_columns_are_an_error(spark, tmp_path):
    cols = SOURCES["sellers"].columns
    rows = {c: v for c, v in zip(cols, ("s1", "1000", "x", "sp"))}
    for n, order in enumerate((cols, tuple(reversed(cols)))):
        (tmp_path / f"part-{n}.csv").write_text(",".join(order) + "\n" + ",".join(rows[c] for c in order) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw(spark, str(tmp_path), SOURCES["sellers"], "2017-01").collect()


def test_line_break_in_a_single_line_source_is_an_error(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text(",".join(SOURCES["sellers"].columns) + '\ns1,1,"two\nlines",sp\n')
    with pytest.raises(Exception, match="quoted line break"):
        read_raw(spark, str(path), SOURCES["sellers"], "2017-01").collect()
    path.write_text('﻿"seller_id",seller_zip_code_prefix,seller_city,seller_state\ns1,1,"a, ""b""",sp\ns2\n', encoding="utf-8")
    got = read_raw(spark, str(path), SOURCES["sellers"], "2017-01").select(*SOURCES["sellers"].columns).collect()
    assert [tuple(r) for r in got] == [("s1", "1", 'a, "b"', "sp"), ("s2", None, None, None)]
