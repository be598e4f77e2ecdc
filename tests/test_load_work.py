"""What a load does not do twice: new keys are added without a rewrite, a
slice gets no tagged copy, expressions record no call sites."""

from __future__ import annotations

import os
from threading import Barrier

import fixtures
from pyspark.errors import utils
from pyspark.sql import functions as F

from strata.plans.conform import ENTITIES
from strata.plans.silver import ingest_bronze, load_entity
from strata.session import without_call_sites
from strata.sources import lake as lakes
from strata.sources.lake import Lake


def frame(spark, batch_id, *rows):
    return spark.createDataFrame([(k, v, batch_id) for k, v in rows], "k string, v int, _batch_id string")


def put(lake, batch_id, *rows):
    lake.upsert_keyed(frame(lake.spark, batch_id, *rows), "silver", "t", ["k"], version_col="_batch_id", batch_id=batch_id)


def files(lake):
    root = lake.path("silver", "t")
    return {f for d in os.listdir(root) if d.startswith("_bucket=") for f in os.listdir(os.path.join(root, d)) if f.endswith(".parquet")}


def held(lake):
    return sorted((r.k or "", r.v, r._batch_id) for r in lake.read("silver", "t").collect())


def test_new_keys_of_a_new_batch_are_added_without_a_rewrite(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path), buckets=2)
    put(lake, "2017-01", ("a", 1), ("b", 1), ("c", 1), ("d", 1))
    first = files(lake)
    put(lake, "2017-02", ("e", 2), ("f", 2), (None, 2))
    assert first < files(lake) and lake.newest("silver", "t") == "2017-02"
    put(lake, "2017-01", ("a", 10), ("e", 10))  # comes again: merged; the newer row stays
    want = [("", 2, "2017-02"), ("a", 10, "2017-01"), *((k, 1, "2017-01") for k in "bcd"), ("e", 2, "2017-02"), ("f", 2, "2017-02")]
    assert held(lake) == want
    put(lake, "2017-03", ("f", 3), ("g", 3))  # one key is there
    want = [*want[:-1], ("f", 3, "2017-03"), ("g", 3, "2017-03")]
    assert held(lake) == want
    before = files(lake)
    monkeypatch.setattr(lakes, "MOST_FILES", 1)  # no room for more files
    put(lake, "2017-04", *((k, 4) for k in "hijklm"))
    assert not before & files(lake)
    assert held(lake) == want + [(k, 4, "2017-04") for k in "hijklm"]


def test_a_table_of_unknown_age_is_merged(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), buckets=2)
    lake.upsert_keyed(frame(spark, "2017-05", ("a", 5)), "silver", "t", ["k"], version_col="_batch_id")
    put(lake, "2017-06", ("a", 6), ("b", 6))
    assert lake.newest("silver", "t") is None and held(lake) == [("a", 6, "2017-06"), ("b", 6, "2017-06")]


def test_a_merge_has_more_tasks_than_buckets(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), buckets=1)
    rows = spark.range(4000).select(F.col("id").cast("string").alias("k"), F.col("id").cast("int").alias("v"), F.lit("2017-01").alias("_batch_id"))
    lake.upsert_keyed(rows, "silver", "t", ["k"], version_col="_batch_id", batch_id="2017-01")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        again = rows.filter("v % 2 = 0").withColumn("v", -F.col("v"))
        lake.upsert_keyed(again, "silver", "t", ["k"], version_col="_batch_id", batch_id="2017-01")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(files(lake)) > 1
    got = lake.read("silver", "t").agg(F.count("*"), F.countDistinct("k"), F.sum(F.when(F.abs("v") % 2 == 0, -F.abs("v")).otherwise(F.abs("v")) - F.col("v"))).first()
    assert tuple(got) == (4000, 4000, 0)


def test_a_slice_gets_no_tagged_copy(spark, tmp_path):
    fixtures.batch_1(str(tmp_path / "batches"))
    lake = Lake(spark, str(tmp_path / "lake"), buckets=2)
    ingest_bronze(lake, str(tmp_path / "batches"), "2017-01")
    counts = load_entity(lake, ENTITIES["order_item"], "2017-01")
    assert (counts.rows_in, counts.rows_out, counts.rows_quarantined) == (7, 4, 2)
    assert not lake.exists("ops", "stage_tagged_order_item")
    rejected = lake.read("silver", "quarantine_order_item").collect()
    assert len(rejected) == 2 and all(r._raw and r._reject_reason for r in rejected)


def test_expressions_record_no_call_sites_inside_the_block(monkeypatch):
    monkeypatch.setattr(utils, "_enable_debugging_cache", True)
    inside = Barrier(2)

    def first():
        with without_call_sites():
            inside.wait(20)

    def second():
        with without_call_sites():
            inside.wait(20)
            return utils.is_debugging_enabled()

    assert together_plain([first, second])[1] is False
    assert utils.is_debugging_enabled()


def together_plain(steps):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(len(steps)) as pool:
        return [f.result() for f in [pool.submit(s) for s in steps]]
