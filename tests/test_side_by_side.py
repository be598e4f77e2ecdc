"""Steps that do not need each other run at once, and what the lake wrote is
read without a job that looks for its columns."""

from __future__ import annotations

from threading import Barrier, BrokenBarrierError

import pytest

from strata.operators.quality import Counts
from strata.plans import gold, silver
from strata.session import together
from strata.sources.lake import Lake, _conf


def met(barrier: Barrier) -> None:
    try:
        barrier.wait(20)
    except BrokenBarrierError:
        raise AssertionError("the steps ran one after the other") from None


def test_silver_tables_are_loaded_at_once_and_products_after_the_translation(spark, tmp_path, monkeypatch):
    at_once, order = Barrier(len(silver.ENTITIES) - 1), []

    def load(lake, entity, *_):
        if entity.name != "product":
            met(at_once)
        order.append(entity.name)
        return Counts(1, 1, 0)

    monkeypatch.setattr(silver, "load_entity", load)
    monkeypatch.setattr(silver, "refresh_product_categories", lambda *_: Counts(2, 2, 0))
    counts = silver.build_silver(Lake(spark, str(tmp_path)), "2017-01")
    assert list(counts) == ["category_translation", "product_category_refresh", *[n for n in silver.ENTITIES if n != "category_translation"]]
    assert order.index("product") > order.index("category_translation")


def test_dimensions_are_built_at_once(spark, tmp_path, monkeypatch):
    at_once = Barrier(3)
    for name in ("build_dim_date", "build_dim_customer", "build_dim_seller"):
        monkeypatch.setattr(gold, name, lambda *_: met(at_once))
    assert gold.build_gold(Lake(spark, str(tmp_path), buckets=2), "2017-01") == {}


def test_all_steps_end_before_the_first_error_is_raised(spark):
    done = []

    def fails(text):
        raise ValueError(text)

    with pytest.raises(ValueError, match="first"):
        together(spark, [lambda: fails("first"), lambda: done.append(1), lambda: fails("second")])
    assert done == [1] and together(spark, [lambda: 1, lambda: 2, lambda: 3]) == [1, 2, 3]


def test_a_setting_is_put_back_by_the_last_block(spark):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    old, inside, one_left = spark.conf.get(key, None), Barrier(2), Barrier(2)

    def leaves_first():
        with _conf(spark, key, "false"):
            met(inside)
        met(one_left)

    def leaves_last():
        with _conf(spark, key, "false"):
            met(inside)
            met(one_left)
            return spark.conf.get(key)

    assert together(spark, [leaves_first, leaves_last])[1] == "false"
    assert spark.conf.get(key, None) == old


def test_what_was_written_is_read_without_a_job(spark, tmp_path):
    lake = Lake(spark, str(tmp_path), buckets=2)
    rows = spark.createDataFrame([("a", 1), ("b", None)], "k string, n int")
    lake.replace_batch(rows, "ops", "stage_rows", "2017-01-05")
    lake.upsert_keyed(rows, "silver", "rows", ["k"])
    spark.sparkContext.setJobGroup("reads", "reads")
    try:
        slice_, table = lake.read_batch("ops", "stage_rows", "2017-01-05"), lake.read("silver", "rows")
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("reads")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not list(jobs)
    assert sorted(map(tuple, slice_.collect())) == [("a", 1, "2017-01-05"), ("b", None, "2017-01-05")]
    assert sorted(map(tuple, table.collect())) == [("a", 1), ("b", None)]
    other = Lake(spark, str(tmp_path), buckets=2)  # knows nothing of the writes
    assert other.read_batch("ops", "stage_rows", "2017-01-05").schema == slice_.schema
    assert other.read("silver", "rows").schema == table.schema
