"""Splitting a raw dump into batches, and loading them."""

from __future__ import annotations

import fixtures
import pytest
from pyspark.sql import functions as F

from strata.operators.batching import write_batches
from strata.plans.prepare import prepare_batches
from strata.plans.run import list_batches, run_batch
from strata.sources.lake import Lake


def dump(root, items):
    orders = [fixtures.order("o1", "c1", "2017-01-05 10:00:00"), fixtures.order("o2", "c1", "2017-02-06 10:00:00"), fixtures.order("o3", "c1", "")]
    fixtures.write_csv(root, "orders", orders)
    fixtures.write_csv(root, "order_items", items)
    fixtures.write_csv(root, "products", [fixtures.product("p1", "a", "100")])


def test_months_without_children_get_a_header(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "batches")
    dump(raw, [fixtures.item("o1", "1", "p1", "11.00"), fixtures.item("o2", "1", "p1", "22.00"), fixtures.item("o9", "1", "p1", "1.00")])
    assert prepare_batches(spark, raw, out) == ["2017-01", "2017-02"]
    lake = Lake(spark, str(tmp_path / "lake"), buckets=2)
    assert list_batches(lake, out) == ["2017-01", "2017-02"]
    for b in ("2017-01", "2017-02"):
        run_batch(lake, out, b)
    assert sorted((r.order_id, r.product_key == -1) for r in lake.read("gold", "fact_order_items").collect()) == [("o1", False), ("o2", False)]
    # the corrected dump has no item in the second month
    dump(raw, [fixtures.item("o1", "1", "p1", "11.00")])
    prepare_batches(spark, raw, str(tmp_path / "again"))
    run_batch(lake, str(tmp_path / "again"), "2017-02", prune=True)
    assert [r.order_id for r in lake.read("bronze", "order_items").collect()] == ["o1"]
    assert [r.order_id for r in lake.read("gold", "fact_order_items").collect()] == ["o1"]


def test_a_dump_without_months_is_an_error(spark, tmp_path):
    raw = str(tmp_path / "raw")
    fixtures.write_csv(raw, "orders", [fixtures.order("o1", "c1", "")])
    with pytest.raises(ValueError, match="purchase month"):
        prepare_batches(spark, raw, str(tmp_path / "batches"))
    with pytest.raises(ValueError, match="holds no"):
        prepare_batches(spark, str(tmp_path / "nowhere"), str(tmp_path / "batches"))


def test_files_follow_the_size_of_the_months(spark, tmp_path):
    month = F.when(F.col("id") % 3 == 0, "2017-01").otherwise(F.concat(F.lit("2018-"), F.lpad((F.col("id") % 10).cast("string"), 2, "0")))
    rows = spark.range(0, 60_000, 1, 40).select(month.alias("batch_id"), F.sha2(F.col("id").cast("string"), 256).alias("text"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512KB")
        write_batches(rows, str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {p.name: len(list(p.glob("part-*"))) for p in (tmp_path / "out").glob("batch_id=*")}
    assert len(files) == 11 and 2 <= files["batch_id=2017-01"] <= 8  # a third of the rows: split, but not by the 40 tasks
    assert max(files.values()) <= 8 and sum(files.values()) <= 40  # tasks times months: 440
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).distinct().count() == 60_000
