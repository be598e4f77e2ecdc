"""Batch folders as a file stream: same result as running the batches."""

from __future__ import annotations

import os

import fixtures
from pyspark.sql import functions as F

from strata.sources.lake import Lake
from strata.streaming import batch_of_path, run_stream


def test_batch_of_path(spark):
    df = spark.createDataFrame(
        [("file:/x/batches/2017-01/olist_orders_dataset.csv",), ("file:/x/batches/orders/batch_id=2017-02/part-0.csv",)],
        "path string",
    )
    got = [r[0] for r in df.select(batch_of_path(F.col("path"), "/x/batches")).collect()]
    assert got == ["2017-01", "2017-02"]


def test_stream_runs_new_batches_once(spark, tmp_path):
    batches = str(tmp_path / "batches")
    fixtures.batch_1(batches)
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    ckpt = str(tmp_path / "ckpt")
    run_stream(spark, lake, batches, checkpoint=ckpt).awaitTermination()
    assert lake.read("ops", "dq_log").select("_batch_id").distinct().count() == 1
    fixtures.batch_2(batches)
    run_stream(spark, lake, batches, checkpoint=ckpt).awaitTermination()
    logged = sorted(r[0] for r in lake.read("ops", "dq_log").select("_batch_id").distinct().collect())
    assert logged == ["2017-01", "2017-02"]
    dim = lake.read("gold", "dim_product")
    assert dim.filter("product_id = 'p1'").count() == 2
    # nothing new: the stream does not touch the lake
    before = os.listdir(lake.path("ops", "dq_log"))
    run_stream(spark, lake, batches, checkpoint=ckpt).awaitTermination()
    assert os.listdir(lake.path("ops", "dq_log")) == before
