"""Plan shapes the scale design relies on."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from strata.catalog import queries
from strata.operators.dedupe import latest_per_key
from strata.plans import aggs
from strata.sources.lake import BUCKET, Lake

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
WRITES_WHEN_BUILT = {"bronze_ingest", "bronze_replace_batch", "incremental_aggregates"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", sorted(set(queries()) - WRITES_WHEN_BUILT))
def test_no_python_udf_no_cross_product(spark, name):
    plan = _plan(queries()[name](spark, SF))
    assert not [f for f in FORBIDDEN if f in plan], plan


def test_aggregates_have_no_expand(spark):
    fact = spark.createDataFrame(
        [(20170101, "o1", "c1", 1.5, 2, True), (20170101, "o1", "c1", 2.5, None, None)],
        "purchase_date_key int, order_id string, customer_key string, price double, delivery_days int, is_late boolean",
    ).select("*", F.col("price").alias("freight_value"), F.col("price").alias("item_total"))
    for agg in (aggs.agg_daily_sales(fact), aggs.agg_customer_ltv(fact)):
        assert "Expand" not in _plan(agg)


def test_dedupe_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().sparkPlan().toString()
    # one WindowGroupLimit below the exchange (partial) and one above it
    assert plan.count("WindowGroupLimit") == 2


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), buckets=8)
    rows = spark.range(200).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"), F.lit("b1").alias("_batch_id"))
    lake.upsert_keyed(rows, "silver", "t", ["k"], version_col="_batch_id")
    root = lake.path("silver", "t")

    def files():
        return {d: sorted(os.listdir(os.path.join(root, d))) for d in os.listdir(root) if d.startswith(BUCKET + "=")}

    before = files()
    one = spark.createDataFrame([("7", -7, "b2")], "k string, v long, _batch_id string")
    lake.upsert_keyed(one, "silver", "t", ["k"], version_col="_batch_id")
    after = files()
    changed = [d for d in before if before[d] != after[d]]
    assert len(before) == 8 and len(changed) == 1
    assert lake.read("silver", "t").filter("k = '7'").collect()[0].v == -7
