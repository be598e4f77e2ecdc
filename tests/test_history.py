"""Histories that do not depend on the order of arrival, and as-of joins
that spread a hot key over time."""

from __future__ import annotations

import os

import fixtures
from pyspark.sql import functions as F
from test_replay import customer, seller

from strata.operators.asof import asof_join, asof_join_sliced
from strata.operators.history import versions_of
from strata.operators.merge import scd2_apply
from strata.plans.run import run_batch
from strata.sources.lake import Lake

SCHEMA = "id string, cat string, w int, photos int"
DELIVERIES = {
    "1900-01-01 00:00:00": [("p1", "a", 1, 1), ("p2", None, 2, 1)],
    "2017-02-01 00:00:00": [("p1", "a", 2, 1), ("p2", None, 2, 9), ("p3", "c", None, 1)],
    "2017-03-01 00:00:00": [("p1", "a", 1, 4), ("p2", "b", 2, 1), ("p3", "c", None, 2)],
    "2017-04-01 00:00:00": [("p1", "a", 1, 5), ("p3", None, None, 2)],
}


def rows(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def test_versions_equal_ordered_loads(spark):
    dim, seen = None, None
    for at, said in DELIVERIES.items():
        src = spark.createDataFrame(said, SCHEMA)
        dim = scd2_apply(dim, src, "id", "sk", ["cat", "w"], at)
        part = src.withColumn("observed_at", F.lit(at).cast("timestamp"))
        seen = part if seen is None else part.unionByName(seen)
    assert rows(versions_of(seen, "id", "sk", ["cat", "w"])) == rows(dim)
    assert versions_of(seen.limit(0), "id", "sk", ["cat", "w"]).count() == 0


def write(root, name, **tables):
    for source, said in tables.items():
        fixtures.write_csv(os.path.join(root, name), source, said)


def test_months_in_any_order_give_the_same_history_and_facts(spark, tmp_path):
    batches = str(tmp_path / "batches")
    days = ["2017-01-15 10:00:00", "2017-02-15 10:00:00", "2017-03-15 10:00:00"]
    p = fixtures.product
    said = [
        [p("p1", "a", "100"), p("p2", "a", "100")],
        [p("p1", "a", "200"), p("p2", "a", "100", photos="5"), p("p3", "b", "7")],
        [p("p1", "a", "100"), p("p2", "c", "100"), p("p3", "b", "7")],
    ]
    for i, month in enumerate(("2017-01", "2017-02", "2017-03")):
        write(batches, month, products=said[i], customers=[customer("c1")], sellers=[seller("s1")],
              orders=[fixtures.order(f"o{i}", "c1", days[i])],
              order_items=[fixtures.item(f"o{i}", str(n), f"p{n}", "5.00") for n in (1, 2, 3)])

    def loaded(name, *months):
        lake = Lake(spark, str(tmp_path / name), buckets=3)
        for m in months:
            run_batch(lake, batches, m)
        facts = lake.read("gold", "fact_order_items").select("order_id", "order_item_id", "product_key")
        return lake, rows(lake.read("gold", "dim_product")), rows(facts)

    lake, dim, facts = loaded("in_order", "2017-01", "2017-02", "2017-03")
    assert len(dim) == 1 + 3 + 2 + 1  # unknown, p1 three times, p2 twice, p3 once
    assert loaded("late", "2017-01", "2017-03", "2017-02")[1:] == (dim, facts)
    assert loaded("first_last", "2017-02", "2017-03", "2017-01")[1:] == (dim, facts)

    # a correction of a batch in the middle takes its version back
    write(batches, "2017-02", products=[p("p1", "a", "100"), *said[1][1:]])
    run_batch(lake, batches, "2017-02")
    kept = lake.read("gold", "dim_product").filter("product_id = 'p1'").collect()
    assert [(r.weight_g, r.effective_from.year, r.is_current) for r in kept] == [(100, 1900, True)]
    keys = {r.product_key for r in lake.read("gold", "fact_order_items").filter("order_item_id = 1").collect()}
    assert keys == {kept[0].product_key}


def test_sliced_asof_equals_plain_one_and_spreads(spark):
    versions = spark.sql(
        "SELECT id AS v_id, v, timestamp(f) AS effective_from, timestamp(t) AS effective_to FROM VALUES "
        "('hot', 1, '1900-01-01', '2017-02-10 12:00:00'), ('hot', 2, '2017-02-10 12:00:00', '2017-02-11'), "
        "('hot', 3, '2017-02-11', '2017-09-01'), ('cold', 4, '2017-03-01', NULL), ('none', 5, '1900-01-01', NULL) AS t(id, v, f, t)"
    )
    hours = spark.range(24 * 365).select(
        F.when(F.col("id") % 50 == 0, F.lit(None)).when(F.col("id") % 7 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("k"),
        F.when(F.col("id") % 90 != 0, F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2017-01-01").cast("timestamp"))).alias("ts"),
    )
    plain = asof_join(hours, versions, hours["k"], versions["v_id"], hours["ts"]).select("k", "ts", "v")
    for limit in (0, 2000, 10**9):
        sliced = asof_join_sliced(hours, versions, "k", "v_id", "ts", hot_rows=limit)
        assert rows(sliced.select("k", "ts", "v")) == rows(plain)
    sliced = asof_join_sliced(hours, versions, "k", "v_id", "ts", hot_rows=2000)
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert asof_join_sliced(hours.limit(0), versions, "k", "v_id", "ts").count() == 0
