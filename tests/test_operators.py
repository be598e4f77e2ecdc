from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from strata.operators import batching
from strata.operators.asof import asof_join
from strata.operators.dedupe import latest_per_key
from strata.operators.merge import scd2_apply, scd2_classify, upsert
from strata.operators.quality import (
    REASON,
    clean_part,
    rejected_part,
    soft_check_counts,
    split_by_rule,
    tag_rejects,
)


# ---- quality ----------------------------------------------------------------
def test_rule_null_counts_as_bad(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id int, v int")
    clean, bad = split_by_rule(df, "v >= 0")
    assert [r.id for r in clean.collect()] == [1]
    assert sorted(r.id for r in bad.collect()) == [2, 3]
    assert {r[REASON] for r in bad.collect()} == {"v >= 0"}


def test_first_failing_rule_is_the_reason(spark):
    df = spark.createDataFrame([(1, 100.0, None), (2, -20.0, "z"), (3, -20.0, None)], "id int, lat double, zip string")
    t = tag_rejects(df, [("outside", "lat BETWEEN -34 AND 6"), ("no zip", "zip IS NOT NULL")])
    reasons = {r.id: r[REASON] for r in t.collect()}
    assert reasons == {1: "outside", 2: None, 3: "no zip"}
    assert clean_part(t).count() + rejected_part(t).count() == df.count()


def test_soft_checks(spark):
    df = spark.createDataFrame(
        [("2017-01-05", "2017-01-04", "2017-01-05"), ("2017-01-05", None, "2017-01-06")],
        "purchase_ts string, delivered_customer_ts string, approved_ts string",
    ).select(*[F.col(c).cast("timestamp").alias(c) for c in ["purchase_ts", "delivered_customer_ts", "approved_ts"]])
    got = {r.soft_check: (r.rows_checked, r.rows_flagged) for r in soft_check_counts(df, {
        "delivered before purchase": "delivered_customer_ts < purchase_ts",
        "approved before purchase": "approved_ts < purchase_ts",
    }).collect()}
    with pytest.raises(AnalysisException, match="shipping_limit_ts"):  # never left out in silence
        soft_check_counts(df, {"shipping limit before purchase": "shipping_limit_ts < purchase_ts"})
    assert got == {"delivered before purchase": (2, 1), "approved before purchase": (2, 0)}


# ---- dedupe -----------------------------------------------------------------
def test_latest_per_key_is_deterministic_on_ties(spark):
    rows = [("k", 1, "b"), ("k", 1, "a"), ("k", 0, "z"), ("j", None, "x"), ("j", 3, "y")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    for parts in (1, 3):
        got = {r.k: (r.t, r.v) for r in latest_per_key(df.repartition(parts), ["k"], ["t"]).collect()}
        assert got == {"k": (1, "b"), "j": (3, "y")}


def test_dedupe_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    plan = latest_per_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


# ---- upsert -----------------------------------------------------------------
def test_upsert_updates_inserts_and_keeps_null_keys(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    source = spark.createDataFrame([("b", 20), ("c", 30), (None, 40)], "k string, v int")
    got = sorted((r.k or "", r.v) for r in upsert(target, source, ["k"]).collect())
    assert got == [("", 3), ("", 40), ("a", 1), ("b", 20), ("c", 30)]


def test_upsert_version_guard_keeps_newer_rows(spark):
    target = spark.createDataFrame([("a", "x", "2017-02"), ("b", "y", "2017-01")], "k string, v string, _batch_id string")
    source = spark.createDataFrame([("a", "old", "2017-01"), ("b", "new", "2017-01")], "k string, v string, _batch_id string")
    got = {r.k: r.v for r in upsert(target, source, ["k"], version_col="_batch_id").collect()}
    assert got == {"a": "x", "b": "new"}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(st.integers(0, 20), st.integers(0, 5), max_size=12),
    st.dictionaries(st.integers(0, 20), st.integers(0, 5), max_size=12),
)
def test_upsert_property_unique_and_idempotent(spark, target_rows, source_rows):
    schema = "k int, v int"
    target = spark.createDataFrame(list(target_rows.items()), schema)
    source = spark.createDataFrame(list(source_rows.items()), schema)
    once = upsert(target, source, ["k"])
    twice = upsert(once, source, ["k"])
    expected = {**target_rows, **source_rows}
    got = {r.k: r.v for r in once.collect()}
    assert got == expected and once.count() == len(expected)
    assert {r.k: r.v for r in twice.collect()} == expected


# ---- type 2 -----------------------------------------------------------------
SCHEMA = "id string, cat string, w int, photos int"


def _load(spark, dim, rows, eff):
    src = spark.createDataFrame(rows, SCHEMA)
    return scd2_apply(dim, src, "id", "sk", ["cat", "w"], eff)


def test_scd2_cases(spark):
    v1 = _load(spark, None, [("p1", "a", 1, 1), ("p2", "b", None, 1), ("p3", "c", 3, 1)], "2017-01-01 00:00:00")
    assert {r.effective_from.year for r in v1.collect()} == {1900}
    v2 = _load(spark, v1, [("p1", "a", 2, 1), ("p2", "b", None, 9), ("p4", "d", 4, 1)], "2017-02-01 00:00:00").cache()
    rows = {(r.id, r.effective_from.month if r.effective_from.year > 1900 else 0): r for r in v2.collect()}
    assert set(rows) == {("p1", 0), ("p1", 2), ("p2", 0), ("p3", 0), ("p4", 2)}
    old, new = rows[("p1", 0)], rows[("p1", 2)]
    assert not old.is_current and old.effective_to == new.effective_from and new.is_current and new.w == 2
    assert rows[("p2", 0)].photos == 1  # untracked change does not version (nor update)
    assert rows[("p3", 0)].is_current  # absent key stays open
    assert v2.select("sk").distinct().count() == v2.count()


def test_scd2_corrected_rerun_replaces_in_place(spark):
    v1 = _load(spark, None, [("p1", "a", 1, 1)], "x")
    v2 = _load(spark, v1, [("p1", "a", 2, 1)], "2017-02-01 00:00:00")
    v2b = _load(spark, v2, [("p1", "a", 3, 1)], "2017-02-01 00:00:00")
    rows = sorted(v2b.collect(), key=lambda r: r.effective_from)
    assert [r.w for r in rows] == [1, 3]
    assert v2b.select("sk").distinct().count() == 2  # no duplicate surrogate key
    same = _load(spark, v2, [("p1", "a", 2, 1)], "2017-02-01 00:00:00")
    assert sorted(map(str, same.collect())) == sorted(map(str, v2.collect()))


def test_scd2_out_of_order_fails(spark):
    v1 = _load(spark, None, [("p1", "a", 1, 1)], "x")
    v2 = _load(spark, v1, [("p1", "a", 2, 1)], "2017-03-01 00:00:00")
    with pytest.raises(Exception, match="out of order"):
        _load(spark, v2, [("p1", "a", 5, 1)], "2017-02-01 00:00:00").collect()


def test_scd2_classify(spark):
    v1 = _load(spark, None, [("p1", "a", 1, 1), ("p2", "b", 2, 1)], "x")
    src = spark.createDataFrame([("p1", "a", 1, 5), ("p2", "b", 3, 1), ("p9", "z", 0, 0)], SCHEMA)
    got = {r.id: r.change for r in scd2_classify(v1, src, "id", ["cat", "w"]).collect()}
    assert got == {"p1": "unchanged", "p2": "changed", "p9": "new"}


def test_asof_join_half_open_interval(spark):
    v1 = _load(spark, None, [("p1", "a", 1, 1)], "x")
    dim = _load(spark, v1, [("p1", "a", 2, 1)], "2017-02-01 00:00:00")
    facts = spark.createDataFrame(
        [("o1", "p1", "2017-01-31 23:59:59"), ("o2", "p1", "2017-02-01 00:00:00"), ("o3", "p1", "2017-03-01 00:00:00"),
         ("o4", "p9", "2017-03-01 00:00:00")],
        "o string, pid string, ts string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    j = asof_join(facts, dim, facts["pid"], dim["id"], facts["ts"])
    got = {r.o: r.w for r in j.collect()}
    assert got == {"o1": 1, "o2": 2, "o3": 2, "o4": None}
    plan = j._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan


# ---- batching ---------------------------------------------------------------
def test_split_and_route(spark):
    parents = spark.createDataFrame(
        [("o1", "2017-01-05 10:00"), ("o2", ""), ("o3", "2017-02-01"), ("o3", "2017-03-01"), ("o4", None)],
        "order_id string, ts string",
    )
    split = batching.split_by_month(parents, "ts")
    assert sorted((r.order_id, r.batch_id) for r in split.collect()) == [
        ("o1", "2017-01"), ("o3", "2017-02"), ("o3", "2017-03")]
    children = spark.createDataFrame([("o1", 1), ("o3", 1), ("o9", 1)], "order_id string, n int")
    routed = batching.route_children(children, batching.month_lookup(split, "order_id"), "order_id")
    assert sorted((r.order_id, r.batch_id) for r in routed.collect()) == [("o1", "2017-01"), ("o3", "2017-03")]
    ref = batching.assign_first_batch(spark.createDataFrame([("x",)], "a string"), split)
    assert ref.collect()[0].batch_id == "2017-01"
    per = {r.batch_id: r.orders for r in batching.batches_per_month(split).collect()}
    assert per == {"2017-01": 1, "2017-02": 1, "2017-03": 1}
