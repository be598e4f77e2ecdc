"""End to end over hand-made CSV batches, and the re-run contract."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import fixtures
from strata.plans import reports
from strata.plans.run import list_batches, run_batch
from strata.sources.lake import Lake


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("e2e"))
    batches = os.path.join(root, "batches")
    fixtures.batch_1(batches)
    fixtures.batch_2(batches)
    lake = Lake(spark, os.path.join(root, "lake"), buckets=4)
    logs = {b: run_batch(lake, batches, b) for b in list_batches(lake, batches)}
    return lake, batches, logs


def test_silver_cleanup(loaded):
    lake, _, _ = loaded
    c = {r.customer_id: r for r in lake.read("silver", "customer").collect()}
    assert (c["c1"].zip_prefix, c["c1"].city, c["c1"].state) == ("01310", "Sao Paulo", "SP")
    assert c["c2"].zip_prefix == "12345"
    q = lake.read("silver", "quarantine_customer").collect()
    assert [r.customer_id for r in q] == ["c4"] and "customer_unique_id IS NOT NULL" in q[0]._reject_reason
    t = lake.read("silver", "category_translation")
    assert "category_pt" in t.columns and t.count() == 2


def test_product_category_and_casts(loaded):
    lake, _, _ = loaded
    p = {r.product_id: r for r in lake.read("silver", "product").collect()}
    assert p["p2"].category_en == "sem_traducao" and p["p3"].category_en == "unknown"
    assert p["p2"].weight_g == 225 and p["p3"].weight_g is None and p["p5"].weight_g is None
    q = lake.read("silver", "quarantine_product").collect()
    assert [r.product_id for r in q] == ["p4"]


def test_geolocation_outliers_stay_in_quarantine(loaded):
    lake, _, logs = loaded
    g = lake.read("silver", "geolocation").collect()
    assert len(g) == 1 and g[0].n_points == 3 and abs(g[0].lat + 23.6) < 1e-9
    q = lake.read("silver", "quarantine_geolocation")
    assert q.count() == 3
    row = [r for r in logs["2017-01"] if r[1] == "silver" and r[2] == "geolocation"][0]
    assert row[3:6] == (6, 1, 3)  # raw points in, zips out, points quarantined


def test_orders_items_reviews(loaded):
    lake, _, _ = loaded
    o = {r.order_id: r for r in lake.read("silver", "order").collect()}
    assert o["o2"].approved_ts is None and o["o3"].order_status == "shipped" and "o4" not in o
    items = {(r.order_id, r.order_item_id): r for r in lake.read("silver", "order_item").collect()}
    assert str(items[("o1", 1)].price) == "11.00"  # duplicate key: latest shipping limit
    assert str(items[("o1", 2)].price) == "1.01"
    assert ("o2", 1) not in items and ("o2", 2) not in items
    rev = lake.read("silver", "order_review").collect()
    assert sorted((r.review_id, r.order_id) for r in rev) == [("r1", "o1"), ("r1", "o2")]
    assert [r.comment_message for r in rev if r.order_id == "o1"] == ['bom,\nmuito "bom"']


def test_scd2_dimension_and_asof_fact(loaded):
    lake, _, _ = loaded
    dim = lake.read("gold", "dim_product")
    assert dim.select("product_key").distinct().count() == dim.count()
    assert dim.filter("is_current").groupBy("product_id").count().filter("count > 1").count() == 0
    unknown = dim.filter("product_key = -1").collect()
    assert len(unknown) == 1 and unknown[0].category_en == "unknown"
    keys = {(r.product_id, r.effective_from.year): r.product_key for r in dim.filter("product_key <> -1").collect()}
    fact = {(r.order_id, r.order_item_id): r for r in lake.read("gold", "fact_order_items").collect()}
    assert fact[("o5", 1)].product_key == keys[("p1", 1900)]
    assert fact[("o6", 1)].product_key == keys[("p1", 2017)]
    assert fact[("o3", 1)].product_key == -1
    assert fact[("o1", 1)].is_late is True and fact[("o1", 1)].delay_days == 0
    assert fact[("o3", 1)].is_late is None and fact[("o3", 1)].delivery_days is None
    assert ("o9", 1) not in fact
    pay = {(r.order_id, r.payment_sequential): r for r in lake.read("gold", "fact_payments").collect()}
    assert pay[("o9", 1)].customer_key == -1 and len(pay) == 3
    rev = {(r.review_id, r.order_id): r for r in lake.read("gold", "fact_reviews").collect()}
    assert rev[("r1", "o1")].response_hours == pytest.approx(36.5125) and rev[("r1", "o2")].has_comment is False


def test_reports(loaded):
    lake, _, _ = loaded
    multi = reports.multi_version_products(lake.read("gold", "dim_product"))
    assert _rows(multi, "product_id", "weight_g") == [("p1", 500), ("p1", 600)]
    rev = reports.revenue_by_category(lake.read("gold", "fact_order_items"), lake.read("gold", "dim_product"))
    got = {r.category_en: float(r.revenue) for r in rev.collect()}
    assert got == {"health_beauty": 41.0, "unknown": 23.0, "sem_traducao": 1.01}  # -1 rows meet the unknown member
    health = reports.batch_health(lake.read("ops", "dq_log"))
    assert health.filter("layer = 'gold' AND tbl = 'fact_order_items' AND batch_id = '2017-01'").collect()[0].rows_quarantined == 1


def test_rerun_is_idempotent(loaded, spark):
    lake, batches, _ = loaded
    tables = [("silver", "order_item"), ("gold", "dim_product"), ("gold", "fact_order_items"), ("ops", "dq_log")]

    def snapshot():
        out = {}
        for layer, name in tables:
            df = lake.read(layer, name).drop("_ingest_ts", "logged_at")
            out[name] = sorted(tuple(str(v) for v in r) for r in df.collect())
        return out

    before = snapshot()
    run_batch(lake, batches, "2017-02")
    assert snapshot() == before
    # an older batch replayed after a newer one changes nothing either
    run_batch(lake, batches, "2017-01")
    after = snapshot()
    assert after["dim_product"] == before["dim_product"]
    assert after["fact_order_items"] == before["fact_order_items"]


def test_corrected_rerun_keeps_keys_unique(spark, tmp_path):
    batches = str(tmp_path / "batches")
    fixtures.batch_1(batches)
    fixtures.batch_2(batches)
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    run_batch(lake, batches, "2017-01")
    run_batch(lake, batches, "2017-02")
    fixtures.batch_2(batches, corrected=True)
    run_batch(lake, batches, "2017-02")
    dim = lake.read("gold", "dim_product")
    assert dim.select("product_key").distinct().count() == dim.count()
    assert _rows(dim.filter("product_id = 'p1'"), "weight_g", "is_current") == [(500, False), (650, True)]


def test_rerun_with_empty_file_empties_bronze_slice(spark, tmp_path):
    batches = str(tmp_path / "batches")
    d = fixtures.batch_1(batches)
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    run_batch(lake, batches, "2017-01")
    assert lake.read_batch("bronze", "sellers", "2017-01").count() == 1
    fixtures.write_csv(d, "sellers", [])
    run_batch(lake, batches, "2017-01")
    assert lake.read_batch("bronze", "sellers", "2017-01") is None
    assert lake.read("silver", "seller").count() == 1  # silver is upsert-only
    log = lake.read("ops", "dq_log").filter(F.col("_batch_id") == "2017-01")
    assert log.filter("layer = 'bronze' AND tbl = 'sellers'").collect()[0].rows_in == 0
    assert log.count() == log.select("layer", "tbl").distinct().count()  # replaced, not appended


def test_new_source_column_widens_bronze(spark, tmp_path):
    batches = str(tmp_path / "batches")
    fixtures.batch_1(batches)
    extra = list(fixtures.SOURCES["sellers"].columns) + ["seller_phone"]
    fixtures.write_csv(
        os.path.join(batches, "2017-02"),
        "sellers",
        [{"seller_id": "s2", "seller_zip_code_prefix": "2", "seller_city": "x", "seller_state": "y", "seller_phone": "555"}],
        header=extra,
    )
    lake = Lake(spark, str(tmp_path / "lake"), buckets=4)
    run_batch(lake, batches, "2017-01")
    run_batch(lake, batches, "2017-02")
    bronze = {r.seller_id: r for r in lake.read("bronze", "sellers").collect()}
    assert bronze["s2"].seller_phone == "555" and bronze["s1"].seller_phone is None
    assert sorted(r.seller_id for r in lake.read("silver", "seller").collect()) == ["s1", "s2"]


# Three sanity questions, asked of the registered tables.
SANITY = {
    "versions": """
        WITH many AS (SELECT product_id AS pid, count(product_key) AS versions FROM gold.dim_product GROUP BY product_id)
        SELECT d.product_id, d.weight_g, d.is_current FROM gold.dim_product d JOIN many ON many.pid = d.product_id
        WHERE many.versions >= 2 ORDER BY d.product_id, d.effective_from""",
    "log": "SELECT tbl, layer, rows_in - rows_out AS lost, logged_at FROM ops.dq_log ORDER BY logged_at, layer, tbl",
    "sales": """
        SELECT category_en, CAST(sum(price) AS DOUBLE) AS revenue FROM gold.fact_order_items
        LEFT JOIN gold.dim_product ON fact_order_items.product_key = dim_product.product_key GROUP BY category_en""",
}


def test_sql_runs_over_the_lake(loaded, spark):
    lake, _, _ = loaded
    names = lake.register()
    assert {"gold.dim_product", "ops.dq_log", "gold.fact_order_items"} <= set(names)
    multi = spark.sql(SANITY["versions"]).collect()
    assert [(r.product_id, r.weight_g) for r in multi] == [("p1", 500), ("p1", 600)]
    assert spark.sql(SANITY["log"]).count() == lake.read("ops", "dq_log").count()
    revenue = {r.category_en: float(r.revenue) for r in spark.sql(SANITY["sales"]).collect()}
    assert revenue == {"health_beauty": 41.0, "unknown": 23.0, "sem_traducao": 1.01}


def test_bucket_count_is_fixed_by_the_first_write(spark, tmp_path):
    lake4 = Lake(spark, str(tmp_path / "lake"), buckets=4)
    rows = spark.createDataFrame([(str(i), i, "2017-01") for i in range(50)], "k string, v long, _batch_id string")
    lake4.upsert_keyed(rows, "silver", "t", ["k"], version_col="_batch_id")
    lake16 = Lake(spark, str(tmp_path / "lake"), buckets=16)  # reopened with another setting
    update = spark.createDataFrame([(str(i), -i, "2017-02") for i in range(50)], "k string, v long, _batch_id string")
    lake16.upsert_keyed(update, "silver", "t", ["k"], version_col="_batch_id")
    t = lake16.read("silver", "t")
    assert t.count() == 50 and t.filter("v > 0").count() == 0
    assert lake16.bucket_count(lake16.path("silver", "t")) == 4


def test_header_is_checked_and_bom_stripped(spark, tmp_path):
    from strata.sources.csv import read_header, read_raw
    from strata.sources.specs import SOURCES

    d = str(tmp_path / "b")
    path = fixtures.write_csv(d, "category_translation", [{"product_category_name": "a"}], bom=True)
    assert read_header(spark, path) == ["product_category_name", "product_category_name_english"]
    bad = fixtures.write_csv(d, "sellers", [{"seller_id": "s"}], header=["seller_id", "seller_city"])
    with pytest.raises(ValueError, match="header lacks"):
        read_raw(spark, bad, SOURCES["sellers"], "2017-01")
