"""Dimensions of the star schema (pure DataFrame functions)."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.keys import date_key, surrogate_key
from strata.operators.history import versions_of
from strata.operators.merge import INITIAL_EFFECTIVE_FROM, replace_keys, scd2_apply
from strata.sources.specs import BATCH_ID

# The product attributes kept per version, and the ones whose
# change opens a new version (the rest are frozen at version creation).
PRODUCT_ATTRS = [
    "product_id",
    "category_pt",
    "category_en",
    "weight_g",
    "length_cm",
    "height_cm",
    "width_cm",
    "photos_qty",
    "name_length",
    "description_length",
]
PRODUCT_TRACKED = ["category_pt", "category_en", "weight_g", "length_cm", "height_cm", "width_cm"]


def calendar(dates: DataFrame) -> DataFrame:
    """Date dimension rows for a one-column frame of dates."""
    d = F.col("date")
    return dates.select(
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day of a range (``spark.range`` spreads the days over
    tasks instead of exploding one array in one task)."""
    days = (date.fromisoformat(end) - date.fromisoformat(start)).days + 1
    return calendar(spark.range(days).select(F.date_add(F.to_date(F.lit(start)), F.col("id").cast("int")).alias("date")))


def dim_date_covering(spark: SparkSession, ts: DataFrame, col: str) -> DataFrame:
    """Date dimension spanning the dates of ``ts[col]`` (its min to max)."""
    bounds = ts.agg(F.min(F.to_date(col)).alias("lo"), F.max(F.to_date(col)).alias("hi")).first()
    if bounds["lo"] is None:
        return calendar(spark.createDataFrame([], "date date"))
    return dim_date(spark, str(bounds["lo"]), str(bounds["hi"]))


def latest_location(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Each person (``customer_unique_id``) with the customer record of
    their latest order; people without orders are kept.

    Orders are first reduced to their latest purchase per ``customer_id``
    (partial aggregation before the shuffle), so the window runs over
    customer records, not over all orders. Ties on the purchase time are
    broken by the record's own columns, so the pick is deterministic.
    """
    last = orders.groupBy("customer_id").agg(F.max("purchase_ts").alias("purchase_ts"))
    c = customers.select("customer_id", "customer_unique_id", "zip_prefix", "city", "state")
    j = c.join(last, "customer_id", "left")
    w = Window.partitionBy("customer_unique_id").orderBy(
        F.col("purchase_ts").desc_nulls_last(),
        F.col("customer_id").desc_nulls_last(),
        F.col("zip_prefix").desc_nulls_last(),
        F.col("city").desc_nulls_last(),
        F.col("state").desc_nulls_last(),
    )
    return j.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn", "purchase_ts")


def _with_place(df: DataFrame, geo: DataFrame) -> DataFrame:
    g = geo.select(F.col("zip_prefix").alias("_g_zip"), "lat", "lng")
    return df.join(g, df["zip_prefix"] == g["_g_zip"], "left").drop("_g_zip")


def dim_customer(customers: DataFrame, orders: DataFrame, geo: DataFrame) -> DataFrame:
    """Type-1 customer dimension at person grain, full rebuild."""
    latest = _with_place(latest_location(customers, orders), geo)
    return latest.select(
        surrogate_key("customer_unique_id").alias("customer_key"),
        "customer_unique_id",
        "zip_prefix",
        "city",
        "state",
        "lat",
        "lng",
    )


def dim_customer_of(touched: DataFrame, customers: DataFrame, orders: DataFrame, geo: DataFrame) -> DataFrame:
    """Dimension rows of the touched people only: just their customer
    records, and just those customers' orders (semi joins)."""
    records = customers.join(touched.select("customer_unique_id"), "customer_unique_id", "left_semi")
    their_orders = orders.join(records.select("customer_id"), "customer_id", "left_semi")
    return dim_customer(records, their_orders, geo)


def refresh_dim_customer(
    dim: DataFrame, customers: DataFrame, orders: DataFrame, geo: DataFrame, touched: DataFrame
) -> DataFrame:
    """``dim`` with the touched people recomputed."""
    return replace_keys(dim, dim_customer_of(touched, customers, orders, geo), touched, ["customer_unique_id"])


def dim_seller(sellers: DataFrame, geo: DataFrame) -> DataFrame:
    """Type-1 seller dimension, full rebuild."""
    s = _with_place(sellers.select("seller_id", "zip_prefix", "city", "state"), geo)
    return s.select(surrogate_key("seller_id").alias("seller_key"), "seller_id", "zip_prefix", "city", "state", "lat", "lng")


def batch_start(batch_id: str) -> str:
    """Start of validity of versions loaded by a batch: its first day."""
    if re.fullmatch(r"\d{4}-\d{2}", batch_id):
        return f"{batch_id}-01 00:00:00"
    if re.fullmatch(r"\d{4}-\d{2}-\d{2}", batch_id):
        return f"{batch_id} 00:00:00"
    raise ValueError(f"batch id {batch_id!r} is neither YYYY-MM nor YYYY-MM-DD")


def product_source(products: DataFrame) -> DataFrame:
    return products.select(*PRODUCT_ATTRS)


def dim_product(dim: DataFrame | None, products: DataFrame, batch_id: str | None) -> DataFrame:
    """Type-2 product dimension after loading ``products`` (one per id).

    ``dim`` None is the first load (versions valid from 1900-01-01).
    ``batch_id`` None loads into that first version again: what the first
    batch delivered is corrected in place."""
    eff = batch_start(batch_id) if batch_id else f"{INITIAL_EFFECTIVE_FROM} 00:00:00"
    return scd2_apply(dim, product_source(products), "product_id", "product_key", PRODUCT_TRACKED, eff)


def dim_product_seen(seen: DataFrame, first_batch: str) -> DataFrame:
    """Type-2 product dimension from what each batch said (``_batch_id`` and
    the product's attributes): what the first batch said is valid from the
    start, what any other said from the batch's first day. Of two batches
    that begin on one day the greater one counts."""
    begins = F.when(F.col(BATCH_ID) == first_batch, F.lit(INITIAL_EFFECTIVE_FROM)).otherwise(
        F.when(F.length(BATCH_ID) == 7, F.concat(BATCH_ID, F.lit("-01"))).otherwise(F.col(BATCH_ID))
    )
    said = F.max_by(F.struct(*[c for c in PRODUCT_ATTRS if c != "product_id"]), BATCH_ID)
    per_day = seen.groupBy("product_id", begins.cast("timestamp").alias("observed_at")).agg(said.alias("said"))
    return versions_of(per_day.select("product_id", "said.*", "observed_at"), "product_id", "product_key", PRODUCT_TRACKED)


def unknown_product(spark: SparkSession) -> DataFrame:
    """The ``-1`` member facts point to when no version matches."""
    return spark.createDataFrame(
        [("<unknown>", None, "unknown", None, None, None, None, None, None, None, None, None, None, True, -1)],
        "product_id string, category_pt string, category_en string, weight_g int, length_cm int, "
        "height_cm int, width_cm int, photos_qty int, name_length int, description_length int, _hash string, "
        "effective_from timestamp, effective_to timestamp, is_current boolean, product_key long",
    )
