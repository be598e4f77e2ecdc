"""Raw-source views of the generated test tables.

The engine's sources are nine e-commerce CSV files. The test tables are a
TPC-H-like star schema, so each raw source is derived from them by a
projection (all values as text, as a CSV would deliver them):

==================  ===========================================  ==================
raw source          test table(s)                                 note
==================  ===========================================  ==================
customers           customer + nation (city) + region (state)    zip = nation key
sellers             supplier + nation + region                   zip = nation key
geolocation         events                                        zip = user id
category_translation distinct part.p_type except PROMO            partial lookup
products            part                                          two deliveries
orders              orders                                        dates from priority
order_items         lineitem                                      duplicate keys
order_payments      events of type purchase                       order = user id
order_reviews       events of other types                         review = event pair
==================  ===========================================  ==================

Every frame reads whole tables; nothing is sampled or capped. Some values are
bad on purpose, so that every rule, orphan and choice among records has rows:

* two customer records are one person; poor customers lack the person
* suppliers in debt are delivered once more without their id
* the untranslated category's line in the lookup lacks its name
* the first delivery of size-13 parts has a negative weight
* small orders lack the customer (so their items and payments are orphans);
  partial orders are approved, and great ones delivered, before the purchase
* returned items of quantity 50 have a negative price, small payments a
  negative value; small error events lack the zip
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.sources.specs import BATCH_ID, INGEST_TS

# Fixed values of the test mapping: the batch every source is delivered
# in, the product re-delivery batch and its start, and the category the
# translation lookup lacks.
FIRST_BATCH = "1995-01"
CHANGE_BATCH = "1998-01"
CHANGE_START = "1998-01-01 00:00:00"
UNTRANSLATED = "PROMO"
NEW_PRODUCT_MIN_SIZE = 46  # parts this large first appear in the change batch
BAD_SIZE = 13  # parts of this size weigh less than nothing at first
POOR = -900  # customers below this balance lack the person
SMALL_ORDER = 10000  # orders below this price lack the customer
GREAT_ORDER = 450000  # orders above this price are delivered 20 days early
BAD_QUANTITY = 50  # returned items of this quantity have a negative price
SMALL_EVENT = 2  # payments below this value are negative, error points lack the zip
TS_TEXT = "yyyy-MM-dd HH:mm:ss"
TS_TEXT_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def audit(df: DataFrame, batch_id: str = FIRST_BATCH) -> DataFrame:
    return df.withColumn(INGEST_TS, F.current_timestamp()).withColumn(BATCH_ID, F.lit(batch_id))


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> city and state. No hint: both are tiny files (25 and 5
    rows), and the planner broadcasts them from their measured size."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "left").select(
        "n_nationkey", F.col("n_name").alias("_city"), F.lower("r_name").alias("_state")
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    j = c.join(_places(spark, sf_dir), c["c_nationkey"] == F.col("n_nationkey"), "left")
    return audit(
        j.select(
            text("c_custkey").alias("customer_id"),
            F.when(F.col("c_acctbal") >= POOR, F.concat(F.lit("person-"), text(F.floor(F.col("c_custkey") / 2)))).alias("customer_unique_id"),
            text("c_nationkey").alias("customer_zip_code_prefix"),
            F.col("_city").alias("customer_city"),
            F.col("_state").alias("customer_state"),
        )
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    s = s.withColumn("_id", F.explode(F.when(F.col("s_acctbal") < 0, F.array(text("s_suppkey"), F.lit(None))).otherwise(F.array(text("s_suppkey")))))
    j = s.join(_places(spark, sf_dir), s["s_nationkey"] == F.col("n_nationkey"), "left")
    return audit(
        j.select(
            F.col("_id").alias("seller_id"),
            text("s_nationkey").alias("seller_zip_code_prefix"),
            F.col("_city").alias("seller_city"),
            F.col("_state").alias("seller_state"),
        )
    )


def raw_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per event: latitude floor(value)/4 - 30, longitude
    -40 - floor(value)/8 (large values fall outside the box). Coordinates
    are multiples of 1/8, so sums are exact in any order."""
    e = table(spark, sf_dir, "events")
    whole = F.floor("value")
    return audit(
        e.select(
            F.when(~((F.col("event_type") == "error") & (F.col("value") < SMALL_EVENT)), text("user_id")).alias("geolocation_zip_code_prefix"),
            text(whole / 4 - 30).alias("geolocation_lat"),
            text(F.lit(-40) - whole / 8).alias("geolocation_lng"),
        )
    )


def raw_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return audit(
        p.select("p_type")
        .distinct()
        .select(
            F.when(F.col("p_type") != UNTRANSLATED, F.col("p_type")).alias("product_category_name"),
            F.lower("p_type").alias("product_category_name_english"),
        )
    )


def _product_text(category: Column, weight: Column, photos: Column) -> list[Column]:
    return [
        text("p_partkey").alias("product_id"),
        category.alias("product_category_name"),
        text(F.length("p_name")).alias("product_name_lenght"),
        text(F.length("p_brand") + F.length("p_type")).alias("product_description_lenght"),
        text(photos).alias("product_photos_qty"),
        text(weight).alias("product_weight_g"),
        text("p_size").alias("product_length_cm"),
        text(F.length("p_type")).alias("product_height_cm"),
        text(F.length("p_brand")).alias("product_width_cm"),
    ]


def raw_products_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part; the weight text is the retail price (``'900.1'`` -> 900)."""
    p = table(spark, sf_dir, "part")
    return audit(p.select(*_product_text(F.col("p_type"), _first_weight(), F.length("p_brand") - 6)))


def _first_weight() -> Column:
    return F.when(F.col("p_size") == BAD_SIZE, -F.col("p_retailprice")).otherwise(F.col("p_retailprice"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First delivery of the type-2 entries: the parts below the new-product
    size (the change batch brings all of them)."""
    p = table(spark, sf_dir, "part").filter(F.col("p_size") < NEW_PRODUCT_MIN_SIZE)
    return audit(p.select(*_product_text(F.col("p_type"), _first_weight(), F.length("p_brand") - 6)))


def raw_products_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-delivery of every part in the change batch: red parts move to
    the untranslated category and weigh 10% more (a tracked change), blue
    parts get one more photo (untracked), large parts are new, and the weights
    that were negative are mended."""
    p = table(spark, sf_dir, "part")
    red = F.col("p_name").startswith("red")
    blue = F.col("p_name").startswith("blue")
    category = F.when(red, F.lit(UNTRANSLATED)).otherwise(F.col("p_type"))
    weight = F.when(red, F.floor(F.col("p_retailprice") * 1.1)).otherwise(F.col("p_retailprice"))
    photos = F.length("p_brand") - 6 + F.when(blue, 1).otherwise(0)
    return audit(p.select(*_product_text(category, weight, photos)), CHANGE_BATCH)


def _shifted(ts: Column, days: Column | int, hours: int = 0) -> Column:
    return F.date_format(ts + F.make_dt_interval(F.lit(days) if isinstance(days, int) else days, F.lit(hours)), TS_TEXT)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates from the order date and priority: approved next day
    (partial ones the day before), handed to the carrier after 2 days,
    delivered after 2 x priority days (great ones 20 days earlier) at 10:00,
    estimated after 6 days; open orders (status O) undelivered."""
    o = table(spark, sf_dir, "orders")
    prio = F.substring("o_orderpriority", 1, 1).try_cast("int")
    open_ = F.col("o_orderstatus") == "O"
    d = F.col("o_orderdate")
    approved = F.when(F.col("o_orderstatus") == "P", -1).otherwise(1)
    early = F.when(F.col("o_totalprice") > GREAT_ORDER, 20).otherwise(0)
    return audit(
        o.select(
            text("o_orderkey").alias("order_id"),
            F.when(F.col("o_totalprice") >= SMALL_ORDER, text("o_custkey")).alias("customer_id"),
            F.col("o_orderstatus").alias("order_status"),
            F.date_format(d, TS_TEXT).alias("order_purchase_timestamp"),
            _shifted(d, approved).alias("order_approved_at"),
            F.when(~open_, _shifted(d, 2)).alias("order_delivered_carrier_date"),
            F.when(~open_, _shifted(d, prio * 2 - early, 10)).alias("order_delivered_customer_date"),
            _shifted(d, 6).alias("order_estimated_delivery_date"),
        )
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    bad = (F.col("l_returnflag") == "R") & (F.col("l_quantity") == BAD_QUANTITY)
    price = F.when(bad, -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    return audit(
        li.select(
            text("l_orderkey").alias("order_id"),
            text("l_linenumber").alias("order_item_id"),
            text("l_partkey").alias("product_id"),
            text("l_suppkey").alias("seller_id"),
            F.date_format("l_shipdate", TS_TEXT).alias("shipping_limit_date"),
            text(price).alias("price"),
            text("l_quantity").alias("freight_value"),
        )
    )


def raw_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return audit(
        e.select(
            text("user_id").alias("order_id"),
            text("event_id").alias("payment_sequential"),
            F.upper("event_type").alias("payment_type"),
            text(F.ceil(F.col("value") / 50)).alias("payment_installments"),
            text(F.when(F.col("value") < SMALL_EVENT, -F.col("value")).otherwise(F.col("value"))).alias("payment_value"),
        )
    )


def raw_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review per non-purchase event: two consecutive events share a
    review id, the score is value/40 rounded up (``n/a`` for errors), the
    answer comes floor(value) minutes later, clicks and views have text."""
    e = table(spark, sf_dir, "events").filter(F.col("event_type") != "purchase")
    score = F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(text(F.ceil(F.col("value") / 40)))
    answer = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor("value").cast("int"))
    return audit(
        e.select(
            text(F.floor(F.col("event_id") / 2)).alias("review_id"),
            text("user_id").alias("order_id"),
            score.alias("review_score"),
            F.col("event_type").alias("review_comment_title"),
            F.when(F.col("event_type").isin("click", "view"), F.col("props")).alias("review_comment_message"),
            F.date_format("ts", TS_TEXT_MICROS).alias("review_creation_date"),
            F.date_format(answer, TS_TEXT_MICROS).alias("review_answer_timestamp"),
        )
    )


RAW = {
    "customers": raw_customers,
    "sellers": raw_sellers,
    "geolocation": raw_geolocation,
    "category_translation": raw_category_translation,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "order_payments": raw_order_payments,
    "order_reviews": raw_order_reviews,
}


# Reference sources: delivered once, with the first batch.
REFERENCE_SOURCES = ["customers", "sellers", "products", "geolocation", "category_translation"]
CHILD_SOURCES = ["order_items", "order_payments", "order_reviews"]


COARSE = ("1995-01", CHANGE_BATCH, "2000-01")


def coarse_batch(month: Column) -> Column:
    """The last of the :data:`COARSE` batches that does not begin after a month."""
    out = F.lit(COARSE[0])
    for b in COARSE[1:]:
        out = F.when(month >= b, F.lit(b)).otherwise(out)
    return out


def write_test_batches(spark: SparkSession, sf_dir: str, out_dir: str, coarse: bool = False, wrong: bool = False) -> list[str]:
    """Monthly raw batches of the test tables, as CSV folders
    ``<out>/<source>/batch_id=<month>/``: orders by purchase month, their
    children routed to the same month, reference data in the first month,
    the product re-delivery in the change month. ``coarse``: three batches
    that hold all months; ``wrong``: freight, coordinates and review scores
    are off, for a later correction. Returns the months."""
    from strata.operators.batching import BATCH, write_batches
    from strata.plans.prepare import cut_into_batches

    def raw_text(df: DataFrame) -> DataFrame:
        df = df.drop(BATCH_ID, INGEST_TS)
        off = {"freight_value": "1.00", "geolocation_lat": "-1.0", "review_score": "3"} if wrong else {}
        return df.withColumns({c: F.lit(v) for c, v in off.items() if c in df.columns})

    frames = {name: raw_text(RAW[name](spark, sf_dir)) for name in ("orders", *CHILD_SOURCES, *REFERENCE_SOURCES)}
    months = cut_into_batches(spark, frames, out_dir, coarse_batch if coarse else None)
    changed = raw_text(raw_products_changed(spark, sf_dir)).withColumn(BATCH, F.lit(CHANGE_BATCH))
    write_batches(changed, f"{out_dir}/products", mode="append")
    return months
