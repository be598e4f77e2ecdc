"""Typed projections of the raw sources, and the entity specs that drive
the silver step (keys, validity rules, dedupe order)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.casts import to_decimal, to_double, to_int, to_ts
from strata.functions.text import clean_city, clean_lower, clean_state, clean_zip
from strata.sources.specs import BATCH_ID, INGEST_TS, META, RAW_RECORD


@dataclass(frozen=True)
class Entity:
    name: str  # silver table
    source: str  # bronze table
    keys: tuple[str, ...]
    rules: tuple[tuple[str, str], ...]  # (reason, SQL rule); first failing one is recorded
    conform: Callable[..., DataFrame]
    order_by: tuple[str, ...] = ()  # dedupe order after batch and ingest time

    def dedupe_order(self) -> list[str]:
        return [BATCH_ID, INGEST_TS, *self.order_by]


def meta(raw: DataFrame) -> list[str]:
    """Audit columns carried through, plus the raw record when present."""
    return [c for c in (*META, RAW_RECORD) if c in raw.columns]


def conform_category(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("product_category_name").alias("category_pt"),
        F.col("product_category_name_english").alias("category_en"),
        *meta(raw),
    )


def conform_customer(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "customer_unique_id",
        clean_zip("customer_zip_code_prefix").alias("zip_prefix"),
        clean_city("customer_city").alias("city"),
        clean_state("customer_state").alias("state"),
        *meta(raw),
    )


def conform_seller(raw: DataFrame) -> DataFrame:
    return raw.select(
        "seller_id",
        clean_zip("seller_zip_code_prefix").alias("zip_prefix"),
        clean_city("seller_city").alias("city"),
        clean_state("seller_state").alias("state"),
        *meta(raw),
    )


def conform_geolocation(raw: DataFrame) -> DataFrame:
    """Typed points; the per-zip collapse happens after the rules."""
    return raw.select(
        clean_zip("geolocation_zip_code_prefix").alias("zip_prefix"),
        to_double("geolocation_lat").alias("lat"),
        to_double("geolocation_lng").alias("lng"),
        *meta(raw),
    )


def point_sums(points: DataFrame, *by: str) -> DataFrame:
    """Per zip prefix (within each ``by``): sums of the coordinates, number of points."""
    return points.groupBy(*by, "zip_prefix").agg(
        F.sum("lat").alias("lat_sum"), F.sum("lng").alias("lng_sum"), F.count(F.lit(1)).alias("n_points"), F.max(INGEST_TS).alias(INGEST_TS)
    )


def centroids(sums: DataFrame) -> DataFrame:
    """One row per zip prefix from its sums of any number of batches."""
    n = F.sum("n_points")
    return sums.groupBy("zip_prefix").agg(
        (F.sum("lat_sum") / n).alias("lat"), (F.sum("lng_sum") / n).alias("lng"), n.alias("n_points"), F.max(INGEST_TS).alias(INGEST_TS), F.max(BATCH_ID).alias(BATCH_ID)
    )


def collapse_geolocation(points: DataFrame) -> DataFrame:
    """One row per zip prefix: centroid and number of points."""
    return centroids(point_sums(points, BATCH_ID))


UNKNOWN_CATEGORY = "unknown"


def conform_product(raw: DataFrame, translation: DataFrame) -> DataFrame:
    """Typed product with its English category: English, else the
    Portuguese name, else ``unknown``.

    The translation is a small lookup; it is not hinted, the planner
    broadcasts it when its measured size is under the threshold.
    """
    tr = translation.select(F.col("category_pt").alias("_tr_pt"), F.col("category_en").alias("_tr_en"))
    p = raw.join(tr, raw["product_category_name"] == tr["_tr_pt"], "left")
    return p.select(
        F.col("product_id"),
        F.col("product_category_name").alias("category_pt"),
        F.coalesce(F.col("_tr_en"), F.col("product_category_name"), F.lit(UNKNOWN_CATEGORY)).alias("category_en"),
        to_int("product_photos_qty").alias("photos_qty"),
        to_int("product_name_lenght").alias("name_length"),
        to_int("product_description_lenght").alias("description_length"),
        to_int("product_weight_g").alias("weight_g"),
        to_int("product_length_cm").alias("length_cm"),
        to_int("product_height_cm").alias("height_cm"),
        to_int("product_width_cm").alias("width_cm"),
        *meta(raw),
    )


def conform_order(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "customer_id",
        clean_lower("order_status").alias("order_status"),
        to_ts("order_purchase_timestamp").alias("purchase_ts"),
        to_ts("order_approved_at").alias("approved_ts"),
        to_ts("order_delivered_carrier_date").alias("delivered_carrier_ts"),
        to_ts("order_delivered_customer_date").alias("delivered_customer_ts"),
        to_ts("order_estimated_delivery_date").alias("estimated_delivery_ts"),
        *meta(raw),
    )


def conform_order_item(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        to_int("order_item_id").alias("order_item_id"),
        "product_id",
        "seller_id",
        to_ts("shipping_limit_date").alias("shipping_limit_ts"),
        to_decimal("price").alias("price"),
        to_decimal("freight_value").alias("freight_value"),
        *meta(raw),
    )


def conform_order_payment(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        to_int("payment_sequential").alias("payment_sequential"),
        clean_lower("payment_type").alias("payment_type"),
        to_int("payment_installments").alias("payment_installments"),
        to_decimal("payment_value").alias("payment_value"),
        *meta(raw),
    )


def conform_order_review(raw: DataFrame) -> DataFrame:
    return raw.select(
        "review_id",
        "order_id",
        to_int("review_score").alias("review_score"),
        F.col("review_comment_title").alias("comment_title"),
        F.col("review_comment_message").alias("comment_message"),
        to_ts("review_creation_date").alias("creation_ts"),
        to_ts("review_answer_timestamp").alias("answer_ts"),
        *meta(raw),
    )


# Validity rules per silver table (the reason recorded in
# quarantine is the rule text, or the named reason for the box test).
RULE_CATEGORY = "category_pt IS NOT NULL"
RULE_CUSTOMER = "customer_id IS NOT NULL AND customer_unique_id IS NOT NULL"
RULE_SELLER = "seller_id IS NOT NULL"
REASON_OUTSIDE = "coordinates outside Brazil"
RULE_INSIDE = "lat BETWEEN -34 AND 6 AND lng BETWEEN -74 AND -34"
RULE_ZIP = "zip_prefix IS NOT NULL"
RULE_PRODUCT = "product_id IS NOT NULL AND (weight_g IS NULL OR weight_g >= 0)"
RULE_ORDER = "order_id IS NOT NULL AND customer_id IS NOT NULL AND purchase_ts IS NOT NULL"
RULE_ORDER_ITEM = (
    "order_id IS NOT NULL AND order_item_id IS NOT NULL AND product_id IS NOT NULL "
    "AND seller_id IS NOT NULL AND price >= 0 AND freight_value >= 0"
)
RULE_PAYMENT = "order_id IS NOT NULL AND payment_sequential IS NOT NULL AND payment_value >= 0"
RULE_REVIEW = "review_id IS NOT NULL AND order_id IS NOT NULL AND review_score BETWEEN 1 AND 5"


def _rule(text: str) -> tuple[tuple[str, str], ...]:
    return ((text, text),)


# Reference data first: products read the translation table.
ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in [
        Entity("category_translation", "category_translation", ("category_pt",), _rule(RULE_CATEGORY), conform_category),
        Entity("customer", "customers", ("customer_id",), _rule(RULE_CUSTOMER), conform_customer),
        Entity("seller", "sellers", ("seller_id",), _rule(RULE_SELLER), conform_seller),
        Entity(
            "geolocation",
            "geolocation",
            ("zip_prefix",),
            ((REASON_OUTSIDE, RULE_INSIDE), (RULE_ZIP, RULE_ZIP)),
            conform_geolocation,
        ),
        Entity(
            "product",
            "products",
            ("product_id",),
            _rule(RULE_PRODUCT),
            conform_product,
        ),
        Entity("order", "orders", ("order_id",), _rule(RULE_ORDER), conform_order, order_by=("purchase_ts",)),
        Entity(
            "order_item",
            "order_items",
            ("order_id", "order_item_id"),
            _rule(RULE_ORDER_ITEM),
            conform_order_item,
            order_by=("shipping_limit_ts",),
        ),
        Entity(
            "order_payment",
            "order_payments",
            ("order_id", "payment_sequential"),
            _rule(RULE_PAYMENT),
            conform_order_payment,
        ),
        Entity(
            "order_review",
            "order_reviews",
            ("review_id", "order_id"),
            _rule(RULE_REVIEW),
            conform_order_review,
            order_by=("creation_ts",),
        ),
    ]
}
