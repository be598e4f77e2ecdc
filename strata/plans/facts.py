"""Facts of the star schema (pure DataFrame functions)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import UNKNOWN_KEY, date_key, surrogate_key
from strata.operators.asof import asof_join


def orders_with_person(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the person behind them. Joined before the items, so
    the large item side is shuffled by ``order_id`` once instead of once
    per dimension."""
    o = orders.select(
        "order_id", "customer_id", "order_status", "purchase_ts", "delivered_customer_ts", "estimated_delivery_ts"
    )
    c = customers.select("customer_id", "customer_unique_id")
    return o.join(c, "customer_id", "left")


def fact_order_items(
    items: DataFrame, orders: DataFrame, customers: DataFrame, products: DataFrame, natural_keys: bool = False
) -> DataFrame:
    """Item grain: person, seller and product version valid at purchase.

    Items whose order is unknown are dropped (inner join; count them with
    :func:`orphan_items`). A product without a valid version gets ``-1``.
    With ``natural_keys`` the hash keys are replaced by the business keys
    they hash (product id with version start, seller id, person id).
    ``is_late`` compares timestamps while ``delay_days`` compares dates,
    so delivery at 10:00 on the estimated day is late with 0 days delay.
    """
    i = items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value")
    f = i.join(orders_with_person(orders, customers), "order_id", "inner")
    p = products.select(
        F.col("product_id").alias("_p_id"), "product_key", "effective_from", "effective_to"
    )
    f = asof_join(f, p, f["product_id"], p["_p_id"], f["purchase_ts"])
    delivered, purchased, estimated = F.col("delivered_customer_ts"), F.col("purchase_ts"), F.col("estimated_delivery_ts")
    if natural_keys:
        keys = [
            F.col("product_id"),
            F.col("effective_from").alias("product_valid_from"),
            F.col("seller_id"),
            F.col("customer_unique_id"),
        ]
    else:
        keys = [
            F.coalesce(F.col("product_key"), F.lit(UNKNOWN_KEY).cast("long")).alias("product_key"),
            surrogate_key("seller_id").alias("seller_key"),
            surrogate_key("customer_unique_id").alias("customer_key"),
        ]
    return f.select(
        "order_id",
        "order_item_id",
        *keys,
        date_key(purchased).alias("purchase_date_key"),
        date_key(delivered).alias("delivered_date_key"),
        date_key(estimated).alias("estimated_date_key"),
        "order_status",
        "price",
        "freight_value",
        (F.col("price") + F.col("freight_value")).alias("item_total"),
        F.datediff(delivered, purchased).alias("delivery_days"),
        F.datediff(delivered, estimated).alias("delay_days"),
        (delivered > estimated).alias("is_late"),
    )


def orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items whose order does not exist (dropped by the item fact)."""
    return items.join(orders.select("order_id"), "order_id", "left_anti")


def fact_payments(payments: DataFrame, orders: DataFrame, customers: DataFrame, natural_keys: bool = False) -> DataFrame:
    """Payment grain; payments without an order are kept with key -1."""
    p = payments.select("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value")
    f = p.join(orders_with_person(orders, customers), "order_id", "left")
    person = F.col("customer_unique_id") if natural_keys else surrogate_key("customer_unique_id").alias("customer_key")
    return f.select(
        "order_id",
        "payment_sequential",
        person,
        date_key("purchase_ts").alias("purchase_date_key"),
        "payment_type",
        "payment_installments",
        "payment_value",
    )


def fact_reviews(reviews: DataFrame) -> DataFrame:
    """Review grain: response time in hours from whole seconds."""
    seconds = F.unix_timestamp("answer_ts") - F.unix_timestamp("creation_ts")
    return reviews.select(
        "review_id",
        "order_id",
        "review_score",
        date_key("creation_ts").alias("review_creation_date_key"),
        (seconds / 3600).alias("response_hours"),
        F.col("comment_message").isNotNull().alias("has_comment"),
    )
