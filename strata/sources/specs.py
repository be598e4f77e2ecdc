"""The raw sources: one CSV file per entity in every batch folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Source:
    name: str
    file: str
    columns: tuple[str, ...]
    multiline: bool = False  # only needed where quoted fields hold line breaks

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.columns])


# Entity name -> file name and the header columns each raw
# source must have (the ones the pipeline reads; extra columns are kept).
SOURCES: dict[str, Source] = {
    s.name: s
    for s in [
        Source(
            "customers",
            "olist_customers_dataset.csv",
            ("customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"),
        ),
        Source(
            "geolocation",
            "olist_geolocation_dataset.csv",
            ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"),
        ),
        Source(
            "orders",
            "olist_orders_dataset.csv",
            (
                "order_id",
                "customer_id",
                "order_status",
                "order_purchase_timestamp",
                "order_approved_at",
                "order_delivered_carrier_date",
                "order_delivered_customer_date",
                "order_estimated_delivery_date",
            ),
        ),
        Source(
            "order_items",
            "olist_order_items_dataset.csv",
            ("order_id", "order_item_id", "product_id", "seller_id", "shipping_limit_date", "price", "freight_value"),
        ),
        Source(
            "order_payments",
            "olist_order_payments_dataset.csv",
            ("order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"),
        ),
        Source(
            "order_reviews",
            "olist_order_reviews_dataset.csv",
            (
                "review_id",
                "order_id",
                "review_score",
                "review_comment_title",
                "review_comment_message",
                "review_creation_date",
                "review_answer_timestamp",
            ),
            multiline=True,
        ),
        Source(
            "products",
            "olist_products_dataset.csv",
            (
                "product_id",
                "product_category_name",
                "product_name_lenght",
                "product_description_lenght",
                "product_photos_qty",
                "product_weight_g",
                "product_length_cm",
                "product_height_cm",
                "product_width_cm",
            ),
        ),
        Source(
            "sellers",
            "olist_sellers_dataset.csv",
            ("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"),
        ),
        Source(
            "category_translation",
            "product_category_name_translation.csv",
            ("product_category_name", "product_category_name_english"),
        ),
    ]
}

# Audit columns added to every bronze row.
INGEST_TS = "_ingest_ts"
SOURCE_FILE = "_source_file"
BATCH_ID = "_batch_id"
META = [INGEST_TS, BATCH_ID]
# The raw record as JSON text, carried into quarantine so a rejected row
# can be corrected and replayed.
RAW_RECORD = "_raw"
