"""The sanity reports over gold and the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def multi_version_products(dim_product: DataFrame, limit: int | None = 20) -> DataFrame:
    """Versions of the products that have more than one (a semi join on
    the grouped ids), in id and start order."""
    multi = dim_product.groupBy("product_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    rows = dim_product.join(multi.select("product_id"), "product_id", "left_semi").select(
        "product_id", "category_en", "weight_g", "effective_from", "effective_to", "is_current"
    )
    rows = rows.orderBy("product_id", "effective_from")
    return rows.limit(limit) if limit else rows


def batch_health(dq_log: DataFrame) -> DataFrame:
    """Row counts per batch, layer and table, in logging order."""
    return dq_log.select("batch_id", "layer", "tbl", "rows_in", "rows_out", "rows_quarantined").orderBy(
        *([F.col("logged_at")] if "logged_at" in dq_log.columns else []), "batch_id", "layer", "tbl"
    )


def revenue_by_category(fact: DataFrame, dim_product: DataFrame, limit: int | None = 10) -> DataFrame:
    """Top categories by item revenue, each item counted under the product
    version valid when it was bought."""
    p = dim_product.select("product_key", "category_en")
    r = (
        fact.select("product_key", "price")
        .join(p, "product_key")
        .groupBy("category_en")
        .agg(F.round(F.sum("price"), 2).alias("revenue"))
        .orderBy(F.col("revenue").desc(), F.col("category_en"))
    )
    return r.limit(limit) if limit else r
