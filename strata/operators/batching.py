"""Cutting a static dump into monthly batches.

A parent table (orders) is split by the month of a timestamp text; child
tables follow their parent's month; reference tables go to the first
month. Everything is joins and aggregates, so it runs at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH = "batch_id"


def month_of(c: str | Column) -> Column:
    """First 7 characters of a timestamp text (``YYYY-MM``); empty -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.nullif(F.substring(F.coalesce(col, F.lit("")), 1, 7), F.lit(""))


def split_by_month(parents: DataFrame, ts_text: str, batch_col: str = BATCH) -> DataFrame:
    """Parents with a batch column; rows without a month are dropped."""
    return parents.withColumn(batch_col, month_of(ts_text)).filter(F.col(batch_col).isNotNull())


def month_lookup(split_parents: DataFrame, key: str, batch_col: str = BATCH) -> DataFrame:
    """One month per parent key. A key delivered in several months takes
    the latest one (files have no row order on a cluster, so "last seen"
    is defined as the greatest month)."""
    return (
        split_parents.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(batch_col).alias(batch_col))
    )


def route_children(children: DataFrame, lookup: DataFrame, key: str, batch_col: str = BATCH) -> DataFrame:
    """Children get their parent's month; children without a parent are dropped."""
    return children.join(lookup, key, "inner")


def assign_first_batch(reference: DataFrame, split_parents: DataFrame, batch_col: str = BATCH) -> DataFrame:
    """Reference rows all belong to the first month (a scalar subquery,
    evaluated once, not a join)."""
    first = split_parents.select(F.min(batch_col)).scalar()
    return reference.withColumn(batch_col, first)


def batches_per_month(split_parents: DataFrame, batch_col: str = BATCH) -> DataFrame:
    return split_parents.groupBy(batch_col).agg(F.count(F.lit(1)).alias("orders"))


def write_batches(df: DataFrame, out_dir: str, batch_col: str = BATCH, fmt: str = "csv", mode: str = "overwrite") -> None:
    """One folder per month (``batch_id=YYYY-MM``), CSV with a header.

    One exchange by month, rebalanced by its measured sizes: small months share
    a task, and a busy one is split over tasks of about
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` each (months
    whose hash meets the busy one's are split with it). So the files follow
    the size of the months, not tasks times months."""
    writer = df.hint("rebalance", batch_col).sortWithinPartitions(batch_col).write.mode(mode).partitionBy(batch_col)
    if fmt == "csv":
        writer.option("header", True).option("quote", '"').option("escape", '"').csv(out_dir)
    else:
        writer.format(fmt).save(out_dir)
