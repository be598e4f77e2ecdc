"""Split a raw dump of the nine sources into monthly batch folders."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.batching import BATCH, assign_first_batch, month_lookup, route_children, split_by_month, write_batches
from strata.session import together, without_call_sites
from strata.sources.csv import read_raw
from strata.sources.specs import META, SOURCE_FILE, SOURCES

ORDERS = "orders"
CHILDREN = ("order_items", "order_payments", "order_reviews")


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _header_only(spark: SparkSession, folder: str, columns: list[str]) -> None:
    """A file without rows where a month has none, so that loading the month
    again empties its slice."""
    fs, p = _fs(spark, folder)
    if fs.exists(p):
        return
    out = fs.create(_fs(spark, f"{folder}/part-header.csv")[1], True)
    try:
        out.write(bytearray((",".join(columns) + "\n").encode()))
    finally:
        out.close()


@without_call_sites()
def cut_into_batches(
    spark: SparkSession, frames: dict[str, DataFrame], out_dir: str, batch_of: Callable[[Column], Column] | None = None
) -> list[str]:
    """Write ``<out>/<source>/batch_id=<month>/`` for every frame: orders by
    purchase month, their children in the same month, everything else in the
    first month. ``batch_of`` may put months together. Returns the batches;
    a dump without any month is an error."""
    orders = split_by_month(frames[ORDERS], "order_purchase_timestamp")
    if batch_of is not None:
        orders = orders.withColumn(BATCH, batch_of(F.col(BATCH)))
    batches = sorted(r[0] for r in orders.select(BATCH).distinct().collect())  # one per month
    if not batches:
        raise ValueError("no order has a purchase month: there is nothing to split by")
    lookup = month_lookup(orders, "order_id").persist()  # every child joins it
    first = spark.createDataFrame([(batches[0],)], f"{BATCH} string")

    def write(name: str, df: DataFrame) -> None:
        if name == ORDERS:
            write_batches(orders, f"{out_dir}/{ORDERS}")
            return
        child = name in CHILDREN
        write_batches(route_children(df, lookup, "order_id") if child else assign_first_batch(df, first), f"{out_dir}/{name}")
        for b in batches if child else batches[:1]:
            _header_only(spark, f"{out_dir}/{name}/{BATCH}={b}", df.columns)

    try:
        together(spark, [partial(write, *named) for named in frames.items()])
    finally:
        lookup.unpersist()
    return batches


def prepare_batches(spark: SparkSession, raw_dir: str, out_dir: str) -> list[str]:
    """The raw files of ``raw_dir`` (those of the nine sources that are there;
    orders must be), split into monthly batches."""
    frames = {}
    for name, source in SOURCES.items():
        path = f"{raw_dir.rstrip('/')}/{source.file}"
        fs, p = _fs(spark, path)
        if fs.exists(p):
            frames[name] = read_raw(spark, path, source, "").drop(*META, SOURCE_FILE)
    if ORDERS not in frames:
        raise ValueError(f"{raw_dir} holds no {SOURCES[ORDERS].file}")
    return cut_into_batches(spark, frames, out_dir.rstrip("/"))
