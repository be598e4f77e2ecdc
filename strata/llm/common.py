"""Helpers the operators share: table access, shared scratch tables, row keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import shared_dir

#: A word: a run of anything but the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table (extra columns are pruned at the scan)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


#: Shuffle files of a step go when its table is written (where Spark knows the setting).
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    Cuts the lineage, survives lost executors and gives the planner real
    sizes. The folder is ``spark.checkpoint.dir`` of the session.
    """
    path = f"{shared_dir(spark)}/strata-llm/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    if before is not None:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is not None:
            spark.conf.set(CLEANUP, before)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def dropped(spark: SparkSession, table: DataFrame) -> None:
    """Delete a table of ``written`` that no later step reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table.written_to)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in smaller ones, so that what a task makes of them at once is small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct ``row``, so that added names cannot clash."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
