"""Batch folders as a file stream.

New raw files under the batches folder are picked up by a Structured
Streaming file source; each micro-batch names the batch ids its files
belong to, and those batches are run through all layers, in order. The
stream's checkpoint remembers which files were seen, so a restarted job
(or a lost driver) resumes where it stopped, and a corrected file dropped
into an old batch folder re-runs that batch (runs are idempotent).

Only file paths flow through the stream: the binary-file source reads a
file's content only when the ``content`` column is selected.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.plans.run import run_batch
from strata.sources.lake import Lake


def batch_of_path(path: Column, batches_dir: str) -> Column:
    """Batch id from a file path: ``.../batch_id=<b>/...`` or
    ``<batches_dir>/<b>/<file>``."""
    root = batches_dir.rstrip("/").split("://")[-1].lstrip("/")
    partitioned = F.regexp_extract(path, r"batch_id=([^/]+)/", 1)
    plain = F.regexp_extract(path, re.escape(root) + r"/([^/]+)/[^/]+$", 1)
    return F.coalesce(F.nullif(partitioned, F.lit("")), F.nullif(plain, F.lit("")))


def batch_files(spark: SparkSession, batches_dir: str, max_files: int | None = None) -> DataFrame:
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = (
        spark.readStream.format("binaryFile")
        .schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.csv")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    files = reader.load(batches_dir).select("path")
    return files.select(batch_of_path(F.col("path"), batches_dir).alias("batch_id")).filter(F.col("batch_id").isNotNull())


def run_stream(
    spark: SparkSession,
    lake: Lake,
    batches_dir: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files: int | None = None,
    prune: bool = False,
    date_range: tuple[str, str] | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there
    and stops (call ``awaitTermination``). The checkpoint belongs to one lake
    and one batches folder; by default it lies under the lake's root."""

    def load(micro: DataFrame, epoch: int) -> None:
        # a handful of ids per micro-batch (one per new batch folder)
        for b in sorted(r.batch_id for r in micro.select("batch_id").distinct().collect()):
            run_batch(lake, batches_dir, b, prune, date_range)

    writer = batch_files(spark, batches_dir, max_files).writeStream.foreachBatch(load).option(
        "checkpointLocation", checkpoint or f"{lake.root}/_streams/{hashlib.sha256(batches_dir.rstrip('/').encode()).hexdigest()[:16]}"
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
