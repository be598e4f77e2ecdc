"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's virtual slot is a hash of its ``doc_id`` modulo a fixed number of
slots. Bytes and rows are aggregated per slot, and a small map (one row per
slot and version) says which shard holds a slot. Growing or rebalancing edits
the map, never the records: version v + 1 differs from v only in the moved
slots.

Law of the query: ``key``. ``doc_id`` and the number of shards decide, and
one more shard takes rows only into itself.

Defined cases: a null text has size 16 and the checksum of the empty text;
all rows of one ``doc_id`` (null included, as one key) share a shard, and
each row still gets a position of its own; equal rows are interchangeable;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import table, text_or_empty, written

SLOTS = 16_384
#: Rows of one virtual slot are ranked in this many parts, so that a repeated doc_id is not one task's work.
PARTS = 16
RECORD_OVERHEAD = 16


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32, vslot, part: all a shard plan needs, without the text."""
    text = text_or_empty()
    return docs.select(
        "doc_id",
        (F.octet_length(text) + RECORD_OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id"), F.lit(slots)).cast("int").alias("vslot"),
    ).withColumn("part", F.pmod(F.xxhash64("text_crc32", "size"), F.lit(PARTS)).cast("int"))


def slot_loads(records: DataFrame) -> DataFrame:
    """Rows and bytes of each virtual slot."""
    return records.groupBy("vslot").agg(F.count(F.lit(1)).alias("slot_rows"), F.sum("size").alias("slot_bytes"))


def moves_to(shard: Column) -> Column:
    """Whether a slot moves when ``shard`` is added: one of shard + 1 slots does, by a draw of the slot and the shard."""
    return F.pmod(F.xxhash64(F.lit("slot"), "vslot", shard.cast("int")), F.lit(1 << 40)) < F.lit(float(1 << 40)) / (shard + 1)


def map_of(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """version, vslot, shard: the map for a number of shards, which is also
    its version. It is what ``grown_map`` makes of one shard step by step, so
    it does not depend on how the number was reached: a slot's shard is the
    last one that it moved to."""
    steps = F.sequence(F.lit(0), F.lit(shards - 1))
    last = F.array_max(F.filter(steps, lambda k: (k == 0) | moves_to(k)))
    return spark.range(slots).select(F.lit(shards).alias("version"), F.col("id").cast("int").alias("vslot")).withColumn("shard", last.cast("int"))


def grown_map(current: DataFrame, shards: int) -> DataFrame:
    """The next version of the map for ``shards``, with one more: the new
    shard draws its slots from all others; nothing else moves."""
    moved = F.when(moves_to(F.lit(shards)), F.lit(shards)).otherwise(F.col("shard")).cast("int")
    return current.select(F.lit(shards + 1).alias("version"), "vslot", moved.alias("shard"))


def rebalanced_map(current: DataFrame, loads: DataFrame, shards: int) -> DataFrame:
    """The next version by measured bytes: slots beyond the mean of an overfull
    shard are poured into the shards below it, in order. The map and the loads
    have one row per slot, so the windows here are over ``slots`` rows at most."""
    m = current.join(loads, "vslot", "left").withColumn("slot_bytes", F.coalesce("slot_bytes", F.lit(0)))
    mean = (loads.agg(F.sum("slot_bytes")).first()[0] or 0) / shards  # one number
    upto = F.sum("slot_bytes").over(Window.partitionBy("shard").orderBy("vslot"))
    m = m.withColumn("moves", upto > mean)
    kept = m.filter(~F.col("moves"))
    m = m.filter("moves").withColumn(
        "at", F.sum("slot_bytes").over(Window.partitionBy(F.lit(0)).orderBy("vslot")) - F.col("slot_bytes") / 2.0
    )
    held = kept.groupBy("shard").agg(F.sum("slot_bytes").alias("held"))
    room = (
        current.sparkSession.range(shards)
        .select(F.col("id").cast("int").alias("to"))
        .join(held, F.col("to") == F.col("shard"), "left")
        .withColumn("room", F.lit(mean) - F.coalesce("held", F.lit(0)))
        .withColumn("until", F.sum("room").over(Window.partitionBy(F.lit(0)).orderBy("to")))
        .select("to", (F.col("until") - F.col("room")).alias("from"), "until")
    )
    moved = m.join(F.broadcast(room), (F.col("at") >= F.col("from")) & (F.col("at") < F.col("until")), "left")
    return (
        moved.select("version", "vslot", F.coalesce("to", "shard").alias("shard"))
        .unionByName(kept.select("version", "vslot", "shard"))
        .withColumn("version", F.col("version") + 1)
    )


def place(records: DataFrame, maps: DataFrame, version: int) -> DataFrame:
    """Each record's shard in one version, and its position there (gapless
    from 0): an offset per (slot, part), then a rank inside it."""
    here = maps.filter(F.col("version") == version).select("vslot", "shard")
    offsets = (
        records.groupBy("vslot", "part")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("part_bytes"))
        .join(F.broadcast(here), "vslot")  # SLOTS rows
        .withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("vslot", "part")) - F.col("n"))
        .withColumn("slot_bytes", F.sum("part_bytes").over(Window.partitionBy("shard", "vslot")))
        .select("vslot", "part", "shard", "before", "slot_bytes")
    )
    rank = F.row_number().over(Window.partitionBy("vslot", "part").orderBy("doc_id", "text_crc32", "size"))
    return (
        records.withColumn("rank", rank)
        .join(offsets, ["vslot", "part"])
        .withColumn("slot", (F.col("before") + F.col("rank") - 1).cast("long"))
    )


def op7_sharding(spark: SparkSession, sf_dir: str, shards: int = 40) -> DataFrame:
    """Every document's shard among ``shards``, and its shard with one more."""
    rows = written(spark, records(table(spark, sf_dir, "documents", "doc_id", "text")), "shard-records")
    now = map_of(spark, shards)
    maps = written(spark, now.unionByName(grown_map(now, shards)), "shard-map")
    grown = maps.filter(F.col("version") == shards + 1).select("vslot", F.col("shard").alias("grown_shard"))
    return (
        place(rows, maps, shards)
        .join(F.broadcast(grown), "vslot")  # SLOTS rows
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "vslot", "slot_bytes")
    )
