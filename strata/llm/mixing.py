"""Mixing sources to target weights by a low-discrepancy source schedule.

The mix is a sequence of slots, each holding one block of ``BLOCK`` words.
Slot i takes the golden-ratio point frac(i * 0.618...), mapped through the
cumulative weights of the sources, so every prefix of the schedule has the
target proportions. Slots are ranked per source; the k-th slot of a source
takes block k modulo its number of blocks. Blocks are equal runs of words
over the source's documents in a hashed order. A source's last slot is
trimmed, and slots the sequence misses come at its end, so a source gives
exactly the whole words of its target. ``mix`` gives the result in its order:
the slots joined with the pieces of documents in their blocks. The words taken
of a document are the sum of its pieces there.

Nothing here sees a whole source in one task: positions in a source are sums
over about sqrt(n) hash buckets plus a running sum inside a bucket; ranks of
slots likewise over chunks of the schedule.

Defined cases: a null text has no words; a null source is a source of its own,
after the others; a source without words has target 0; repeated rows are
documents of their own and equal rows are interchangeable; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import table, text_or_empty, whole_row, word_count, written

BLOCK = 2048
REPEAT = 3
WEIGHTS = (1, 2, 3)
#: The golden ratio's fraction times 2^32.
GOLDEN, ONE = 2654435769, 1 << 32
CELLS = 1024


def sizes(docs: DataFrame, *carry: str) -> DataFrame:
    """doc_id, source, size and the hashed order of the documents; by the text
    too, so that rows of one doc_id, or of none, lie apart."""
    order = F.md5(F.concat_ws("/", F.lit("mix"), F.col("doc_id").cast("string"), F.md5(text_or_empty().cast("binary"))).cast("binary"))
    return docs.select("doc_id", "source", word_count(text_or_empty()).alias("size"), order.alias("order"), *carry)


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: its weight, its target (a source over REPEAT times
    its size stops there, and the excess is shared again by weight), its
    numbers of blocks and slots, and where its slots lie among all.

    The reshared targets are least(cap, level * weight) for one level; in
    order of cap / weight the capped sources come first. One row per source,
    so its windows are small.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    all_ = Window.partitionBy(F.lit(0))
    by_name = all_.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS))) + 1).cast("int"))
    per = per.withColumn("sid", F.row_number().over(by_name)).withColumn("weight", weight.cast("long"))
    per = per.withColumn("cap", REPEAT * F.col("source_size")).withColumn("total", F.sum("source_size").over(all_))
    by_ratio = all_.orderBy(F.col("cap") / F.col("weight"), "sid")
    level = (F.col("total") - F.sum("cap").over(by_ratio) + F.col("cap")) / (
        F.sum("weight").over(all_) - F.sum("weight").over(by_ratio) + F.col("weight")
    )
    per = per.withColumn("capped", F.col("cap") < level * F.col("weight"))
    left = F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(all_), F.lit(0))
    weights = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(all_)
    per = per.withColumn("level", left / weights)
    per = per.withColumn("target", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight")))
    per = per.withColumn("quota", F.least(F.floor("target"), "cap").cast("long"))
    per = per.withColumn("blocks", F.ceil(F.col("source_size") / BLOCK).cast("long"))
    per = per.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("quota") / F.col("source_size"))).otherwise(0).cast("long"))
    rest = F.col("quota") - F.col("epochs") * F.col("source_size")
    per = per.withColumn("slots", (F.col("epochs") * F.col("blocks") + F.ceil(rest / BLOCK)).cast("long"))
    per = per.withColumn("slots_before", F.sum("slots").over(all_.orderBy("sid")) - F.col("slots"))
    per = per.withColumn("all_slots", F.sum("slots").over(all_))
    return per.withColumn("buckets", F.least(F.lit(65536), F.ceil(F.sqrt("docs"))).cast("long"))


def schedule(spark: SparkSession, sources: DataFrame) -> DataFrame:
    """slot, sid, rank, block, words: the whole mix in order."""
    n = sources.agg(F.max("all_slots")).first()[0] or 0  # one number
    chunk = max(1, int(n**0.5))
    at = (F.col("slot") % F.lit(1 << 31) * F.lit(GOLDEN)) % F.lit(ONE) / F.lit(float(ONE)) * F.lit(float(n))
    points = spark.range(n).select(F.col("id").alias("slot")).withColumn("at", F.least(F.floor(at), F.lit(max(n - 1, 0))))
    cell = lambda x: F.floor(x * CELLS / F.lit(max(n, 1))).cast("int")
    spans = sources.filter("slots > 0").withColumn("slots_end", F.col("slots_before") + F.col("slots"))
    cells = spans.withColumn("cell", F.explode(F.sequence(cell(F.col("slots_before")), cell(F.col("slots_end") - 1))))
    drawn = (
        points.withColumn("cell", cell(F.col("at")))
        .join(cells.select("cell", "sid", "slots_before", "slots_end", "slots"), "cell")
        .filter((F.col("at") >= F.col("slots_before")) & (F.col("at") < F.col("slots_end")))
        .select("slot", "sid", "slots", F.floor(F.col("slot") / chunk).alias("chunk"))
    )
    drawn = written(spark, drawn, "mix-slots")
    counts = drawn.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("sid").orderBy("chunk")) - F.col("n"))
    inside = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1
    ranked = (
        drawn.withColumn("inside", inside)
        .join(before.drop("n"), ["sid", "chunk"])
        .withColumn("rank", (F.col("before") + F.col("inside")).cast("long"))
        .filter("rank < slots")
        .select("slot", "sid", "rank")
    )
    got = counts.groupBy("sid").agg(F.sum("n").alias("got"))
    missing = (
        sources.join(got, "sid", "left")
        .withColumn("got", F.coalesce("got", F.lit(0)))
        .filter("got < slots")
        .withColumn("rank", F.explode(F.sequence(F.col("got"), F.col("slots") - 1)))
        .select((F.lit(n) + F.col("slots_before") + F.col("rank")).alias("slot"), "sid", "rank")
    )
    s = ranked.unionByName(missing).join(sources.filter("slots > 0").select("sid", "blocks", "source_size", "quota"), "sid")
    s = s.withColumn("block", F.col("rank") % F.col("blocks"))
    done = F.floor(F.col("rank") / F.col("blocks")) * F.col("source_size") + F.col("block") * BLOCK
    length = F.least(F.lit(BLOCK), F.col("source_size") - F.col("block") * BLOCK)
    return s.select("slot", "sid", "rank", "block", length.alias("length"), F.least(length, F.col("quota") - done).cast("long").alias("words"))


def positions(sized: DataFrame, sources: DataFrame, *carry: str) -> DataFrame:
    """Each document's first word in its source's hashed order."""
    here = sources.select(F.col("source").alias("source_"), "sid", "source_size", "target", "buckets")
    bucket = F.floor(F.conv(F.substring("order", 1, 4), 16, 10).cast("long") * F.col("buckets") / 65536)
    placed = sized.join(here, F.col("source").eqNullSafe(F.col("source_"))).withColumn("bucket", bucket)
    sums = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    before = sums.withColumn("before", F.sum("n").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("n")).drop("n")
    run = Window.partitionBy("sid", "bucket").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("inside", F.sum("size").over(run) - F.col("size"))
        .join(before, ["sid", "bucket"])
        .select("doc_id", "sid", "size", "source_size", "target", (F.col("before") + F.col("inside")).alias("start"), *carry)
    )


def pieces(at: DataFrame) -> DataFrame:
    """The blocks that the documents of ``positions`` lie in: block, the word of
    the block and of the document where the piece begins, and its words."""
    blocks = F.sequence(F.floor(F.col("start") / BLOCK), F.floor((F.col("start") + F.col("size") - 1) / BLOCK))
    cut = at.filter("size > 0").withColumn("block", F.explode(blocks)).withColumn("block_", F.col("block") * BLOCK)
    at_ = F.greatest(F.col("start") - F.col("block_"), F.lit(0))
    last = F.least(F.col("start") + F.col("size") - F.col("block_"), F.lit(BLOCK))
    first = F.greatest(F.col("block_") - F.col("start"), F.lit(0))
    return cut.withColumn("at", at_).withColumn("first", first).withColumn("words", last - at_).drop("block_")


def slots_with_pieces(spark: SparkSession, sources: DataFrame, at: DataFrame) -> DataFrame:
    """slot, at and words of every piece of a document in the mix, beside the
    columns of ``positions``. A block holds BLOCK words, so at most as many
    pieces; it has a slot for each time it is taken."""
    slots = schedule(spark, sources).select("slot", "sid", "block", F.col("words").alias("due"))
    met = pieces(at).join(slots, ["sid", "block"])
    return met.withColumn("words", F.least("words", F.col("due") - F.col("at")).cast("long")).filter("words > 0").drop("due")


def mix(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The mix itself: per piece of a document its slot, the word of the slot
    where it begins (``at``), the document's doc_id and source, the first word
    taken of it (from 0) and the number of words. In the order of (slot, at),
    every prefix holds the sources near their target shares."""
    sized = written(spark, sizes(docs), "mix-sizes")
    sources = written(spark, targets(sized), "mix-sources")
    out = slots_with_pieces(spark, sources, positions(sized, sources, "source"))
    return out.select("slot", "at", "block", "doc_id", "source", "first", "words")


def taken(spark: SparkSession, sized: DataFrame, *carry: str) -> DataFrame:
    """Words the mix takes of each document: the sum of its pieces in the mix."""
    sources = written(spark, targets(sized), "mix-sources")
    at = written(spark, positions(sized, sources, *carry), "mix-positions")
    columns = ("sid", "start", "doc_id", "size", "source_size", "target", *carry)  # a start is one document's
    none = at.select(*columns, F.lit(0).cast("long").alias("words"))
    parts = slots_with_pieces(spark, sources, at).select(*columns, "words").unionByName(none.filter("size > 0"))
    out = parts.groupBy(*columns).agg(F.sum("words").alias("taken"))
    return out.unionByName(none.filter("size = 0").withColumnRenamed("words", "taken"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's share in the mix."""
    return op2_of(spark, table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op2_of(spark: SparkSession, docs: DataFrame) -> DataFrame:
    sized = written(spark, sizes(docs), "mix-sizes")
    return taken(spark, sized).select("doc_id", "size", "source_size", "target", "taken")


def mixed(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them: a document appears once for every time
    it is taken, the last time cut after the words still due."""
    keyed = docs.select(whole_row(docs), "doc_id", "source", "text", F.xxhash64(text_or_empty()).alias("text_key"))
    sized = written(spark, sizes(keyed, "text_key"), "mix-sizes")
    got = taken(spark, sized, "text_key").join(written(spark, targets(sized), "mix-sources").select("sid", F.col("source").alias("source_")), "sid")
    # equal rows share what they are given
    got = got.groupBy(F.col("doc_id").alias("doc_id_"), "source_", F.col("text_key").alias("text_key_"), "size").agg(F.floor(F.sum("taken") / F.count(F.lit(1))).alias("taken"))
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_")) & F.col("source").eqNullSafe(F.col("source_")) & (F.col("text_key") == F.col("text_key_"))
    times = F.floor((F.col("taken") + F.col("size") - 1) / F.col("size")).cast("int")
    rows = keyed.join(got.filter("taken > 0"), same).withColumn("time", F.explode(F.sequence(F.lit(1), times)))
    due = (F.col("taken") - (F.col("time") - 1) * F.col("size")).cast("int")
    words = F.split("text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")  # each with the blanks behind it
    lead = F.col("text").rlike(r"^[\x20\x09-\x0D]").cast("int")
    text = F.when(due < F.col("size"), F.array_join(F.slice(words, F.lit(1), due + lead), "")).otherwise(F.col("text")).alias("text")
    return rows.select(*[text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


#: Without the schedule: a source's documents in hashed order are taken whole
#: ``epochs`` times, and then the first ``rest`` words.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(concat_ws('/', 'mix', doc_id, md5(coalesce(text, '')))) AS o FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(row_number() OVER (ORDER BY source IS NULL, source) AS BIGINT) AS sid FROM d GROUP BY source),
w AS (SELECT *, (sid - 1) % 3 + 1 AS weight, 3 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s),
l AS (
  SELECT *, cap < weight * (CAST(total - sum(cap) OVER r + cap AS BIGINT) / CAST(sum(weight) OVER () - sum(weight) OVER r + weight AS BIGINT)) AS capped
  FROM w WINDOW r AS (ORDER BY cap / weight, sid)),
t AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE
    CAST(total - coalesce(sum(cap) FILTER (capped) OVER (), 0) AS BIGINT) / CAST(sum(weight) FILTER (NOT capped) OVER () AS BIGINT) * weight END AS target FROM l),
q AS (SELECT *, least(CAST(floor(target) AS BIGINT), 3 * source_size) AS quota FROM t),
p AS (
  SELECT doc_id, size, source_size, target, quota, quota // greatest(source_size, 1) AS epochs,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS first
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, CAST(epochs * size + greatest(0, least(size, quota - epochs * source_size - first)) AS BIGINT) AS taken FROM p
"""
