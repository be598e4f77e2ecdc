"""Document fingerprints: bottom-k sketches of shingle hashes.

A sketch is the ascending array of the k smallest distinct 64-bit hashes of a
document's shingles (SHINGLE words each; a shorter text is one shingle). It
holds the whole set while the set has at most k shingles. Sketches merge by
union, so parts of a text or corpus can be sketched apart, and two of them
estimate resemblance, containment and the number of distinct shingles.

Defined cases: a null text is the empty text, whose sketch is empty; two
empty sketches are alike (1), an empty and another one are not (0). The next
document is the one with the next greater doc_id (a null doc_id comes first;
after the greatest comes the smallest); where rows repeat a doc_id, the least
text stands for it as a next document, and every row keeps its own result. A
lone document is its own next one. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD, table, text_or_empty, written

SHINGLE = 5
K = 128


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Hashes of all shingles of the whole text, repeats included."""
    words = F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))
    slide = lambda ws: F.transform(
        F.sequence(F.lit(0), F.size(ws) - shingle), lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(shingle)])
    )
    whole = lambda ws: F.when(F.size(ws) == 0, F.expr("array()").cast("array<bigint>")).otherwise(F.array(F.xxhash64(ws)))
    # one-element transform: the words are computed once
    return F.transform(F.array(words), lambda ws: F.when(F.size(ws) >= shingle, slide(ws)).otherwise(whole(ws)))[0]


def sketch(text: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of both sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merged(column: str, k: int = K) -> Column:
    """Aggregate: the sketch of the union of a group's sets. The state holds
    every distinct sketch of the group: for small groups; ``merged_by`` has no
    such bound."""
    empty = F.expr("array()").cast("array<bigint>")
    return F.slice(F.sort_array(F.array_distinct(F.flatten(F.collect_set(F.coalesce(F.col(column), empty))))), 1, k)


def merged_by(df: DataFrame, keys: list[str], column: str, k: int = K) -> DataFrame:
    """The keys, and in ``column`` the sketch of the union of each group's sets.
    Hashes are rows: repeats go within each task first, and so do those behind
    the k least, so that k hashes of a group meet, whatever its size."""
    by = [F.col(f"`{c}`").alias(f"key{i}") for i, c in enumerate(keys)]
    names = [f"key{i}" for i in range(len(keys))]
    rows = df.select(*by, F.explode_outer(F.col(f"`{column}`")).alias("hash")).dropDuplicates()
    rank = F.row_number().over(Window.partitionBy(*names).orderBy(F.col("hash").asc_nulls_last()))
    least = rows.withColumn("rank", rank).filter(F.col("rank") <= k).groupBy(*names).agg(F.sort_array(F.collect_list("hash")).alias("sketch"))
    return least.select(*[F.col(n).alias(c) for n, c in zip(names, keys)], F.col("sketch").alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity: the share of the union's sketch that both hold."""
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Exact below k, else (k - 1) over the share of hash space that k hashes fill."""
    filled = (F.element_at(a, k).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / filled)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b holds too."""
    both = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(both / distinct_shingles(a, k), F.lit(1.0)))


def as_text(sk: Column) -> Column:
    """The sketch as base64 of its big-endian hashes."""
    return F.translate(F.base64(F.unhex(F.array_join(F.transform(sk, lambda h: F.lpad(F.hex(h), 16, "0")), ""))), "\r\n", "")


def from_text(fingerprint: Column) -> Column:
    digits = F.hex(F.unbase64(fingerprint))
    signed = lambda i: F.conv(F.substr(digits, i * 16 + 1, F.lit(16)), 16, -10).cast("bigint")
    return F.when(F.length(digits) == 0, F.expr("array()").cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.floor(F.length(digits) / 16) - 1), lambda i: signed(i.cast("int")))
    )


def next_documents(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """taker, donor, need: each document key's next document, and how many
    characters of it are needed. Range parts are ranked alone; the first key
    of each part closes the part before it (one row per part)."""
    ids = docs.groupBy("key", "doc_id").agg(F.max(F.floor(F.length("text") / 4)).alias("need"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = written(spark, ids.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).withColumn("part", F.spark_partition_id()), "next-ids")
    first = ids.groupBy("part").agg(F.min_by("key", F.struct(F.col("doc_id").isNotNull(), "doc_id")).alias("first"))
    line = Window.partitionBy(F.lit(0)).orderBy("part")
    follow = first.select(
        "part",
        F.coalesce(F.lead("first").over(line), F.first("first").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("follow"),
    )
    after = F.lead("key").over(Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first()))
    return ids.withColumn("after", after).join(follow, "part").select(F.col("key").alias("taker"), F.coalesce("after", "follow").alias("donor"), "need")


def fingerprints(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Each document's fingerprint, its edited text's, and the likenesses."""
    doc_id = F.expr("cast(nullif(key, '') as bigint)")
    # the key stands for doc_id, so that both joins read one exchange of (key, text)
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), text_or_empty().alias("text"))
    links = next_documents(spark, keyed.withColumn("doc_id", doc_id))
    given = (
        keyed.join(links, F.col("key") == F.col("donor"))
        .select("taker", F.struct(F.col("text").substr(F.lit(1), F.col("need").cast("int")).alias("head"), sketch(F.col("text")).alias("sketch")).alias("next"))
        .groupBy("taker")
        .agg(F.min("next").alias("next"))
    )
    n, take = F.length("text"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - take), F.col("next.head").substr(F.lit(1), take))
    out = keyed.join(given, F.col("key") == F.col("taker"), "left").select(
        doc_id.alias("doc_id"), n.cast("long").alias("n_chars"), "text", edited.alias("edited"), F.col("next.sketch").alias("next_sketch")
    )
    # an array of one struct, exploded: the sketches are computed once
    both = F.array(F.struct(sketch(F.col("text")).alias("own"), sketch(F.col("edited")).alias("edited"), F.sha2("edited", 256).alias("sha")))
    return out.select("doc_id", "n_chars", "next_sketch", F.explode(both).alias("s")).select(
        "doc_id",
        "n_chars",
        F.col("s.sha").alias("edited_sha256"),
        as_text(F.col("s.own")).alias("fingerprint"),
        as_text(F.col("s.edited")).alias("edited_fingerprint"),
        resemblance(F.col("s.own"), F.col("s.edited")).alias("near_edited"),
        resemblance(F.col("s.own"), F.col("next_sketch")).alias("near_next"),
        distinct_shingles(F.col("s.own")).alias("distinct_shingles"),
        containment(F.col("s.own"), F.col("s.edited")).alias("contained_in_edited"),
    )


def op4_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    return fingerprints(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
