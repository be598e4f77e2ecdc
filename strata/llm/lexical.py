"""Ranked lexical search: accumulators from short lists, skipping over long ones.

Documents are cut into segments. A segment's postings of the query terms are
lists of (place in the segment, term frequency), by term. For each query and
segment

1. term at a time: the short lists are merged into accumulators, sorted by
   place, each with its summed score;
2. document at a time: the accumulators are one more iterator with an upper
   bound, beside the long lists. All of them move through the segment range by
   range. A range whose upper bounds (the greatest score of each iterator in
   it) sum up to less than the query's k-th best score so far is skipped.
   Elsewhere the iterators are ordered by their bounds; those whose bounds
   together stay below the k-th best score offer no candidates of their own,
   they are only asked about the candidates of the others, and no longer once
   a candidate can not reach the k-th best score.

A task keeps the k best of each query over its segments, so the threshold rises
from segment to segment; a window over tasks x queries x k rows ends the search.
Queries come in blocks of a bounded number of terms, each block's vocabulary is
known to the tasks; the documents' counts and all document frequencies are
counted over the whole table first, from the same segments. Scores are exact
64-bit integers.

Defined cases: terms of all rows of one query id count as one query, once each;
null texts and texts without terms have none, and such documents count nowhere;
rows that repeat a doc_id are documents of their own; a null doc_id stands last
among equal scores; a null query id is an id; empty tables give no rows; extra
columns are ignored. Documents that share score and doc_id rank in any order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import dropped, in_slices, table, text_or_empty, written

#: A term: ASCII letters and digits and everything beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Terms (counted once per query) of a block of queries.
BLOCK_TERMS = 200_000
#: Documents and terms of a segment, at most about.
SEGMENT, SEGMENT_TERMS = 4096, 4_000_000
#: Lists of a query with this share of the segment's documents together are short.
SHORT = 0.25
#: Documents that are passed or skipped together.
RANGE = 1024
SEGMENTS = "documents long, terms long, doc_ids array<long>, lengths array<long>, vocabulary array<int>, counts array<int>, places binary, frequencies binary"
FOUND = "query int, doc_id long, score long"


def folded() -> bytes:
    """The table that lowers A-Z and turns every other non-term byte into a blank."""
    return bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


# ---- the index --------------------------------------------------------------
def segments(vocabulary: dict[bytes, int]):
    """Rows of (doc_id, text) as segments."""
    names = [c.split()[0] for c in SEGMENTS.split(", ")]

    def packed(doc_ids: list, lengths: list[int], codes: list[np.ndarray]) -> pa.RecordBatch:
        n = len(doc_ids)
        code = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        place = np.repeat(np.arange(n), [len(c) for c in codes])
        key, frequency = np.unique(code * n + place, return_counts=True)
        terms, counts = np.unique(key // n, return_counts=True)
        row = [sum(x > 0 for x in lengths), sum(lengths), doc_ids, lengths, terms.tolist(), counts.tolist(), (key % n).astype("<u2").tobytes(), frequency.astype("<u4").tobytes()]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, get = folded(), vocabulary.get
        doc_ids, lengths, codes, held = [], [], [], 0
        for batch in in_slices(batches, 256):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text.encode().translate(fold).split(b" ") if text else []
                code = np.array([-1 if (c := get(w)) is None else c for w in words if w], np.int64)
                doc_ids.append(doc_id)
                lengths.append(len(code))
                codes.append(code[code >= 0])
                held += len(codes[-1])
                if len(doc_ids) >= SEGMENT or held >= SEGMENT_TERMS:
                    yield packed(doc_ids, lengths, codes)
                    doc_ids, lengths, codes, held = [], [], [], 0
        if doc_ids:
            yield packed(doc_ids, lengths, codes)

    return run


# ---- the search -------------------------------------------------------------
class Best:
    """The k best (score, doc_id) of a query so far."""

    def __init__(self, k: int):
        self.k, self.score, self.doc_id, self.null = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.least = 1  # a document with less is not among them

    def add(self, score: np.ndarray, doc_id: np.ndarray, null: np.ndarray) -> None:
        score, doc_id, null = (np.concatenate(x) for x in ((self.score, score), (self.doc_id, doc_id), (self.null, null)))
        order = np.lexsort((doc_id, null, -score))[: self.k]
        self.score, self.doc_id, self.null = score[order], doc_id[order], null[order]
        if len(order) == self.k:
            self.least = max(1, int(self.score[-1]))


class Postings:
    """One term in one segment: places, scores, and each range's end and greatest score."""

    def __init__(self, places: np.ndarray, scores: np.ndarray, edges: np.ndarray):
        self.places, self.scores = places, scores
        self.cut = np.searchsorted(places, edges)
        self.top = np.zeros(len(edges) - 1, np.int64)
        some = np.flatnonzero(np.diff(self.cut))
        if len(some):
            self.top[some] = np.maximum.reduceat(scores, self.cut[some])

    def within(self, r: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.cut[r], self.cut[r + 1]
        return self.places[a:b], self.scores[a:b]


def summed(places: list[np.ndarray], scores: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each place once, in order, with the sum of its scores."""
    place, score = np.concatenate(places), np.concatenate(scores)
    order = np.argsort(place, kind="stable")
    place, score = place[order], score[order]
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.zeros(0, np.int64)
    return place[first], np.add.reduceat(score, first) if len(first) else score


def search(lists: list[Postings], n: int, edges: np.ndarray, best: Best, doc_ids: np.ndarray, null: np.ndarray) -> None:
    """The segment's documents that are among the query's best."""
    lists = sorted(lists, key=lambda x: len(x.places))
    sizes = np.cumsum([len(x.places) for x in lists])
    short = max(1, int(np.searchsorted(sizes, SHORT * n, side="right")))
    iterators = lists[short:]
    iterators.append(Postings(*summed([x.places for x in lists[:short]], [x.scores for x in lists[:short]]), edges))
    for r in range(len(edges) - 1):
        here = sorted((x for x in iterators if x.top[r]), key=lambda x: -x.top[r])
        rest = np.cumsum([0, *[int(x.top[r]) for x in reversed(here)]])[::-1]  # bounds of an iterator and all after it
        if not here or rest[0] < best.least:
            continue
        offers = int(np.count_nonzero(rest >= best.least))  # the iterators after these offer no candidates
        place, score = summed(*zip(*[x.within(r) for x in here[:offers]]))
        for i in range(offers, len(here)):
            can = score + rest[i] >= best.least
            place, score = place[can], score[can]
            if not len(place):
                break
            there, more = here[i].within(r)
            at = np.minimum(np.searchsorted(there, place), len(there) - 1)
            score = score + np.where(there[at] == place, more[at], 0)
        good = score >= best.least
        if good.any():
            best.add(score[good], doc_ids[place[good]], null[place[good]])


def search_segments(queries: list[list[int]], weights: np.ndarray, n_all: int, terms_all: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in queries]
        for batch in in_slices(batches, 1):
            _, _, ids, lengths, vocabulary, counts, places, frequencies = (c[0] for c in batch.columns)
            length = np.asarray(lengths.values).astype(np.int64)
            null = np.asarray(ids.values.is_null())
            doc_ids = np.asarray(ids.values.fill_null(0)).astype(np.int64)
            n = len(length)
            m = 10 + (90 * length * n_all) // terms_all if terms_all else length
            edges = np.arange(0, n + RANGE, RANGE)
            place = np.frombuffer(places.as_py(), "<u2").astype(np.int64)
            tf = np.frombuffer(frequencies.as_py(), "<u4").astype(np.int64)
            ends = np.cumsum([0, *counts.as_py()])
            held = {}
            for i, term in enumerate(vocabulary.as_py()):
                a, b = ends[i], ends[i + 1]
                if weights[term] > 0:
                    held[term] = Postings(place[a:b], weights[term] * ((10**9 * tf[a:b]) // (1000 * tf[a:b] + 8 * m[place[a:b]])), edges)
            for query, b in zip(queries, best):
                if lists := [held[t] for t in query if t in held]:
                    search(lists, n, edges, b, doc_ids, null)
        for at, b in enumerate(best):
            if len(b.score):
                arrays = [pa.array([at] * len(b.score), pa.int32()), pa.array(b.doc_id, pa.int64(), mask=b.null), pa.array(b.score, pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["query", "doc_id", "score"])

    return run


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def query_terms(queries: DataFrame) -> DataFrame:
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    found = F.regexp_extract_all(F.translate(text_or_empty(), upper, lower), F.lit(TERM), F.lit(0))
    return queries.select("query_id", F.explode(found).alias("term")).distinct()


def rank(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, doc_id, score of the k best of ``docs`` (doc_id, text)
    for each of ``queries`` (query_id, text)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    terms = written(spark, query_terms(queries), "query-terms")
    blocks = -(-terms.count() // BLOCK_TERMS)
    kind = queries.schema["query_id"].dataType
    out = spark.createDataFrame([], "query_id long, doc_id long, score long").select(F.col("query_id").cast(kind).alias("query_id"), "doc_id", "score")
    for block in range(blocks):
        rows = terms.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).collect()
        out = out.unionByName(rank_block(spark, texts, [(r.query_id, r.term) for r in rows], k, kind))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def rank_block(spark: SparkSession, texts: DataFrame, rows: list[tuple], k: int, kind) -> DataFrame:
    """The k best of each task for a block's (query_id, term) rows."""
    words = sorted({term.encode() for _, term in rows})
    number = {w: i for i, w in enumerate(words)}
    by_query: dict = {}
    for query_id, term in rows:
        by_query.setdefault(query_id, []).append(number[term.encode()])
    index = written(spark, texts.mapInArrow(segments(number), SEGMENTS), "segments")
    n, terms = index.agg(F.sum("documents"), F.sum("terms")).first()
    each = index.select(F.explode(F.arrays_zip("vocabulary", "counts")).alias("t")).groupBy("t.vocabulary").agg(F.sum("t.counts").alias("df"))
    weights = np.zeros(len(words), np.int64)
    for r in each.collect():  # a row per term of the block
        weights[r["vocabulary"]] = weight(n, r["df"])
    run = search_segments([sorted(q) for q in by_query.values()], weights, n or 0, terms or 0, k)
    found = written(spark, index.mapInArrow(run, FOUND), "found")
    dropped(spark, index)
    known = spark.createDataFrame(list(enumerate(by_query)), f"query int, query_id {kind.simpleString()}")
    return found.join(known, "query").select("query_id", "doc_id", "score")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    items = table(spark, sf_dir, "benchmark", "item_id", "text").withColumnRenamed("item_id", "query_id")
    found = rank(spark, table(spark, sf_dir, "documents", "doc_id", "text"), items)
    return found.select(F.col("query_id").alias("item_id"), "rank", "doc_id", "score")


SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS terms FROM documents),
held AS (SELECT r, doc_id, len(terms) AS n, terms FROM d WHERE len(terms) > 0),
every AS (SELECT count(*) AS n_all, CAST(sum(n) AS BIGINT) AS terms_all FROM held),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM benchmark),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM held) WHERE term IN (SELECT term FROM q) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_all) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, every GROUP BY term),
s AS (SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_all) // terms_all)))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN (SELECT r, n FROM held) USING (r), every GROUP BY item_id, r),
t AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s JOIN (SELECT r, doc_id FROM held) USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM t WHERE rank <= 10
"""
