"""Exact top-k search by multi-resolution segment statistics.

Vectors are cut into 4, 8 and 16 segments; each keeps its mean and deviation.
For any two vectors the distance between their segment statistics bounds
their distance from below (so the inner product, given the norms, from
above). A query first scores the candidates with the best coarse bounds,
which gives a threshold; bounds from coarse to fine drop candidates that
cannot reach it, and the survivors are scored exactly in integers.

Candidates and queries are dealt into blocks of bounded size by a hash, each
pair of blocks is one task's work, and each gives at most k rows per query,
ranked again over all blocks. All queries meet all candidates.

Defined cases: vectors that are null or hold a null or non-finite component
take no part, nor do rows without vec_id; only vectors of equal length are
compared; every row is a candidate, but for those with the query's own
vec_id; equal rows of a query are one query; ties go to the smaller vec_id;
scores that no long holds count as the nearest one, and scaled components
beyond +-2^62 as that; an empty table gives no rows and extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import table, written

K = 5
SCALE = 256
EVERY = 50
LEVELS = (4, 8, 16)
#: Rows of a block of candidates and of a block of queries.
CANDIDATES, QUERIES = 4096, 1024
#: Candidates per query scored first (at least k), for the threshold.
SEEDS = 32
#: Queries bounded at once (a matrix of STEP x CANDIDATES bounds).
STEP = 128
#: Scaled components beyond it are held to it.
HELD = 1 << 62
LONG = (1 << 63) - 1
FOUND = "query_id long, query_key long, vec_id long, score long"


def quantised(rows: DataFrame) -> DataFrame:
    """vec_id, v: the usable vectors as integers."""
    x = F.col("embedding")
    usable = x.isNotNull() & F.col("vec_id").isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    held = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(HELD))), F.lit(float(-HELD)))
    return rows.filter(F.coalesce(usable, F.lit(False))).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(held(c))).alias("v"))


def statistics(v: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each vector's segments, times the root of the
    segment's length: the inner product of two rows bounds the vectors' own."""
    parts = v.reshape(len(v), segments, -1)
    mean, std = parts.mean(axis=2), parts.std(axis=2)
    return np.hstack([mean, std]) * np.sqrt(parts.shape[2])


def exact_scores(vectors: np.ndarray, query: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Inner products; ``reach`` bounds their sizes. Sums that pass the range
    of a long and come back are right in 64 bits; those that may end beyond it
    are made of Python's integers and held to +-LONG."""
    out = vectors @ query
    for i in np.flatnonzero(reach >= float(HELD)).tolist():
        out[i] = max(-LONG, min(LONG, sum(a * b for a, b in zip(vectors[i].tolist(), query.tolist()))))
    return out


def search(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int = K) -> list[tuple[int, int, int]]:
    """(query's row, vec_id, score) of each query's k best."""
    if not len(queries) or not len(vectors):
        return []
    pad = -queries.shape[1] % LEVELS[-1] if queries.shape[1] else LEVELS[-1]
    q, x = (np.pad(a.astype(np.float64), ((0, 0), (0, pad))) for a in (queries, vectors))
    mine, theirs = ([statistics(a, s) for s in LEVELS] for a in (q, x))
    own, norm = np.sqrt((q**2).sum(axis=1)), np.sqrt((x**2).sum(axis=1))
    out = []
    for at in range(0, len(q), STEP):
        bounds = mine[0][at : at + STEP] @ theirs[0].T
        bounds[query_ids[at : at + STEP, None] == ids[None, :]] = -np.inf
        for i, bound in enumerate(bounds, at):
            able = int((bound > -np.inf).sum())
            if not able:
                continue
            reach = norm * own[i]
            slack = 1e-9 * reach + 0.5  # of floating sums, for each candidate
            seeds = min(max(SEEDS, k), able)
            first = np.argpartition(-bound, seeds - 1)[:seeds]
            known = np.sort(exact_scores(vectors[first], queries[i], reach[first]).astype(np.float64))
            floor = known[-k] - 1e-12 * abs(known[-k]) if seeds >= k else -np.inf
            floor = min(floor, float(HELD))  # beyond it scores may be held
            left = np.flatnonzero((bound + slack >= floor) & (bound > -np.inf))
            for level in range(1, len(LEVELS)):
                left = left[theirs[level][left] @ mine[level][i] + slack[left] >= floor]
            exact = exact_scores(vectors[left], queries[i], reach[left])
            best = np.lexsort((ids[left], -exact))[:k]
            out += [(i, int(ids[left[b]]), int(exact[b])) for b in best]
    return out


def top_k(spark: SparkSession, rows: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score for the queries (vec_id divisible by ``every``)."""
    vectors = written(spark, quantised(rows), "search-vectors")
    queries = vectors.filter(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"]).withColumn("query_key", F.xxhash64("vec_id", "v"))
    queries = written(spark, queries, "search-queries")
    n, m = vectors.count(), queries.count()
    blocks, sets = max(1, -(-n // CANDIDATES)), max(1, -(-m // QUERIES))
    place = lambda key, count: F.pmod(F.xxhash64(F.lit("place"), key), F.lit(count)).cast("int")
    every_ = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    mine = queries.select("vec_id", "query_key", "v", F.size("v").alias("dims"), place(F.col("query_key"), sets).alias("part"), every_(blocks).alias("block"))
    theirs = vectors.select("vec_id", "v", F.size("v").alias("dims"), place(F.struct("vec_id", "v"), blocks).alias("block"), every_(sets).alias("part"))
    keys = ("dims", "part", "block")

    def matrix(t: pa.Table) -> np.ndarray:
        flat = t.column("v").combine_chunks()
        flat = pa.concat_arrays(flat.chunks) if isinstance(flat, pa.ChunkedArray) else flat
        return flat.flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1).astype(np.int64)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "query_key": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        query_ids, query_keys = left.column("vec_id").to_numpy(), left.column("query_key").to_numpy()
        found = search(matrix(left), query_ids, matrix(right), right.column("vec_id").to_numpy(), k)
        row = np.array([f[0] for f in found], np.int64)
        return pa.table({"query_id": query_ids[row], "query_key": query_keys[row], "vec_id": pa.array([f[1] for f in found], pa.int64()), "score": pa.array([f[2] for f in found], pa.int64())})

    found = mine.groupBy(*keys).cogroup(theirs.groupBy(*keys)).applyInArrow(run, FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best candidates of every query."""
    return top_k(spark, table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
