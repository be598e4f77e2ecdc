"""Periodic runs of words, found on tiles per period octave.

A run is a stretch of words with smallest period q and at least max(LEAST,
TIMES * q) words that neither neighbour continues. Octave k holds the periods
from 2^k to 2^(k+1) - 1 and cuts each document into tiles, each reaching over
the next one by two of the octave's longest periods.

1. A document is split into words, numbered by their first place. Per octave,
   places whose next 2^min(k, 3) words come again within the octave's longest
   period are found; a run leaves a stretch of them, and only tiles that meet
   such a stretch can hold a part of one and are emitted.
2. Tiles are dealt over all tasks and solved alone. At boundaries 2^k apart the
   Z-function of the words after the boundary tells for each period how far
   they repeat, and the Z-function of the reversed words before it how far back.
   These parts are joined within the tile. Parts that end within the tile and
   are too short are done with, as are parts that a shorter period explains.
3. Parts are shuffled by document and period and stitched where they overlap;
   of runs over the same words the least period stays.

A document of any length is thus solved by many tasks. Only its words are
split, and put together without the repeated ones, in one place each.

Defined cases: a null or blank text has no words and no runs; repeated rows and
doc_ids get results of their own text; an empty table gives no rows; extra
columns are ignored. Documents are known by doc_id and SHA-256 of the words.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import in_slices, table, text_or_empty, written

#: A run has at least LEAST words and TIMES periods.
LEAST, TIMES = 6, 4
#: Words of a tile without its overlap: at least this many, and FACTOR of the octave's longest periods.
TILE, FACTOR = 512, 8
#: Words looked at together when places that come again are sought.
GRAM = 8
#: Rows of documents (octave null) and of their tiles.
WORDS = "doc_id long, key binary, n long, words binary, collapsed_sha256 string, octave int, low long, codes binary"
#: Bytes that a task holds of rows not yet handed on.
HELD = 8 << 20
RUNS = "array<struct<start:long,period:long,length:long>>"


# ---- 1: words and tiles -----------------------------------------------------
def recurrences(codes: np.ndarray) -> list[np.ndarray]:
    """For grams of 1, 2, 4 .. GRAM words: the distance from each place to the
    gram's next one (a very large number where there is none)."""
    out, rank, width = [], codes, 1
    while True:
        order = np.argsort(rank, kind="stable")
        same = rank[order[1:]] == rank[order[:-1]]
        away = np.full(len(rank), np.iinfo(np.int64).max)
        away[order[:-1][same]] = (order[1:] - order[:-1])[same]
        out.append(away)
        if width >= GRAM or len(rank) <= width:
            return out
        number = np.empty(len(rank), np.int64)
        number[order] = np.concatenate([[0], np.cumsum(~same)])
        rank = number[:-width] * len(codes) + number[width:]
        width *= 2


def stretches(mask: np.ndarray, least: int) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return [(a, b) for a, b in edges.reshape(-1, 2).tolist() if b - a >= least]


def tiles(codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(octave, first place, words) of the tiles that may hold part of a run."""
    n, away, k = len(codes), None, 0
    while n >= max(LEAST, TIMES << k):
        away = away or recurrences(codes)
        level = min(k, len(away) - 1)
        gram, longest = 1 << level, (2 << k) - 1
        # a run of period p (at least 2^k) has its length - p - gram + 1 such places
        least = max(LEAST - (1 << k), (TIMES - 1) << k) - gram + 1
        core, last = max(TILE, FACTOR * (longest + 1)), -1
        for a, b in stretches(away[level] <= longest, least):
            to = min(n, b + gram + longest)
            # tile t holds the words from t * core up to (t + 1) * core and two longest periods more
            for t in range(max(last + 1, 0, (a - 2 * longest - 2) // core), (to - 1) // core + 1):
                yield k, t * core, codes[t * core : (t + 1) * core + 2 * (longest + 1)]
                last = t
        k += 1


def coded(words: list[bytes]) -> np.ndarray:
    """Words as numbers by first place."""
    number: dict[bytes, int] = {}
    return np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)).astype(np.int64)


def split_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, text, planted): the words, and the tiles of documents
    that may have runs. The others are done: their collapsed text is their words."""
    names = [c.split()[0] for c in WORDS.split(", ")]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
    rows, size = [], 0
    for batch in in_slices(batches, 64):
        for doc_id, text, planted in zip(*(c.to_pylist() for c in batch.columns)):
            words = text.encode().split()  # at the six ASCII blanks
            if planted is not None:
                words = periodic(words, planted)
            n, cut, joined = len(words), False, b" ".join(words)
            sha = hashlib.sha256(joined)
            for octave, low, codes in tiles(coded(words)) if n >= LEAST else ():
                rows.append((doc_id, sha.digest(), n, None, None, octave, low, codes.astype("<i4").tobytes()))
                cut, size = True, size + 4 * len(codes)
                if size > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows, size = [], 0
            rows.append((doc_id, sha.digest(), n, joined if cut else None, None if cut else sha.hexdigest(), None, None, None))
            size += len(joined) if cut else 100
        if size > HELD:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def periodic(words: list[bytes], h: int) -> list[bytes]:
    """The contract's change of a document whose checksum is ``h``."""
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


# ---- 2: one tile ------------------------------------------------------------
def z_function(s: list[int]) -> list[int]:
    """For each place, how many symbols from there equal those from the start."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    if n:
        z[0] = n
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def smallest(words: np.ndarray, start: int, period: int) -> bool:
    """Whether no divisor of ``period`` is a period of the two periods from ``start``."""
    two, left, r = words[start : start + 2 * period], period, 2
    while left > 1:
        if r * r > left:
            r = left
        if left % r == 0:
            q = period // r
            if np.array_equal(two[q:], two[:-q]):
                return False
            while left % r == 0:
                left //= r
        r += 1
    return True


def solve(octave: int, low: int, size: int, words: np.ndarray) -> list[tuple[int, int, int]]:
    """(period, from, to) of the parts in a tile: words i and i + period are
    equal for the places from <= i < to of the document."""
    step, m = 1 << octave, len(words)
    marks = -(-m // step)
    ahead = np.zeros((marks + 1, step), np.int64)  # equal places after boundary b, up to the next one; a column per period
    back = np.zeros((marks + 1, step), np.int64)  # and before it, down to the one before
    listed = words.tolist()
    for b in range(marks):
        at = b * step
        z = z_function(listed[at : at + 3 * step])
        for p in range(step, min(2 * step, len(z))):
            ahead[b, p - step] = min(z[p], step)
        if at:
            turned = listed[at - step : at + 2 * step - 1][::-1]
            right = len(turned) - step  # words from the boundary on
            z = z_function([*turned[right:], -1, *turned])
            for p in range(step, min(2 * step - 1, right) + 1):
                back[b, p - step] = z[step + 1 + right - p]
    full = ahead == step
    # the next boundary at or after b that the equal places do not pass
    ends = np.where(full, marks, np.arange(marks + 1)[:, None])
    ends[marks] = marks
    ends = np.minimum.accumulate(ends[::-1])[::-1]
    opens = np.ones_like(full)
    opens[1:] = ~full[:-1]
    b, c = np.nonzero(opens[:-1])
    end = ends[b, c]
    start, stop, period = b * step - back[b, c], end * step + ahead[end, c], c + step
    whole = ((start > 0) | (low == 0)) & ((stop + period < m) | (low + m >= size))
    # parts that reach an edge have two periods at least, as tiles reach over the next one by two
    keep = stop - start >= np.where(whole, np.maximum(LEAST, TIMES * period) - period, period)
    found = {(int(p), int(s), int(e)) for p, s, e in zip(period[keep], start[keep], stop[keep])}
    return [(p, low + s, low + e) for p, s, e in sorted(found) if smallest(words, s, p)]


def solve_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in in_slices(batches, 256):
        out = [], [], [], [], []
        for doc_id, key, octave, low, size, codes in zip(*(c.to_pylist() for c in batch.columns)):
            for p, a, b in solve(octave, low, size, np.frombuffer(codes, "<i4")):
                for column, v in zip(out, (doc_id, key, p, a, b)):
                    column.append(v)
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=["doc_id", "key", "period", "low", "high"])


# ---- 3: stitched ------------------------------------------------------------
def stitched(parts: DataFrame) -> DataFrame:
    """doc_id, key, start, length, period of the runs from their parts."""
    own = Window.partitionBy("doc_id", "key", "period").orderBy("low", "high")
    before = F.max("high").over(own.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("low") <= F.col("before"), 0).otherwise(1)).over(own)
    whole = parts.withColumn("before", before).withColumn("island", island).groupBy("doc_id", "key", "period", "island")
    runs = whole.agg(F.min("low").alias("start"), (F.max("high") - F.min("low") + F.col("period")).alias("length"))
    runs = runs.filter(F.col("length") >= F.greatest(F.lit(LEAST), TIMES * F.col("period")))
    return runs.groupBy("doc_id", "key", "start", "length").agg(F.min("period").alias("period"))


def find_runs(spark: SparkSession, docs: DataFrame, planted: str | None = None) -> DataFrame:
    """Per document: doc_id, n (words), words (null without runs), its
    collapsed_sha256 where it may have no runs, and its runs (an array by
    start, then period; null without runs). ``planted`` names a column of
    checksums by which texts are changed first."""
    checksum = F.col(planted) if planted else F.lit(None)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), checksum.cast("long").alias("planted"))
    held = written(spark, texts.mapInArrow(split_words, WORDS), "run-words")
    cut = held.filter(F.col("octave").isNotNull()).select("doc_id", "key", "octave", "low", F.col("n").alias("size"), "codes")
    dealt = cut.repartition("doc_id", "key", "octave", "low")
    parts = dealt.mapInArrow(solve_tiles, "doc_id long, key binary, period long, low long, high long")
    found = F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs")
    runs = written(spark, stitched(parts).groupBy("doc_id", "key").agg(found), "runs")
    rows = held.filter(F.col("octave").isNull())
    some, none = rows.filter(F.col("words").isNotNull()).alias("d"), rows.filter(F.col("words").isNull())
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.key") == F.col("r.key"))
    some = some.join(runs.alias("r"), same, "left").select("d.doc_id", "d.n", "d.words", "d.collapsed_sha256", "r.runs")
    return some.unionByName(none.select("doc_id", "n", "words", "collapsed_sha256", F.lit(None).cast(RUNS).alias("runs")))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, without those that a run repeats."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    keep = np.cumsum(drop[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist()) if k])


RESULT = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (doc_id, words, collapsed_sha256, runs) as results."""
    nothing = hashlib.sha256(b"").hexdigest()
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    for batch in in_slices(batches, 256):
        out = []
        for doc_id, words, sha, runs in zip(*(c.to_pylist() for c in batch.columns)):
            found = [(r["start"], r["length"], r["period"]) for r in runs or []]
            if not found:
                out.append((doc_id, 0, None, None, None, None, nothing, sha or hashlib.sha256(words).hexdigest()))
                continue
            start, length, period = min(found, key=lambda r: (-r[1], r[0], r[2]))
            listed = "".join(f"{a},{b},{c}\n" for a, b, c in found).encode()
            text = collapse(words.split(b" "), found)
            out.append((doc_id, len(found), start, length, period, 1000 * length // period, hashlib.sha256(listed).hexdigest(), hashlib.sha256(text).hexdigest()))
        names = [c.split()[0] for c in RESULT.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * 8, kinds)], names=names)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, a tenth of which are made periodic first."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("planted", F.crc32(F.col("doc_id").cast("string")))
    return find_runs(spark, docs, "planted").select("doc_id", "words", "collapsed_sha256", "runs").mapInArrow(summed_up, RESULT)
