"""Language ID by string kernels.

A text is the set of its n-grams of 1 to 4 characters (presence, not counts:
a blended spectrum). The kernel of two texts is the mean over n of the cosine
of their n-gram sets. Landmarks (training texts) give the Nyström features;
one-versus-rest kernel ridge regression is fitted on a bounded sample of
labelled rows. As the kernel is an inner product of (hashed) n-gram vectors,
landmarks, whitening and ridge weights fold into one matrix of n-grams by
languages, and batches of texts are scored by a sparse matrix product with it.

Only rows outside the held-out fold (crc32 of doc_id as text, modulo 4, is 2)
with a language and a letter are learned from. The sample holds at most
SAMPLE rows and LANDMARKS landmarks, shared evenly by the languages; every
row of the table is scored, over its whole text.

The score shares one among the learned languages, so it cannot say that a
text is of none of them. Its familiarity can: the share of the text's
three-letter n-grams that are usual (in COMMON of the sample's rows or more)
in one of the two languages the classifier puts first, so texts in two
languages are familiar. The least familiarity is NEAR of the sample's median, each row
held against the others; neither depends on the number of languages. A text
of few n-grams says little, so it is judged by the upper bound (CERTAIN
standard deviations, Wilson's interval) of the share it was drawn from; the
n-grams overlap, three to a letter, and count a third each.

Defined cases: a null text, or one without letters, is ``und`` with score 0;
so is every text if there is nothing to learn from. A null doc_id is not held
out. Repeated rows get equal results, ties go to the first language by name,
an empty table gives no rows, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import table, whole_row

ORDERS = 4
#: Hashed n-grams of each order.
BUCKETS = 1 << 14
#: Bounds of the labelled sample and of the landmarks in it.
SAMPLE, LANDMARKS = 1200, 240
RIDGE = 1e-2
#: How sharply the margins become a score.
SHARPNESS = 4.0
#: Matrix rows gathered at once.
CHUNK = 1 << 18
UNKNOWN = "und"
#: The order (from 0) of the n-grams that make a text familiar, the share of a
#: language's rows that hold a usual one, and the least share of the median.
FAMILIAR_ORDER, COMMON, NEAR, CERTAIN = 2, 0.02, 0.7, 3.0


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the text's n-grams (all orders) and their weights: unit
    length in each order. Letters are lower-cased, other runs become a blank."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    codes, inverse = np.unique(points, return_inverse=True)
    letter = np.fromiter((chr(c).isalpha() for c in codes.tolist()), bool, len(codes))[inverse]
    points = np.where(letter, points, np.uint64(32))
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # one blank per run of other characters
    points = np.concatenate([[np.uint64(32)], points[keep], [np.uint64(32)]])
    index, weight, h = [], [], np.zeros(len(points), np.uint64)
    for n in range(ORDERS):
        h = (h[: len(points) - n] + points[n:]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if not len(h):
            break
        present = np.zeros(BUCKETS, bool)
        present[(h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(50)] = True
        found = np.flatnonzero(present)
        index.append(found + n * BUCKETS)
        weight.append(np.full(len(found), 1 / np.sqrt(ORDERS * len(found)), np.float32))
    return np.concatenate(index), np.concatenate(weight)


def has_letters(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def presence(index: np.ndarray) -> np.ndarray:
    """The weights of a text's n-grams, given by their indices."""
    order = index // BUCKETS
    return (1 / np.sqrt(ORDERS * np.bincount(order, minlength=ORDERS)[order])).astype(np.float32)


def likeliest(index: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The places of the two languages of the greatest margins."""
    return np.argsort(-(presence(index) @ matrix[index] + matrix[-1]), kind="stable")[:2]


def fit(rows: list[tuple[str, np.ndarray]]) -> tuple[list[str], np.ndarray]:
    """Languages and the matrix (n-grams x languages + bias row) from (language,
    n-gram indices) pairs; the first ones of each language are landmarks."""
    langs = sorted({lang for lang, _ in rows})
    per = max(1, LANDMARKS // max(1, len(langs)))
    size = ORDERS * BUCKETS

    marks, seen = [], dict.fromkeys(langs, 0)
    for lang, index in rows:
        if seen[lang] < per:
            seen[lang] += 1
            marks.append(index)
    basis = np.zeros((size, len(marks)), np.float32)  # n-grams x landmarks
    for j, index in enumerate(marks):
        basis[index, j] = presence(index)
    kernel = np.stack([presence(index) @ basis[index] for _, index in rows])  # sample x landmarks
    gram = np.stack([presence(index) @ basis[index] for index in marks]).astype(np.float64)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    good = values > 1e-6 * values[-1]
    whiten = vectors[:, good] / np.sqrt(values[good])
    z = np.hstack([kernel @ whiten, np.ones((len(rows), 1))])
    y = np.array([[1.0 if lang == c else -1.0 for c in langs] for lang, _ in rows])
    w = np.linalg.solve(z.T @ z + RIDGE * len(rows) / len(langs) * np.eye(z.shape[1]), z.T @ y)
    return langs, np.vstack([basis @ (whiten @ w[:-1]), w[-1:]]).astype(np.float32)


def score(texts: list[str | None], langs: list[str], matrix: np.ndarray) -> tuple[list[str], list[float]]:
    """Language and score of each text, by batched sparse products."""
    out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
    rows, index, weight, held = [], [], [], 0

    def flush() -> None:
        nonlocal held
        if rows:
            ends = np.cumsum([len(i) for i in index])
            products = matrix[np.concatenate(index)] * np.concatenate(weight)[:, None]
            margins = np.add.reduceat(products, [0, *ends[:-1]]) + matrix[-1]
            e = np.exp(SHARPNESS * (margins - margins.max(axis=1, keepdims=True)))
            best = margins.argmax(axis=1)
            p = e[np.arange(len(rows)), best] / e.sum(axis=1)
            for row, b, s in zip(rows, best.tolist(), p.tolist()):
                out[row] = (langs[b], float(s))
        rows.clear(), index.clear(), weight.clear()
        held = 0

    for row, text in enumerate(texts):
        if langs and has_letters(text):
            i, w = ngrams(text)
            rows.append(row), index.append(i), weight.append(w)
            held += len(i)
            if held > CHUNK:
                flush()
    flush()
    return [lang for lang, _ in out], [s for _, s in out]


def familiarity(index: np.ndarray, counts: np.ndarray, needed: np.ndarray, nearest: np.ndarray, own: int | None = None) -> float:
    """The share of a text's n-grams that are usual in one of the ``nearest``
    languages, its upper bound; ``own``: the language of a sample row, which does not count."""
    held = counts[index[index // BUCKETS == FAMILIAR_ORDER] - FAMILIAR_ORDER * BUCKETS]
    if own is not None:
        held = held - np.eye(1, held.shape[1], own, dtype=held.dtype)
    usual = held >= needed
    n, z = len(usual) / (FAMILIAR_ORDER + 1), CERTAIN
    if not n:
        return 0.0
    p = float(usual[:, nearest].any(axis=1).mean())
    return (p + z * z / (2 * n) + z * np.sqrt(p * (1 - p) / n + (z / (2 * n)) ** 2)) / (1 + z * z / n)


def familiar(rows: list[tuple[str, np.ndarray]], matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Rows that hold each n-gram, by language; how many make it usual; and
    the least familiarity, from (language, n-gram indices) pairs."""
    langs = sorted({lang for lang, _ in rows})
    place = {lang: i for i, lang in enumerate(langs)}
    counts = np.zeros((BUCKETS, len(langs)), np.int32)
    for lang, index in rows:
        counts[index[index // BUCKETS == FAMILIAR_ORDER] - FAMILIAR_ORDER * BUCKETS, place[lang]] += 1
    sizes = np.bincount([place[lang] for lang, _ in rows], minlength=len(langs))
    needed = np.maximum(1, (COMMON * sizes).astype(np.int32))
    least = NEAR * float(np.median([familiarity(index, counts, needed, likeliest(index, matrix), place[lang]) for lang, index in rows])) if rows else 0.0
    return counts, needed, least


def held_out(doc_id: str | Column = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sampled(docs: DataFrame) -> list[tuple[str, np.ndarray]]:
    """(language, n-gram indices) of a bounded sample: first by a hash threshold from the languages'
    counts, then exactly by rank. Tasks turn the sampled texts into n-gram
    indices; only these (at most ORDERS * BUCKETS a row) reach the driver."""
    known = docs.filter(F.col("lang").isNotNull() & ~held_out() & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(SAMPLE).collect()}
    if not counts:
        return []
    per = max(1, SAMPLE // len(counts))
    draw = F.pmod(F.xxhash64(F.lit("lang-sample"), "doc_id", "text"), F.lit(1 << 30))
    limits = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, int(min(1.0, 2 * per / n + 40 / n) * (1 << 30)))])
    drawn = known.withColumn("draw", draw).filter(F.col("draw") < limits[F.col("lang")])
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", F.xxhash64("text")))  # rows that still tie are equal
    sample = drawn.withColumn("rank", rank).filter(F.col("rank") <= per).select("lang", "rank", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index = [ngrams(t)[0].astype(np.int32) if has_letters(t) else None for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(index, pa.list_(pa.int32()))], names=["lang", "rank", "index"])

    rows = sample.mapInArrow(run, "lang string, rank int, index array<int>").filter("index is not null").orderBy("lang", "rank").collect()
    return [(r["lang"], np.asarray(r["index"])) for r in rows]


def train(rows: list[tuple[str, np.ndarray]]) -> tuple[list[str], np.ndarray]:
    return fit(rows) if rows else ([], np.zeros((0, 0), np.float32))


def of_known_languages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows whose text the classifier gives a language in which it is
    familiar; none if there is nothing to learn from."""
    sample = sampled(docs.select("doc_id", "text", "lang"))
    _, matrix = train(sample)
    model = spark.sparkContext.broadcast((matrix, *familiar(sample, matrix)) if sample else None)  # (ORDERS + 1) * BUCKETS rows, a column per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, counts, needed, least = model.value or (None, None, None, 0.0)

        def stay(text: str | None) -> bool:
            if matrix is None or not has_letters(text):
                return False
            index, _ = ngrams(text)
            return familiarity(index, counts, needed, likeliest(index, matrix)) >= least

        for batch in batches:
            stays = list(map(stay, batch.column(0).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(1).filter(pa.array(stays, pa.bool_()))], names=["row"])

    rows = docs.select("text", whole_row(docs))
    return rows.mapInArrow(run, T.StructType([rows.schema["row"]])).select("row.*")


def identify(spark: SparkSession, docs: DataFrame, *keep: str) -> DataFrame:
    """row (a struct of the columns in ``keep``), lang_pred and score of every row."""
    langs, matrix = train(sampled(docs.select("doc_id", "text", "lang")))
    model = spark.sparkContext.broadcast((langs, matrix))  # ORDERS * BUCKETS rows, a column per language
    rows = docs.select("text", whole_row(docs.select(*[F.col(f"`{c}`") for c in keep])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred, p = score(batch.column(0).to_pylist(), *model.value)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(pred, pa.string()), pa.array(p, pa.float64())], names=["row", "lang_pred", "score"])

    out = T.StructType([rows.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, out)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return identify(spark, docs, "doc_id").select("row.doc_id", held_out("row.doc_id").alias("held_out"), "lang_pred", "score")
