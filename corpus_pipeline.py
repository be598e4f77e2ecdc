"""The corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; all but the last return the columns they were given.

1. language_id: rows without letters, and rows whose text is not familiar from
   the labelled sample (language.py; whatever the number of languages), go;
   texts in two languages or of a few words stay.
2. ngram_jaccard_join: of each component of documents alike in five-word
   shingles (0.8 or more) the least doc_id stays.
3. secret_scan: findings are replaced by a mark; the documents stay.
4. source_mixing: a document appears as often as the mix takes it, the last
   time cut where its source's quota ends; documents not taken go.
5. bpe: every row's token ids, digested, and the decoded text's digest.

Nulls, repeated rows and empty tables are as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import bpe, jaccard, language, mixing, secrets
from strata.llm.common import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.of_known_languages(spark, docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(spark, docs, shingle=5, num=80, den=100)


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars follows the text."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secrets.redact(spark, docs))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(mixing.mixed(spark, docs))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(spark, docs)


STAGES = [
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scan", secret_scan),
    ("source_mixing", source_mixing),
    ("bpe", bpe_tokens),
]

#: SQL cannot express the stages; tests/llm compares them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
