"""Raw CSV scan of one batch folder: all strings plus audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.text import clean_header
from strata.sources.specs import BATCH_ID, INGEST_TS, SOURCE_FILE, Source

BROKEN = "_broken_line"


def _first_csv(spark: SparkSession, path: str):
    """The file itself, or the first CSV part file of a folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(p).isDirectory():
        parts = sorted(
            (st.getPath() for st in fs.listStatus(p) if st.isFile() and st.getPath().getName().endswith(".csv")),
            key=lambda q: q.getName(),
        )
        return fs, (parts[0] if parts else None)
    return fs, p


def raw_header(spark: SparkSession, path: str) -> list[str] | None:
    """Header names of a CSV file (or of a folder's first part file) as the
    parser sees them, read on the driver through the Hadoop file system: one
    line, no Spark job. None when there is no line."""
    fs, p = _first_csv(spark, path)
    if p is None:
        return None
    jvm = spark.sparkContext._jvm
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    if line is None:
        return None
    return [n[1:-1] if len(n) > 1 and n[0] == n[-1] == '"' else n for n in line.removeprefix("\ufeff").split(",")]


def read_header(spark: SparkSession, path: str) -> list[str] | None:
    """Cleaned header names."""
    names = raw_header(spark, path)
    return None if names is None else [clean_header(n) for n in names]


def read_raw(spark: SparkSession, path: str, source: Source, batch_id: str, check_header: bool = True) -> DataFrame:
    """Every column as a string, with ``_ingest_ts``, ``_source_file``,
    ``_batch_id``.

    Columns are those of the header, against an all-string schema, so there
    is no inference pass. Extra columns in the file are kept. In a folder of
    part files every file's header is held against the first one's: another
    order or name is an error, never a wrong column. Only sources whose
    quoted fields may hold line breaks are read with ``multiLine`` (which
    makes a whole file one task); the others stay splittable, and a quoted
    line break in one of them is an error, not two broken rows.
    """
    names = raw_header(spark, path) if check_header else None
    header = [clean_header(n) for n in names] if names else list(source.columns)
    missing = [c for c in source.columns if c not in header]
    if missing:
        raise ValueError(f"{path}: header lacks {missing}")
    fields = [T.StructField(n, T.StringType(), True) for n in names or header]
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", source.multiline)
        .option("enforceSchema", not check_header)
    )
    if source.multiline:
        df = reader.schema(T.StructType(fields)).csv(path)
        whole = F.lit(True)
    else:
        kept = T.StructField(BROKEN, T.StringType(), True)
        df = reader.option("columnNameOfCorruptRecord", BROKEN).schema(T.StructType([*fields, kept])).csv(path)
        quotes = F.length(BROKEN) - F.length(F.replace(F.col(BROKEN), F.lit('"'), F.lit("")))
        whole = F.col(BROKEN).isNull() | (quotes % 2 == 0)
    told = F.raise_error(F.concat(F.lit("a quoted line break in a source that is read line by line: "), F.col("_metadata.file_path")))
    columns = [F.col(f"`{n.name}`").alias(c) for n, c in zip(fields, header)]
    columns[0] = F.when(whole, F.col(f"`{fields[0].name}`")).otherwise(told).alias(header[0])
    return df.select(
        *columns,
        F.current_timestamp().alias(INGEST_TS),
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        F.lit(batch_id).alias(BATCH_ID),
    )
