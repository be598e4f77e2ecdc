"""Secret scans with an incremental blob ledger.

Every version of every path is content-addressed by the SHA-256 of its text.
The ledger is a Parquet table with one row per scanned (blob, rule version),
findings included. A scan reads the texts of unseen pairs only, one text per
blob however many paths hold it, appends to the ledger, and joins the
findings back to all paths.

The base kinds are assign, access and hex. Rule version 2 adds private key
blocks, JSON web tokens, provider tokens and credentials in URLs; the base
rules are the same in both versions. A private key block runs to its END line over
all that holds no five dashes (so not over another BEGIN): header lines and
escaped line breaks belong to it.

Defined cases: a null text is the empty text; repeated rows and equal texts
each get the findings of their blob; a null doc_id is a path like any other;
an empty table gives no rows; extra columns are ignored. A ledger append that
ran twice (after a lost executor or driver) is harmless, as rows of a pair
are equal and read once.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import table, text_or_empty, whole_row, written
from strata.session import shared_dir

BASE = ("assign", "access", "hex")
#: The base rules (a failing match is dropped and not tried again).
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Rules added by version 2: kind -> pattern.
ADDED = {
    "private_key": re.compile(r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----(?:[^-]*(?:-{1,4}[^-]+)*-----END [A-Z ]{0,40}PRIVATE KEY-----)?", re.ASCII),
    "jwt": re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", re.ASCII),
    "provider": re.compile(r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})", re.ASCII),
    "url_login": re.compile(r"\b[a-z]{2,12}://[^\s:/@]{1,64}:[^\s:/@]{3,64}@[A-Za-z0-9.-]+", re.ASCII),
}
RULE_VERSION = 2
SPAN = "struct<kind:string,start:int,end:int>"
LEDGER = f"blob string, rules int, spans array<{SPAN}>"


def find(text: str, rules: int = RULE_VERSION) -> list[tuple[str, int, int]]:
    """All findings in one text: by start, then kind as listed."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    if rules >= 2:
        out += [(kind, *m.span()) for kind, p in ADDED.items() for m in p.finditer(text)]
    order = {kind: i for i, kind in enumerate((*BASE, *ADDED))}
    return sorted(out, key=lambda s: (s[1], order[s[0]], s[2]))


def blob_of(text: Column) -> Column:
    return F.sha2(text, 256)


def new_ledger(spark: SparkSession) -> str:
    """An empty ledger in the shared folder."""
    path = f"{shared_dir(spark)}/strata-llm/ledger-{uuid.uuid4().hex}"
    spark.createDataFrame([], LEDGER).write.parquet(path)
    return path


def read_ledger(spark: SparkSession, ledger: str, rules: int) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(ledger).filter(F.col("rules") == rules)


def scan_unseen(spark: SparkSession, docs: DataFrame, versions: DataFrame, ledger: str, rules: int = RULE_VERSION) -> None:
    """Scan the blobs that the ledger lacks under this rule version."""
    seen = read_ledger(spark, ledger, rules).select("blob")
    one = versions.groupBy("blob").agg(F.min("doc_id").alias("path")).join(seen, "blob", "left_anti")
    texts = docs.select("doc_id", text_or_empty().alias("text")).withColumn("blob", blob_of(F.col("text")))
    unseen = texts.join(
        one.select(F.col("blob").alias("blob_"), "path"), F.col("doc_id").eqNullSafe(F.col("path")) & (F.col("blob") == F.col("blob_")), "left_semi"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b} for k, a, b in find(t.as_py(), rules)] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([rules] * batch.num_rows, pa.int32()), pa.array(found, kind)], names=["blob", "rules", "spans"]
            )

    unseen.select("blob", "text").mapInArrow(run, LEDGER).write.mode("append").parquet(ledger)


def findings(spark: SparkSession, docs: DataFrame, ledger: str | None = None, rules: int = RULE_VERSION) -> tuple[DataFrame, DataFrame]:
    """(doc_id, blob) of every row of ``docs``, and the blobs with findings
    (blob, spans); the ledger grows by what it lacked."""
    ledger = ledger or new_ledger(spark)
    versions = written(spark, docs.select("doc_id", blob_of(text_or_empty()).alias("blob")), "blob-versions")
    scan_unseen(spark, docs, versions, ledger, rules)
    hits = read_ledger(spark, ledger, rules).filter(F.size("spans") > 0).select("blob", "spans").dropDuplicates(["blob"])
    return versions, hits


def scan(spark: SparkSession, docs: DataFrame, ledger: str | None = None, rules: int = RULE_VERSION) -> DataFrame:
    """doc_id, blob, spans of every row of ``docs``."""
    versions, hits = findings(spark, docs, ledger, rules)
    empty = F.expr(f"cast(array() as array<{SPAN}>)")
    return versions.join(hits, "blob", "left").select("doc_id", "blob", F.coalesce("spans", empty).alias("spans"))


def redact(spark: SparkSession, docs: DataFrame, ledger: str | None = None, rules: int = RULE_VERSION) -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by a mark."""
    _, hits = findings(spark, docs, ledger, rules)
    held = docs.select(whole_row(docs), blob_of(text_or_empty()).alias("blob")).join(hits, "blob", "left")
    text = F.when(F.size("spans") > 0, redacted(F.col("row.text"), F.col("spans"))).otherwise(F.col("row.text")).alias("text")
    return held.select(*[text if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def as_text(spans: Column) -> Column:
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with every span (overlapping ones as one) replaced by ``mark``."""
    hidden = F.aggregate(
        spans,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(
            F.struct(
                F.when(s["start"] < acc["at"], acc["out"])
                .otherwise(F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
                .alias("out"),
                s["end"].alias("at"),
            )
        ),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)),
    )
    return F.when(F.size(spans) > 0, hidden).otherwise(text)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings in all documents."""
    found = scan(spark, table(spark, sf_dir, "documents", "doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, BASE), F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"), "blob")


def _sql() -> str:
    """Every kind's matches lie between the pieces that its pattern leaves."""
    keyword = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    rules = {"assign": keyword, "access": ACCESS.pattern, "hex": HEX.pattern} | {kind: p.pattern for kind, p in ADDED.items()}
    quoted = {kind: p.replace("'", "''") for kind, p in rules.items()}
    holds = {"assign": f"length(regexp_extract(m, '{quoted['assign']}', 2)) >= 6", "access": "length(m) >= 20"}
    length = "coalesce(list_sum(list_transform({}, lambda x: length(x))), 0)"
    parts = [
        f"""SELECT r, {i} AS o, '{kind}' AS kind, m, p FROM (
          SELECT r, unnest(found) AS m, unnest(list_transform(range(1, len(found) + 1), lambda i:
            {length.format("pieces[1:i]")} + {length.format("found[1:i - 1]")})) AS p
          FROM (SELECT r, regexp_extract_all(text, '{p}') AS found, string_split_regex(text, '{p}') AS pieces FROM d) WHERE len(found) > 0)
        WHERE {holds.get(kind, 'true')}"""
        for i, (kind, p) in enumerate(quoted.items())
    ]
    text = "string_agg(kind || ':' || CAST(p AS BIGINT) || ':' || CAST(p + length(m) AS BIGINT), ',' ORDER BY p, o)"
    base = "kind IN ('assign', 'access', 'hex')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
s AS ({' UNION ALL '.join(parts)}),
g AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  {text} FILTER ({base}) AS base, {text} AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(text) AS blob FROM d LEFT JOIN g USING (r)
"""


SQL = _sql()
