"""Validity rules, quarantine tagging, row counts and soft checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "_reject_reason"


def passes(rule: str | Column) -> Column:
    """A rule holds only when it is TRUE: a NULL result counts as bad."""
    expr = F.expr(rule) if isinstance(rule, str) else rule
    return F.coalesce(expr, F.lit(False))


def tag_rejects(df: DataFrame, rules: list[tuple[str, str | Column]]) -> DataFrame:
    """Add ``_reject_reason``: the first failing rule's reason, else NULL.

    All rules of a table are checked in one projection, so every reject of
    a batch lands in quarantine together (none is lost when a second rule
    replaces the slice written by the first).
    """
    reason = F.lit(None).cast("string")
    for text, rule in reversed(rules):
        reason = F.when(~passes(rule), F.lit(text)).otherwise(reason)
    return df.withColumn(REASON, reason)


def split_by_rule(df: DataFrame, rule: str) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected) for one SQL rule; rejects carry the rule text."""
    tagged = tag_rejects(df, [(rule, rule)])
    return clean_part(tagged), rejected_part(tagged)


def clean_part(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNull()).drop(REASON)


def rejected_part(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(REASON).isNotNull())


@dataclass
class Counts:
    rows_in: int = 0
    rows_out: int = 0
    rows_quarantined: int = 0


def rule_counts(tagged: DataFrame, keys: list[str]) -> DataFrame:
    """rows_in, rows_out (distinct keys among valid rows = rows a dedupe
    keeps) and rows_quarantined of a tagged frame, in one pass.

    Grouping by the key first (partial aggregation before the shuffle, so
    a hot key is combined within each task) avoids a distinct aggregate
    and the row-by-row window of an actual dedupe.
    """
    bad = F.col(REASON).isNotNull()
    per_key = tagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(bad).alias("_bad"),
        F.max(~bad).alias("_has_clean"),
    )
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in"),
        F.count_if(F.col("_has_clean")).alias("rows_out"),
        F.coalesce(F.sum("_bad"), F.lit(0)).alias("rows_quarantined"),
    )


# Soft checks that are logged as warnings, never rejected.
SOFT_CHECKS = {
    "delivered before purchase": "delivered_customer_ts < purchase_ts",
    "approved before purchase": "approved_ts < purchase_ts",
    "shipping limit before purchase": "shipping_limit_ts < purchase_ts",
}


def soft_check_counts(df: DataFrame, checks: dict[str, str], keys: list[str] | None = None) -> DataFrame:
    """Number of rows breaking each soft check (NULL results do not count).

    Returns one row per check: ``soft_check, rows_checked, rows_flagged``. A
    check whose columns are missing is an error.
    """
    aggs = [F.count(F.lit(1)).alias("rows_checked")]
    aggs += [F.count_if(F.coalesce(F.expr(rule), F.lit(False))).alias(f"c{i}") for i, rule in enumerate(checks.values())]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{name}', c{i}" for i, name in enumerate(checks))
    return wide.selectExpr(f"stack({len(checks)}, {stack}) as (soft_check, rows_flagged)", "rows_checked")
