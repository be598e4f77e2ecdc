"""Keep one row per business key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_columns(df: DataFrame, keys: list[str], order_by: list[str | Column] | None = None) -> list[Column]:
    """The declared order, then every other column as a tie-break.

    Without the tie-break the survivor among equal ``order_by`` values is
    whichever row a task happens to see first, and a re-run may keep
    another one. Every non-key column, descending with NULLs last, makes
    the choice a pure function of the rows.
    """
    declared = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in (order_by or [])]
    named = {c for c in (order_by or []) if isinstance(c, str)}
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in keys and c not in named]
    return declared + rest


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str | Column] | None = None) -> DataFrame:
    """First row per ``keys`` under ``order_by`` (descending = latest).

    Planned as a window with ``row_number() = 1``; Spark adds a partial
    ``WindowGroupLimit`` before the shuffle, so a hot key is cut down to
    one row per task before it is exchanged.
    """
    w = Window.partitionBy(*keys).orderBy(*order_columns(df, keys, order_by))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
