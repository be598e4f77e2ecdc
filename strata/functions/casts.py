"""Casts of raw strings that never fail a batch.

With ANSI mode on (the Spark 4 default) a plain ``cast('abc' as int)``
raises and kills the whole job; raw data must instead give NULL so the
validity rule can quarantine the row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import as_col


def to_int(c: str | Column) -> Column:
    """String -> int; ``'225.0'`` and ``' 7 '`` parse, fractions truncate,
    junk and out-of-range values give NULL (non-ANSI cast semantics)."""
    return as_col(c).try_cast("decimal(38,6)").try_cast("int")


def to_double(c: str | Column) -> Column:
    return as_col(c).try_cast("double")


def to_decimal(c: str | Column, precision: int = 12, scale: int = 2) -> Column:
    """String -> decimal, rounding half up; overflow gives NULL."""
    return as_col(c).try_cast(f"decimal({precision},{scale})")


def to_ts(c: str | Column) -> Column:
    """String -> timestamp in the session zone; unparsable gives NULL.
    ``'2017-01'`` parses to 2017-01-01 00:00."""
    return F.try_to_timestamp(as_col(c))
