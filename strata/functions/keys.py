"""Date keys, surrogate keys and change hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.text import as_col

# The key of the "unknown" member and the pieces of the
# change hash text.
UNKNOWN_KEY = -1
HASH_SEPARATOR = "||"
HASH_NULL_TEXT = "<null>"


def date_key(c: str | Column) -> Column:
    """Timestamp or date -> ``yyyyMMdd`` integer; NULL stays NULL."""
    return F.date_format(as_col(c), "yyyyMMdd").cast("int")


def surrogate_key(*cols: str | Column) -> Column:
    """Deterministic 64-bit key of a business key.

    ``xxhash64(NULL)`` is the seed (42), which would make every missing
    member one shared fake key; a NULL part maps to the unknown key instead.
    """
    parts = [as_col(c) for c in cols]
    any_null = reduce(lambda a, b: a | b, [p.isNull() for p in parts])
    return F.when(any_null, F.lit(UNKNOWN_KEY).cast("long")).otherwise(F.xxhash64(*parts))


def versioned_key(key: str | Column, effective_from: str | Column) -> Column:
    """Key of one version of a type-2 row: hash of business key and start
    of validity (a timestamp, so the session zone must be pinned)."""
    return surrogate_key(key, effective_from)


def change_hash(cols: list[str]) -> Column:
    """SHA-256 over the tracked attributes, as an audit/output column.

    Change detection itself compares columns null-safely; this text form
    collides when values contain the separator or equal the null marker.
    """
    pieces = [F.coalesce(F.col(c).cast("string"), F.lit(HASH_NULL_TEXT)) for c in cols]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *pieces), 256)


def differs(left: list[Column], right: list[Column]) -> Column:
    """True when any pair differs, NULLs compared as values."""
    checks = [~l.eqNullSafe(r) for l, r in zip(left, right)]
    return reduce(lambda a, b: a | b, checks) if checks else F.lit(False)
