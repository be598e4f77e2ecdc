"""Text cleanup used by the conform step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_zip(c: str | Column, width: int = 5) -> Column:
    """Left-pad with zeros to ``width``; longer values are cut to ``width``
    (that is what ``lpad`` does, and zip prefixes are fixed-width)."""
    return F.lpad(as_col(c), width, "0")


def clean_city(c: str | Column) -> Column:
    """Trim, then capitalise each space-separated word."""
    return F.initcap(F.trim(as_col(c)))


def clean_state(c: str | Column) -> Column:
    return F.upper(F.trim(as_col(c)))


def clean_lower(c: str | Column) -> Column:
    return F.lower(F.trim(as_col(c)))


def clean_header(name: str) -> str:
    """Column name from a CSV header: byte-order mark and spaces removed."""
    return name.replace("\ufeff", "").strip()
