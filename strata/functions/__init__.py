"""Column-level helpers: safe casts, text cleanup, keys and hashes."""

from strata.functions.casts import to_decimal, to_double, to_int, to_ts
from strata.functions.keys import change_hash, date_key, surrogate_key, versioned_key
from strata.functions.text import clean_city, clean_lower, clean_state, clean_zip

__all__ = [
    "to_decimal",
    "to_double",
    "to_int",
    "to_ts",
    "change_hash",
    "date_key",
    "surrogate_key",
    "versioned_key",
    "clean_city",
    "clean_lower",
    "clean_state",
    "clean_zip",
]
