"""Type-2 history from observations, whatever the order they came in."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.keys import differs, versioned_key
from strata.operators.merge import CURRENT, VALID_FROM, VALID_TO, with_change_hash


def versions_of(observed: DataFrame, key: str, sk: str, tracked: list[str], at: str = "observed_at") -> DataFrame:
    """Versions of each key from all that was observed of it: one row per
    (key, ``at``), with the attributes it had then.

    A version opens at a key's first observation and wherever a tracked
    attribute differs from the observation before (NULLs are values), and is
    valid until the next one opens; attributes that are not tracked stay as
    they were at its opening. The same observations give the same versions
    in any order of arrival, and equal to :func:`scd2_apply` over them in
    order of time. One exchange by key serves both windows; a key has one row
    per delivery, so no group grows with the table.
    """
    rows = with_change_hash(observed, tracked)
    attrs = [c for c in rows.columns if c != at]
    by_time = Window.partitionBy(key).orderBy(at)
    before = {f"_before_{c}": F.lag(c).over(by_time) for c in tracked}
    rows = rows.withColumns({"_nth": F.row_number().over(by_time), **before})
    opens = (F.col("_nth") == 1) | differs([F.col(c) for c in tracked], [F.col(c) for c in before])
    until = F.lead(at).over(by_time)
    rows = rows.filter(opens).withColumn("_until", until)
    return rows.select(
        *attrs,
        F.col(at).alias(VALID_FROM),
        F.col("_until").alias(VALID_TO),
        F.col("_until").isNull().alias(CURRENT),
        versioned_key(F.col(key), F.col(at)).alias(sk),
    )


def keys_that_differ(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys whose versions are not the same intervals in both histories."""
    interval = [key, VALID_FROM, VALID_TO]
    both = old.select(*interval).unionByName(new.select(*interval))
    return both.groupBy(*interval).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").select(key).distinct()
