"""Join each row to the version of a dimension valid at its timestamp."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.merge import VALID_FROM, VALID_TO


def in_validity(ts: Column, valid_from: Column, valid_to: Column) -> Column:
    """Half-open interval ``[valid_from, valid_to)``; NULL ``valid_to`` is open."""
    return (ts >= valid_from) & (valid_to.isNull() | (ts < valid_to))


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: Column,
    version_key: Column,
    ts: Column,
    how: str = "left",
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
) -> DataFrame:
    """Versioned lookup: key equality plus the validity test.

    Because the key is an equality, Spark plans a hash or sort-merge join
    with the interval as a residual filter, never a nested loop. Versions
    of one key do not overlap, so each fact row matches at most one
    version. A hot key is split by AQE's skew-join handling on the fact
    side; ``versions`` is broadcast by AQE only when its measured size is
    under the broadcast threshold.
    """
    cond = (fact_key == version_key) & in_validity(ts, versions[valid_from], versions[valid_to])
    return facts.join(versions, cond, how)


def asof_join_sliced(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    version_key: str,
    ts: str,
    hot_rows: int = 1_000_000,
    slice_days: int = 30,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
) -> DataFrame:
    """:func:`asof_join` (left) that spreads hot keys by time itself.

    A key with more than ``hot_rows`` fact rows has them numbered by slices
    of ``slice_days`` days, and its versions copied into each slice in which
    they are valid and the key has facts; the join is on (key, slice), so a
    hot key's rows go to as many tasks as it has slices. All other keys keep
    slice 0, so nothing is copied for them. Fact rows are counted per key
    with partial aggregation; the hot keys are at most rows / ``hot_rows``,
    and the planner alone decides whether that list is broadcast. A NULL key
    or time matches no version, and its row stays (spread as it was: such
    rows do not join).
    """
    day = F.floor(F.datediff(F.col(ts), F.lit("1970-01-01").cast("date")) / slice_days)
    hot = (
        facts.filter(F.col(fact_key).isNotNull() & F.col(ts).isNotNull())
        .groupBy(F.col(fact_key).alias("_hot_key"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min(day).alias("_lo"), F.max(day).alias("_hi"))
        .filter(F.col("_n") > hot_rows)
        .drop("_n")
    )
    marked = facts.join(hot.select("_hot_key"), F.col(fact_key) == F.col("_hot_key"), "left")
    marked = marked.withColumn("_slice", F.when(F.col("_hot_key").isNull(), F.lit(0).cast("long")).otherwise(day)).drop("_hot_key")

    v = versions.join(hot, F.col(version_key) == F.col("_hot_key"), "left")
    first_day = F.floor(F.datediff(F.col(valid_from), F.lit("1970-01-01").cast("date")) / slice_days)
    last_day = F.floor(F.datediff(F.col(valid_to), F.lit("1970-01-01").cast("date")) / slice_days)
    lo = F.greatest(first_day, F.col("_lo"))
    hi = F.least(F.coalesce(last_day, F.col("_hi")), F.col("_hi"))
    slices = F.when(F.col("_hot_key").isNull(), F.array(F.lit(0).cast("long"))).when(lo <= hi, F.sequence(lo, hi))
    v = v.withColumn("_v_slice", F.explode(slices)).drop("_hot_key", "_lo", "_hi")
    cond = (
        (marked[fact_key] == v[version_key])
        & (marked["_slice"] == v["_v_slice"])
        & in_validity(marked[ts], v[valid_from], v[valid_to])
    )
    return marked.join(v, cond, "left").drop("_slice", "_v_slice")
