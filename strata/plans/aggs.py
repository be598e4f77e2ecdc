"""Aggregates over the item fact.

Distinct order counts are computed in two steps, first per (group, order)
and then per group, instead of ``countDistinct`` next to other aggregates
(which Spark plans with an Expand that copies every row once per distinct
group). Both steps aggregate partially before their shuffle, so a hot
group is combined inside each task first. An order sits in one group
(one purchase date, one person), so the two-step counts are exact.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.merge import replace_keys


def daily_sums(fact: DataFrame, *by: str) -> DataFrame:
    """Additive measures per purchase day (within each ``by``)."""
    late = F.col("is_late").cast("int")
    per_order = fact.groupBy(*by, "purchase_date_key", "order_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("price").alias("gmv"),
        F.sum("freight_value").alias("freight"),
        F.sum("delivery_days").alias("dd_sum"),
        F.count("delivery_days").alias("dd_n"),
        F.sum(late).alias("late_sum"),
        F.count(late).alias("late_n"),
    )
    money = lambda c: F.sum(c).cast("decimal(30,2)").alias(c)
    whole = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
    return per_order.groupBy(*by, "purchase_date_key").agg(
        F.count("order_id").alias("orders"), whole("items"), money("gmv"), money("freight"), *map(whole, ("dd_sum", "dd_n", "late_sum", "late_n"))
    )


def daily_of(sums: DataFrame) -> DataFrame:
    return sums.select(
        "purchase_date_key",
        "orders",
        "items",
        F.col("gmv").cast("decimal(22,2)").alias("gmv"),
        F.col("freight").cast("decimal(22,2)").alias("freight"),
        F.try_divide("dd_sum", "dd_n").alias("avg_delivery_days"),
        F.try_divide("late_sum", "late_n").alias("late_rate"),
    )


def agg_daily_sales(fact: DataFrame) -> DataFrame:
    """Per purchase day: orders, items, GMV, freight, item-weighted mean
    delivery days and late rate (undelivered items ignored)."""
    return daily_of(daily_sums(fact))


def ltv_sums(fact: DataFrame, *by: str, person: str = "customer_key") -> DataFrame:
    """Additive measures and the extreme days per person (within each ``by``)."""
    per_order = fact.groupBy(*by, person, "order_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum("item_total").alias("spent"),
        F.min("purchase_date_key").alias("first_day"),
        F.max("purchase_date_key").alias("last_day"),
    )
    return per_order.groupBy(*by, person).agg(
        F.count("order_id").alias("orders"),
        F.sum("items").alias("items"),
        F.sum("spent").cast("decimal(30,2)").alias("spent"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )


def ltv_of(sums: DataFrame, person: str = "customer_key") -> DataFrame:
    spent = F.col("spent").cast("decimal(23,2)")
    return sums.select(
        person,
        "orders",
        "items",
        spent.alias("total_spent"),
        F.col("first_day").alias("first_purchase_date_key"),
        F.col("last_day").alias("last_purchase_date_key"),
        (spent / F.col("orders")).alias("avg_order_value"),
    )


def agg_customer_ltv(fact: DataFrame, person: str = "customer_key") -> DataFrame:
    """Per person: orders, items, total spent, first and last purchase day,
    average order value."""
    return ltv_of(ltv_sums(fact, person=person), person)


@dataclass(frozen=True)
class Aggregate:
    """An aggregate kept up to date by signed deltas. ``orders`` counts the
    orders of a group, which goes when none is left."""

    table: str
    group: str
    sums: Callable[..., DataFrame]
    result: Callable[[DataFrame], DataFrame]
    added: tuple[str, ...]
    least: tuple[str, ...] = ()
    greatest: tuple[str, ...] = ()

    @property
    def extremes(self) -> tuple[str, ...]:
        return self.least + self.greatest

    def extreme(self, name: str) -> Callable[[str], Column]:
        return F.min if name in self.least else F.max


AGGREGATES = (
    Aggregate("agg_daily_sales", "purchase_date_key", daily_sums, daily_of, ("orders", "items", "gmv", "freight", "dd_sum", "dd_n", "late_sum", "late_n")),
    Aggregate("agg_customer_ltv", "customer_key", ltv_sums, ltv_of, ("orders", "items", "spent"), ("first_day",), ("last_day",)),
)


def delta(agg: Aggregate, new: DataFrame, old: DataFrame) -> DataFrame:
    """Per group that changes: what the ``new`` parts of it add to the ``old``
    ones they replace, and the extremes of both (``new_*``, ``old_*``)."""
    nothing = lambda c: F.lit(None).cast(new.schema[c].dataType)
    plus = [F.col(c) for c in agg.added] + [x for c in agg.extremes for x in (F.col(c).alias(f"new_{c}"), nothing(c).alias(f"old_{c}"))]
    minus = [(-F.col(c)).alias(c) for c in agg.added] + [x for c in agg.extremes for x in (nothing(c).alias(f"new_{c}"), F.col(c).alias(f"old_{c}"))]
    both = new.select(agg.group, *plus).unionByName(old.select(agg.group, *minus))
    ends = [agg.extreme(c)(f"{side}_{c}").alias(f"{side}_{c}") for c in agg.extremes for side in ("new", "old")]
    out = both.groupBy(agg.group).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(new.schema[c].dataType).alias(c) for c in agg.added], *ends)
    moved = [F.col(c) != 0 for c in agg.added] + [~F.col(f"new_{c}").eqNullSafe(F.col(f"old_{c}")) for c in agg.extremes]
    return out.filter(reduce(or_, moved))


def applied(agg: Aggregate, change: DataFrame, sums: DataFrame) -> DataFrame:
    """The changed groups' new sums. ``_again`` marks groups that lost the row
    an extreme came from: it must be found among all their parts."""
    before = sums.select(F.col(agg.group).alias("_group"), *[F.col(c).alias(f"sum_{c}") for c in agg.added + agg.extremes])
    j = change.join(before, F.col(agg.group) == F.col("_group"), "left")
    lost = []
    out = [F.col(agg.group)] + [(F.coalesce(F.col(f"sum_{c}"), F.lit(0)) + F.col(c)).cast(change.schema[c].dataType).alias(c) for c in agg.added]
    for c in agg.extremes:
        nearest = F.least if c in agg.least else F.greatest
        new, old, now = F.col(f"new_{c}"), F.col(f"old_{c}"), F.col(f"sum_{c}")
        retracted = now.isNotNull() & old.eqNullSafe(now) & ~F.coalesce(nearest(new, old) == new, F.lit(False))
        lost.append(retracted)
        out.append(F.when(old.eqNullSafe(now), new).otherwise(nearest(now, new)).alias(c))
    return j.select(*out, (reduce(or_, lost) if lost else F.lit(False)).alias("_again")).filter(F.col("orders") >= 0)


def with_extremes(agg: Aggregate, sums: DataFrame, parts: DataFrame) -> DataFrame:
    """``sums`` with the extremes of the groups marked ``_again`` from ``parts``."""
    again = sums.filter("_again").select(agg.group)
    found = parts.join(again, agg.group, "left_semi").groupBy(agg.group).agg(*[agg.extreme(c)(c).alias(f"_{c}") for c in agg.extremes])
    kept = [F.when(F.col("_again"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in agg.extremes]
    return sums.join(found, agg.group, "left").select(agg.group, *agg.added, *kept)


def touched_groups(old_fact: DataFrame | None, new_rows: DataFrame, group: str) -> DataFrame:
    """Groups an incremental refresh must recompute: those of the new rows,
    and the old groups of rows that moved (both sides of a move)."""
    keys = new_rows.select(group)
    if old_fact is not None:
        moved = old_fact.join(new_rows.select("order_id", "order_item_id"), ["order_id", "order_item_id"], "left_semi")
        keys = keys.unionByName(moved.select(group))
    return keys.distinct()


def refresh(agg: DataFrame | None, fact: DataFrame, touched: DataFrame, group: str, build) -> DataFrame:
    """Aggregate rows for the touched groups recomputed from the fact, the
    other groups carried over unchanged."""
    return replace_keys(agg, build(fact.join(touched, group, "left_semi")), touched, [group])
