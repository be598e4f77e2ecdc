"""Relational operators of the engine, each a pure DataFrame function."""

from strata.operators.asof import asof_join, in_validity
from strata.operators.batching import (
    assign_first_batch,
    batches_per_month,
    month_lookup,
    month_of,
    route_children,
    split_by_month,
)
from strata.operators.dedupe import latest_per_key
from strata.operators.merge import scd2_apply, scd2_classify, upsert
from strata.operators.quality import split_by_rule, tag_rejects

__all__ = [
    "asof_join",
    "in_validity",
    "assign_first_batch",
    "batches_per_month",
    "month_lookup",
    "month_of",
    "route_children",
    "split_by_month",
    "latest_per_key",
    "scd2_apply",
    "scd2_classify",
    "upsert",
    "split_by_rule",
    "tag_rejects",
]
