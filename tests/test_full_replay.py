"""Slow (opt in with STRATA_SLOW=1, ~11 min): every monthly batch of the
smallest tables through the lake, then gold equals the one-shot result."""

from __future__ import annotations

import os

import pytest

from strata import catalog
from strata.plans import aggs
from strata.plans.run import run_batch
from strata.sources import testdata as td
from strata.sources.lake import Lake

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(
    os.environ.get("STRATA_SLOW") != "1" or not os.path.isdir(SF), reason="slow: set STRATA_SLOW=1"
)


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.select(*sorted(df.columns)).collect())


def test_every_batch_replayed_equals_one_shot(spark, tmp_path):
    months = td.write_test_batches(spark, SF, f"{tmp_path}/batches")
    lake = Lake(spark, f"{tmp_path}/lake", buckets=8)
    for b in sorted(set(months) | {td.CHANGE_BATCH}):
        run_batch(lake, f"{tmp_path}/batches", b)
    want = catalog.fact_items(spark, SF, natural_keys=False)
    assert _rows(lake.read("gold", "fact_order_items").drop("_batch_id")) == _rows(want)
    _, dim = catalog.product_dims(spark, SF)
    assert _rows(lake.read("gold", "dim_product").filter("product_key <> -1")) == _rows(dim)
    assert _rows(lake.read("gold", "agg_daily_sales")) == _rows(aggs.agg_daily_sales(want))
    assert _rows(lake.read("gold", "agg_customer_ltv")) == _rows(aggs.agg_customer_ltv(want))
    assert _rows(lake.read("gold", "dim_customer").drop("customer_key")) == _rows(catalog.q_dim_customer(spark, SF))
