"""Every catalogue entry against its DuckDB twin on the smallest tables
(the driver's check runs the same comparison at sf0.01)."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import TABLES, digest  # noqa: E402

from strata.catalog import queries  # noqa: E402
from strata.oracle import oracle_sql  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_entry_matches_sql(spark, duck, name):
    got = queries()[name](spark, SF).toPandas()
    want = duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)


def test_every_entry_has_a_twin():
    assert set(queries()) == set(oracle_sql())


def test_all_keys_are_keys(spark):
    rows = queries()["surrogate_keys"](spark, SF).collect()
    assert rows and all(r.sharing == 1 and not r.missing_key for r in rows)
    assert {r.kind for r in rows if r.fact_rows} == {"product", "customer", "seller"}
