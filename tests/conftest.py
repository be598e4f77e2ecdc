from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="strata-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="strata-test-ckpt-")
        s.sparkContext.setCheckpointDir(d)
    yield s


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="strata-test-")


@pytest.fixture(scope="module", autouse=True)
def own_catalog(spark):
    """What a test file registers leaves the session catalog with it."""
    yield
    for layer in ("bronze", "silver", "gold", "ops"):
        spark.sql(f"DROP DATABASE IF EXISTS `{layer}` CASCADE")
