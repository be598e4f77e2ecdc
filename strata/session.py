"""Session settings the engine relies on.

The session itself is always given by the caller; we only set the few
options whose values change results (time zone) or plans (AQE).
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.errors import utils as _errors
from pyspark.sql import SparkSession

# Hash keys of versioned rows include timestamps, so the zone must be fixed
# or the same row gets a different surrogate key on another cluster.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder on the storage every executor sees.

    This is the cluster's ``spark.checkpoint.dir``, else the folder the
    caller gave to ``SparkContext.setCheckpointDir``. Only a ``local`` master
    (one machine, as in tests) gets a temp folder of its own; on a cluster
    that would be another disk on each executor, so it is an error there.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="strata-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts]) if parts else base


def cut_lineage(spark: SparkSession, df):
    """Materialise ``df`` into the shared checkpoint folder (reliable: it
    survives lost executors, unlike a local checkpoint)."""
    shared_dir(spark)
    return df.checkpoint(eager=True)


_SITES_LOCK = Lock()
_SITES_HELD: list = [0, None]  # blocks without call sites, and what held before them


@contextmanager
def without_call_sites():
    """Column expressions made inside the block do not record the line they
    were written at. The record (shown in errors) takes several calls into the
    JVM for each operator, more than the expression itself, and a load makes
    tens of thousands. Its setting is static, so in a session given by the
    caller only PySpark's own note of it can be changed; where there is no such
    note, nothing is. Blocks of several threads may overlap."""
    note = "_enable_debugging_cache"
    with _SITES_LOCK:
        if not _SITES_HELD[0]:
            _SITES_HELD[1] = getattr(_errors, note, None)
        _SITES_HELD[0] += 1
        if hasattr(_errors, note):
            setattr(_errors, note, False)
    try:
        yield
    finally:
        with _SITES_LOCK:
            _SITES_HELD[0] -= 1
            if not _SITES_HELD[0] and hasattr(_errors, note):
                setattr(_errors, note, _SITES_HELD[1])


def together(spark: SparkSession, steps: list[Callable]) -> list:
    """Results of steps that do not need each other, run side by side: each is
    a chain of jobs that wait on the driver more than they fill the cores. All
    of them end before the first error, in the order given, is raised."""
    if len(steps) < 2:
        return [step() for step in steps]
    with ThreadPoolExecutor(len(steps)) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [f.result() for f in futures]


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "strata") -> SparkSession:
    """Session for tests and the local benchmark (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # see without_call_sites
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "8g"))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
