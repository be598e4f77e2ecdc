"""strata: an incremental bronze -> silver -> gold analytics engine on Spark.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
Spark SQL built-ins; only :mod:`strata.sources.lake` touches storage paths.
"""

from strata.session import configure, shared_dir

__all__ = ["configure", "shared_dir"]
