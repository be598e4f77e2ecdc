"""Path-based Parquet tables in layers: the only module that writes.

* batch tables (bronze, quarantine, log) are partitioned by ``_batch_id``;
  a batch is replaced with one dynamic-partition overwrite, so a re-run
  never duplicates and never leaves a half-deleted slice behind
* keyed tables (silver, facts, type-2 dims) are partitioned by
  ``_bucket = pmod(xxhash64(keys), buckets)``; an upsert reads only the
  buckets the source touches and rewrites just those, or adds files to them
  where a new batch brings new keys only. What hangs on an order
  is bucketed by ``order_id`` alone (``CO_LOCATED``), so the orders a batch
  touches name the buckets of every table that holds their rows
* state tables (``state/*``) keep what the aggregates and centroids are summed
  from; they are not shown to SQL
* derived keyed tables (aggregates, type-1 dims) are refreshed bucket-wise
  for the keys a batch touches; only the date dimension is overwritten
* staging slices (``ops/stage_*``, ``ops/touched_*``, ``ops/prev_*`` ...)
  hold a batch's intermediate results, so each is computed once and later
  steps read it instead of recomputing its lineage. They go when the batch
  is complete; what describes the state before the batch (:meth:`Lake.remember`)
  is only added to while a batch is run again after a crash

What a write left empty is seen from the files themselves, never from a
metric. Not a transaction: the job commit replaces partitions one after the
other. Bronze is the source of truth; everything above it can be rebuilt
by replaying the batches in order.
"""

from __future__ import annotations

import json
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from strata.operators.merge import upsert
from strata.sources.specs import BATCH_ID

BUCKET = "_bucket"
PIECE = "_piece"  # part of a bucket, where a merge has more cores than buckets
#: A bucket of this many files is rewritten by the next upsert that meets it,
#: even one that only adds keys.
MOST_FILES = 64
#: Tables laid out by part of their key, so that the rows of an order lie in
#: the buckets of one number in all of them.
CO_LOCATED = {name: ["order_id"] for name in ("order_item", "order_payment", "fact_order_items", "fact_payments")}
STAGING = ("stage_", "touched_", "prev_", "gone_")

_CONF_LOCK = Lock()
_CONF_HELD: dict[str, tuple[int, str | None]] = {}  # blocks that hold a setting, and its value before them


@contextmanager
def _conf(spark: SparkSession, key: str, value: str):
    """A SQL setting for the jobs run inside the block. Blocks of several
    threads may overlap; the last one to end puts the old value back."""
    with _CONF_LOCK:
        held, old = _CONF_HELD.get(key) or (0, spark.conf.get(key, None))
        _CONF_HELD[key] = (held + 1, old)
        spark.conf.set(key, value)
    try:
        yield
    finally:
        with _CONF_LOCK:
            held, old = _CONF_HELD.pop(key)
            if held > 1:
                _CONF_HELD[key] = (held - 1, old)
            elif old is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, old)


#: Ends of the folders beside a table while a new state takes its place.
FRESH, OLD = "__fresh", "__old"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


class Lake:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.resuming = False
        self.written: dict[str, T.StructType] = {}  # columns of what this object wrote, by path

    # ---- paths -----------------------------------------------------------
    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def _fs_path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs, p

    def exists(self, layer: str, name: str) -> bool:
        """The table holds data: a partition folder or a data file (a table
        whose every partition was removed counts as not existing)."""
        self._mended(self.path(layer, name))
        fs, p = self._fs_path(self.path(layer, name))
        if not fs.exists(p):
            return False
        for st in fs.listStatus(p):
            n = st.getPath().getName()
            if (st.isDirectory() and "=" in n) or (st.isFile() and not n.startswith(("_", "."))):
                return True
        return False

    def path_exists(self, path: str) -> bool:
        fs, p = self._fs_path(path)
        return bool(fs.exists(p))

    def list_dirs(self, path: str) -> list[str]:
        """Names of the sub-folders of ``path`` (any Hadoop file system)."""
        fs, p = self._fs_path(path)
        if not fs.exists(p):
            return []
        return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())

    def marker(self, path: str, name: str) -> str | None:
        """A line kept in ``<path>/<name>`` (readers skip ``_`` files), or None."""
        fs, p = self._fs_path(f"{path}/{name}")
        if not fs.exists(p):
            return None
        jvm = self.spark.sparkContext._jvm
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p)))
        try:
            return reader.readLine().strip()
        finally:
            reader.close()

    def set_marker(self, path: str, name: str, text: str) -> None:
        fs, p = self._fs_path(f"{path}/{name}")
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def drop_marker(self, path: str, name: str) -> None:
        self._delete(f"{path}/{name}")

    def bucket_count(self, path: str, requested: int | None = None) -> int:
        """Buckets of a keyed table: fixed by its first write and kept in a
        ``_buckets`` marker, so a lake opened later with another setting
        cannot split a key over two buckets (:meth:`rebucket` changes it)."""
        kept = self.marker(path, "_buckets")
        return int(kept) if kept else requested or self.buckets

    def bucket_keys(self, layer: str, name: str, keys: list[str]) -> list[str]:
        """The columns whose hash is the bucket: all keys, or those of
        ``CO_LOCATED``. Fixed by the table's first write, as the number is."""
        path = self.path(layer, name)
        if kept := self.marker(path, "_bucketed_by"):
            return kept.split(",")
        return keys if self.exists(layer, name) else CO_LOCATED.get(name, keys)

    def _bucket_in(self, layer: str, name: str, keys: list[str], buckets: int | None = None) -> Column:
        return bucket_of(self.bucket_keys(layer, name, keys), self.bucket_count(self.path(layer, name), buckets))

    def _remember_buckets(self, path: str, n: int, by: list[str]) -> None:
        if self.marker(path, "_buckets") is None:
            self.set_marker(path, "_bucketed_by", ",".join(by))
            self.set_marker(path, "_buckets", str(n))

    def rebucket(self, layer: str, name: str, keys: list[str], buckets: int) -> None:
        """Rewrite a keyed table with another number of buckets (as it grows).

        Written beside the table and moved into its place; no batch may run
        meanwhile."""
        path = self.path(layer, name)
        fresh = f"{path}{FRESH}"
        self._delete(fresh)
        by = self.bucket_keys(layer, name, keys)
        table = self._table(path).drop(BUCKET).withColumn(BUCKET, bucket_of(by, buckets))
        self._write_buckets(table, fresh)
        self.set_marker(fresh, "_buckets", str(buckets))
        for name_ in ("_first_batch", "_bucketed_by", "_newest"):
            if (kept := self.marker(path, name_)) is not None:
                self.set_marker(fresh, name_, kept)
        self._publish(path)

    def _files(self, path: str) -> set[str]:
        """Names of the data files of one partition folder. A rewritten
        partition has new names (they hold the write's id)."""
        fs, p = self._fs_path(path)
        if not fs.exists(p):
            return set()
        names = (st.getPath().getName() for st in fs.listStatus(p) if st.isFile())
        return {n for n in names if not n.startswith(("_", "."))}

    def _delete(self, path: str) -> None:
        fs, p = self._fs_path(path)
        if fs.exists(p):
            fs.delete(p, True)

    # ---- SQL access ------------------------------------------------------
    def register(self, layers: tuple[str, ...] = ("bronze", "silver", "gold", "ops")) -> list[str]:
        """Expose every table that holds data as ``<layer>.<name>`` in the
        session catalog (external Parquet tables over the lake paths), so
        ad-hoc SQL such as ``SELECT ... FROM gold.dim_product`` runs as is.
        The helper column ``_bucket`` of keyed tables is visible as a
        partition column. A table of that name that lies elsewhere is not
        this lake's: it stays, and an error names it.
        """
        names = []
        for layer in layers:
            names_ = sorted({t.removesuffix(OLD) for t in self.list_dirs(f"{self.root}/{layer}") if not t.startswith("_") and not t.endswith(FRESH)})
            tables = [t for t in names_ if self.exists(layer, t)]
            if not tables:
                continue
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{layer}`")
            for name in tables:
                qualified, path = f"`{layer}`.`{name}`", self.path(layer, name)
                if self.spark.catalog.tableExists(f"{layer}.{name}"):
                    if not self._located(layer, name, path):
                        raise ValueError(f"{layer}.{name} is another table of the session catalog; the lake does not replace it")
                    self.spark.sql(f"DROP TABLE {qualified}")
                self.spark.sql(f"CREATE TABLE {qualified} USING parquet LOCATION '{path}'")
                if any(c.isPartition for c in self.spark.catalog.listColumns(f"{layer}.{name}")):
                    self.spark.sql(f"ALTER TABLE {qualified} RECOVER PARTITIONS")
                names.append(f"{layer}.{name}")
        return names

    def _located(self, layer: str, name: str, path: str) -> bool:
        """The catalog's table is external and lies at ``path``."""
        facts = {r["col_name"]: r["data_type"] for r in self.spark.sql(f"DESCRIBE FORMATTED `{layer}`.`{name}`").collect()}
        fs, p = self._fs_path(path)
        here = fs.makeQualified(p).toUri().getPath()
        there = self._fs_path(facts.get("Location", ""))[1].toUri().getPath() if facts.get("Location") else None
        return facts.get("Type") == "EXTERNAL" and there == here

    # ---- reads -----------------------------------------------------------
    def read(self, layer: str, name: str, schema: T.StructType | None = None) -> DataFrame | None:
        """The table, or an empty frame of ``schema`` when it does not exist
        yet (None without a schema)."""
        if not self.exists(layer, name):
            if schema is None:
                return None
            return self.spark.createDataFrame([], schema)
        path = self.path(layer, name)
        if schema is None and self.widens(layer, name):
            schema = self.union_schema(layer, name).add(BATCH_ID, "string")
        return (self._table(path) if schema is None else self.spark.read.schema(schema).parquet(path)).drop(BUCKET)

    def _table(self, path: str, part: str | None = None) -> DataFrame:
        """The table, or its slice ``part``. What this object wrote last is
        read by the columns written, so no job opens files to learn them. A
        batch id is a string, also where it looks like a date."""
        known = self.written.get(part or path)
        if known is None:
            known = self.spark.read.option("basePath", path).parquet(part or path).schema
        fields = [T.StructField(f.name, T.StringType() if f.name == BATCH_ID else f.dataType) for f in known]
        return self.spark.read.option("basePath", path).schema(T.StructType(fields)).parquet(part or path)

    def _wrote(self, schema: T.StructType, *paths: str) -> None:
        for path in paths:
            self.written[path] = schema

    @staticmethod
    def widens(layer: str, name: str) -> bool:
        """Tables whose batches may bring new columns (raw layer and
        quarantine): read with the union of all slices' schemas."""
        return layer == "bronze" or name.startswith("quarantine_")

    def union_schema(self, layer: str, name: str) -> T.StructType:
        """The columns of all slices of a widening table, kept in its
        ``_schema`` marker, so that no file is opened to learn them (a table
        without the marker is looked through, and gets one when written)."""
        path = self.path(layer, name)
        if kept := self.marker(path, "_schema"):
            return T.StructType.fromJson(json.loads(kept))
        found = self.spark.read.option("mergeSchema", "true").parquet(path).schema
        return T.StructType([f for f in found if f.name != BATCH_ID])

    def _widen(self, layer: str, name: str, schema: T.StructType) -> None:
        """Add the columns of ``schema`` to the table's union schema; another
        type for a column that is there is an error. Done before the write, so
        the marker never lacks a written column."""
        path = self.path(layer, name)
        known = self.union_schema(layer, name) if self.marker(path, "_schema") or self.exists(layer, name) else T.StructType([])
        types, wider = {f.name.lower(): f.dataType for f in known}, list(known)
        for f in schema:
            if f.name == BATCH_ID:
                continue
            if types.setdefault(f.name.lower(), f.dataType) != f.dataType:
                raise ValueError(f"{layer}.{name}: column {f.name} is {types[f.name.lower()].simpleString()}, not {f.dataType.simpleString()}")
            if f.name.lower() not in {k.name.lower() for k in wider}:
                wider.append(T.StructField(f.name, f.dataType))
        if len(wider) > len(known) or not self.marker(path, "_schema"):
            self.set_marker(path, "_schema", T.StructType(wider).json())

    def read_batch(self, layer: str, name: str, batch_id: str) -> DataFrame | None:
        """Slice of a batch-partitioned table, or None when the table or the
        slice does not exist. Only the slice's own files are opened."""
        part = f"{self.path(layer, name)}/{BATCH_ID}={batch_id}"
        if not self._files(part):
            return None
        if self.widens(layer, name):
            schema = self.union_schema(layer, name).add(BATCH_ID, "string")
            return self.spark.read.option("basePath", self.path(layer, name)).schema(schema).parquet(part)
        return self._table(self.path(layer, name), part)

    # ---- writes ----------------------------------------------------------
    def replace_batch(self, df: DataFrame, layer: str, name: str, batch_id: str) -> int:
        """Replace the slice (:meth:`write_batch`) and return its row count."""
        if not self.write_batch(df, layer, name, batch_id):
            return 0
        return self.count_batch(layer, name, batch_id)

    def count_batch(self, layer: str, name: str, batch_id: str) -> int:
        """Rows of a written slice, read back from its files (Parquet
        footers): exact even if a lost executor made Spark recompute a
        stage, which can make observed metrics count rows twice."""
        path = self.path(layer, name)
        return self._table(path, f"{path}/{BATCH_ID}={batch_id}").count()

    def write_batch(self, df: DataFrame, layer: str, name: str, batch_id: str) -> bool:
        """Replace the ``_batch_id = batch_id`` slice with ``df`` in one
        write (dynamic partition overwrite) and tell whether it has rows. A
        write without rows replaces nothing: then the slice still has its
        old files, and it is dropped."""
        part = f"{self.path(layer, name)}/{BATCH_ID}={batch_id}"
        before = self._files(part)
        if self.widens(layer, name):
            self._widen(layer, name, df.schema)
        labelled = df.withColumn(BATCH_ID, F.lit(batch_id))
        (
            labelled.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH_ID)
            .parquet(self.path(layer, name))
        )
        self._wrote(labelled.schema, self.path(layer, name), part)
        if not self._files(part) - before:
            self.drop_batch(layer, name, batch_id)
            return False
        return True

    def remember(self, df: DataFrame, name: str, batch_id: str) -> bool:
        """Stage what describes the state before the batch changes it. While
        a batch is run again after a crash, rows of the broken run are kept
        too: they describe the state that run has already changed."""
        if self.resuming and (earlier := self.read_batch("ops", name, batch_id)) is not None:
            df = df.unionByName(earlier.select(*df.columns)).distinct()
        return self.write_batch(df, "ops", name, batch_id)

    # ---- batch state -----------------------------------------------------
    def begin(self, batch_id: str, what: str = "running") -> None:
        """Mark a batch as running. A mark left by an earlier run means that
        it broke off, so its staging is still needed. Only a whole run may
        follow a broken piece of work of another kind (``what``)."""
        state = f"{self.root}/ops/_running"
        mark = self.marker(state, batch_id)
        if mark not in (None, what) and what != "running":
            raise RuntimeError(f"batch {batch_id} broke off ({mark}); run it again first")
        self.resuming = mark is not None
        if not self.resuming:
            self.set_marker(state, batch_id, what)

    def complete(self, batch_id: str) -> None:
        """Drop the batch's staging, then its mark."""
        for name in self.list_dirs(f"{self.root}/ops"):
            if name.startswith(STAGING):
                self.drop_batch("ops", name, batch_id)
        self._delete(f"{self.root}/ops/_running/{batch_id}")
        self.resuming = False

    def replace_batches(self, df: DataFrame, layer: str, name: str) -> None:
        """Replace every batch slice present in ``df`` (which carries
        ``_batch_id``) in one write; other slices stay."""
        if self.widens(layer, name):
            self._widen(layer, name, df.schema)
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH_ID)
            .parquet(self.path(layer, name))
        )
        for part in [p for p in self.written if p.startswith(f"{self.path(layer, name)}/")]:
            del self.written[part]
        self._wrote(df.schema, self.path(layer, name))

    def drop_batch(self, layer: str, name: str, batch_id: str) -> None:
        self._delete(f"{self.path(layer, name)}/{BATCH_ID}={batch_id}")

    def upsert_keyed(
        self,
        source: DataFrame,
        layer: str,
        name: str,
        keys: list[str],
        version_col: str | None = None,
        buckets: int | None = None,
        label_col: str | None = None,
        batch_id: str | None = None,
    ) -> None:
        """Upsert ``source`` (unique per key) into a bucketed keyed table.

        Only buckets holding a source key are read (a semi join on the
        partition column, pruned at run time) and rewritten. ``batch_id`` is
        the label that all rows of ``source`` have: rows of a batch newer than
        all others, none of whose keys is in the table, are added to their
        buckets as files of their own, and nothing is rewritten.
        """
        path = self.path(layer, name)
        n, by = self.bucket_count(path, buckets), self.bucket_keys(layer, name, keys)
        src = source.withColumn(BUCKET, bucket_of(by, n))
        there, newest = self.exists(layer, name), self.newest(layer, name)
        if batch_id is not None and (not there or newest is not None):
            self.set_marker(path, "_newest", max(batch_id, newest or ""))
        if not there:
            self._write_buckets(src, path)
            self._remember_buckets(path, n, by)
            return
        buckets_hit = self._buckets_of(src)
        if not buckets_hit:
            return
        target = self._table(path).filter(F.col(BUCKET).isin(buckets_hit))
        if batch_id is not None and newest is not None and newest < batch_id and self._only_adds(path, src, target, keys, buckets_hit):
            self._write_buckets(src.select(*target.columns), path, mode="append")
            return
        # Both sides hash-partitioned by bucket: the join on (keys, bucket)
        # reuses that partitioning (keys are unique, so no bucket is hot)
        # and its output is laid out one bucket per task for the write. Where
        # there are more cores than buckets, each is cut into pieces by a hash
        # of the keys.
        pieces = -(-3 * self.spark.sparkContext.defaultParallelism // len(buckets_hit))
        cut = {PIECE: F.pmod(F.hash(*[F.col(k) for k in keys]), F.lit(pieces))}
        with _conf(self.spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
            t = target.withColumns(cut).repartition(BUCKET, PIECE)
            s = src.select(*target.columns).withColumns(cut).repartition(BUCKET, PIECE)
            merged = upsert(t, s, [*keys, BUCKET, PIECE], version_col, label_col)
            self._write_buckets(merged.drop(PIECE), path, shuffle=False)

    def newest(self, layer: str, name: str) -> str | None:
        """The greatest batch id among the labels of a keyed table's rows, or
        one greater still (None: not known)."""
        return self.marker(self.path(layer, name), "_newest")

    def _only_adds(self, path: str, src: DataFrame, target: DataFrame, keys: list[str], hit: list[int]) -> bool:
        """``src`` has the table's columns and none of its keys, and the
        buckets ``hit`` have room for more files."""
        types = [{f.name: f.dataType for f in df.schema} for df in (src, target)]
        if any(types[0].get(c) != kind for c, kind in types[1].items()):
            return False
        if max(len(self._files(f"{path}/{BUCKET}={b}")) for b in hit) >= MOST_FILES:
            return False
        on = [*keys, BUCKET]
        return target.select(*on).join(src.select(*on), on, "left_semi").isEmpty()

    def _buckets_of(self, df: DataFrame) -> list[int]:
        """Buckets ``df`` touches: at most ``buckets`` small ints, so safe to
        collect; they become a static partition filter on the target (only
        those bucket folders are listed and read)."""
        return sorted(r[0] for r in df.select(BUCKET).distinct().collect())

    def replace_keyed(self, df: DataFrame, layer: str, name: str, keys: list[str], buckets: int | None = None, whole: bool = False) -> None:
        """Write new contents for the buckets present in ``df`` (used when
        the caller computed the new state of those buckets itself), or with
        ``whole`` for the whole table."""
        path = self.path(layer, name)
        n, by = self.bucket_count(path, buckets), self.bucket_keys(layer, name, keys)
        out = df if BUCKET in df.columns else df.withColumn(BUCKET, bucket_of(by, n))
        self._write_buckets(out, path, mode="static" if whole else "dynamic")
        self._remember_buckets(path, n, by)

    def buckets_holding(self, layer: str, name: str, keys_df: DataFrame, keys: list[str], buckets: int | None = None) -> list[int]:
        """Numbers of the buckets that may hold a key of ``keys_df``, which
        needs only the columns that the table is bucketed by."""
        return self._buckets_of(keys_df.select(self._bucket_in(layer, name, keys, buckets).alias(BUCKET)))

    def read_buckets(self, layer: str, name: str, hit: list[int] | None = None) -> DataFrame | None:
        """Rows of the buckets ``hit`` (default: all), with ``_bucket``."""
        if not self.exists(layer, name):
            return None
        table = self._table(self.path(layer, name))
        return table if hit is None else table.filter(F.col(BUCKET).isin(hit))

    def replace_buckets(self, df: DataFrame, layer: str, name: str, hit: list[int]) -> None:
        """The buckets ``hit`` hold the rows of ``df`` (with ``_bucket``) and
        nothing else; a bucket without rows is removed."""
        path = self.path(layer, name)
        before = {b: self._files(f"{path}/{BUCKET}={b}") for b in hit}
        self._write_buckets(df, path)
        self._remove_emptied(path, before)

    def _remove_emptied(self, path: str, before: dict[int, set[str]]) -> None:
        for b, files in before.items():
            if not self._files(f"{path}/{BUCKET}={b}") - files:  # no row was written
                self._delete(f"{path}/{BUCKET}={b}")

    def read_touched(self, layer: str, name: str, keys_df: DataFrame, keys: list[str], buckets: int | None = None) -> DataFrame | None:
        """Rows of the buckets that may hold a key of ``keys_df`` (with ``_bucket``)."""
        if not self.exists(layer, name):
            return None
        return self.read_buckets(layer, name, self.buckets_holding(layer, name, keys_df, keys, buckets))

    def refresh_keyed(
        self, fresh: DataFrame, touched: DataFrame, layer: str, name: str, keys: list[str], buckets: int | None = None
    ) -> None:
        """Replace the rows of the ``touched`` keys with ``fresh`` (which may
        lack some of them: those keys disappear). Only buckets holding a
        touched key are read and rewritten; a bucket left with no rows is
        removed, since a partitioned write cannot replace it with nothing."""
        path = self.path(layer, name)
        n, by = self.bucket_count(path, buckets), self.bucket_keys(layer, name, keys)
        fresh_b = fresh.withColumn(BUCKET, bucket_of(by, n))
        if not self.exists(layer, name):
            self._write_buckets(fresh_b, path)
            self._remember_buckets(path, n, by)
            return
        t = touched.select(*keys).distinct().withColumn(BUCKET, bucket_of(by, n))
        touched_buckets = set(self._buckets_of(t))
        target = self._table(path).filter(F.col(BUCKET).isin(sorted(touched_buckets)))
        kept = target.join(t, [*keys, BUCKET], "left_anti")
        out = kept.unionByName(fresh_b.select(*target.columns))
        before = {b: self._files(f"{path}/{BUCKET}={b}") for b in touched_buckets}
        self._write_buckets(out, path)
        self._remove_emptied(path, before)

    def _write_buckets(self, df: DataFrame, path: str, shuffle: bool = True, mode: str = "dynamic") -> None:
        # a bucket larger than the advisory size is written by several tasks
        (
            (df.hint("rebalance", BUCKET) if shuffle else df)
            .write.mode("append" if mode == "append" else "overwrite")
            .option("partitionOverwriteMode", "dynamic" if mode == "append" else mode)
            .partitionBy(BUCKET)
            .parquet(path)
        )
        self._wrote(df.schema, path)

    def overwrite(self, df: DataFrame, layer: str, name: str) -> None:
        """Full rebuild, written beside the table and moved into its place
        once it is whole. A run that ends before leaves the old table as it
        was; one that ends between the two moves is mended by the next look
        at the table (:meth:`_mended`)."""
        path = self.path(layer, name)
        df.write.mode("overwrite").parquet(f"{path}{FRESH}")
        self._publish(path)
        self._wrote(df.schema, path)

    def _publish(self, path: str) -> None:
        """The whole table at ``path + FRESH`` takes the place of ``path``."""
        fs, p = self._fs_path(path)
        fresh, old = (self._fs_path(f"{path}{end}")[1] for end in (FRESH, OLD))
        if fs.exists(p):
            self._delete(f"{path}{OLD}")
            if not fs.rename(p, old):
                raise OSError(f"{path} could not be moved")
        if not fs.rename(fresh, p):
            raise OSError(f"{path}{FRESH} could not be moved into its place")
        self._delete(f"{path}{OLD}")

    def _mended(self, path: str) -> None:
        """Where a publish broke off between its two moves, the new table is
        whole and takes its place."""
        fs, p = self._fs_path(path)
        if not fs.exists(p) and fs.exists(self._fs_path(f"{path}{OLD}")[1]):
            if fs.exists(self._fs_path(f"{path}{FRESH}")[1]):
                self._publish(path)
            else:
                fs.rename(self._fs_path(f"{path}{OLD}")[1], p)

    def replace_rows(self, rows: list[tuple], schema: str, layer: str, name: str, batch_id: str) -> None:
        """Replace a batch slice with a few driver-side rows (the run log:
        one row per table, so its size is fixed by the table list)."""
        self.write_batch(self.spark.createDataFrame(rows, schema), layer, name, batch_id)
