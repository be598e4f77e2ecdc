"""Keyed upsert and type-2 history as DataFrame expressions.

Both are one full outer join on the business key (one shuffle per side,
1:1 per key since both sides are unique per key), followed by a single
projection that picks the surviving version(s) of each key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import change_hash, differs, versioned_key

VALID_FROM = "effective_from"
VALID_TO = "effective_to"
CURRENT = "is_current"
HASH = "_hash"
# Fixed value: start of validity of the first version of every key.
INITIAL_EFFECTIVE_FROM = "1900-01-01"


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], version_col: str | None = None, label_col: str | None = None
) -> DataFrame:
    """Target rows updated/inserted from ``source`` on key equality.

    ``source`` must hold at most one row per key (dedupe it first). Rows
    with a NULL key never match, so they are kept (target) or inserted
    (source), as a MERGE would do. With ``version_col`` a source row loses
    against a target row whose version is greater, so replaying an older
    batch cannot overwrite newer data. A ``label_col`` guards nothing: the
    source's values are taken, and the greater label stays.
    """
    cols = target.columns
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns {missing}")
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = source.select(*cols).withColumn("_in_s", F.lit(True)).alias("s")
    cond = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    take_source = F.col("s._in_s").isNotNull()
    if version_col:
        newer_or_same = F.coalesce(F.col(f"s.{version_col}") >= F.col(f"t.{version_col}"), F.lit(True))
        take_source = take_source & (F.col("t._in_t").isNull() | newer_or_same)
    j = t.join(s, cond, "full_outer")

    def merged(c: str) -> Column:
        if c == label_col:
            return F.greatest(f"s.{c}", f"t.{c}").alias(c)
        return F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    return j.select(*map(merged, cols))


def replace_keys(old: DataFrame | None, fresh: DataFrame, touched: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``old`` whose keys were not touched, plus ``fresh`` (the
    recomputed rows of the touched keys; a touched key missing from it
    disappears). The pure form of the lake's bucket-wise refresh."""
    if old is None:
        return fresh
    return old.join(touched.select(*keys), keys, "left_anti").unionByName(fresh.select(*old.columns))


def initial_versions(src: DataFrame, key: str, sk: str, effective_from: str = INITIAL_EFFECTIVE_FROM) -> DataFrame:
    """First load: one open, current version per key."""
    eff = F.lit(effective_from).cast("timestamp")
    return src.select(
        *src.columns,
        eff.alias(VALID_FROM),
        F.lit(None).cast("timestamp").alias(VALID_TO),
        F.lit(True).alias(CURRENT),
        versioned_key(F.col(key), eff).alias(sk),
    )


def with_change_hash(src: DataFrame, tracked: list[str]) -> DataFrame:
    return src.withColumn(HASH, change_hash(tracked))


def scd2_classify(dim: DataFrame, src: DataFrame, key: str, tracked: list[str]) -> DataFrame:
    """Source rows labelled ``new`` / ``changed`` / ``unchanged`` against
    the current versions (tracked attributes compared NULL-safely)."""
    cur = dim.filter(F.col(CURRENT)).select(key, *[F.col(c).alias(f"_cur_{c}") for c in tracked], F.lit(True).alias("_in_cur"))
    j = src.join(cur, key, "left")
    change = (
        F.when(F.col("_in_cur").isNull(), F.lit("new"))
        .when(differs([F.col(c) for c in tracked], [F.col(f"_cur_{c}") for c in tracked]), F.lit("changed"))
        .otherwise(F.lit("unchanged"))
    )
    return j.select(*src.columns, change.alias("change"))


def scd2_apply(
    dim: DataFrame | None,
    src: DataFrame,
    key: str,
    sk: str,
    tracked: list[str],
    effective_from: str,
    initial_effective_from: str = INITIAL_EFFECTIVE_FROM,
) -> DataFrame:
    """New state of a type-2 dimension after loading ``src`` (one row per key).

    * key not in the dimension: new open version from ``effective_from``
    * tracked attribute changed, current version older: current version is
      closed at ``effective_from`` and a new one opened
    * changed, current version starts at the same instant (a corrected
      re-run of the same batch): that version is replaced in place, so its
      surrogate key stays unique
    * changed, current version newer: the job fails (out-of-order load
      would make an inverted interval)
    * unchanged, or only untracked attributes changed: nothing happens
    * keys absent from ``src`` stay open
    """
    src = with_change_hash(src, tracked)
    if dim is None:
        return initial_versions(src, key, sk, initial_effective_from)

    attrs = src.columns
    out_cols = attrs + [VALID_FROM, VALID_TO, CURRENT, sk]
    eff = F.lit(effective_from).cast("timestamp")
    hist = dim.filter(~F.col(CURRENT)).select(*out_cols)
    cur = dim.filter(F.col(CURRENT)).select(*out_cols).withColumn("_in_c", F.lit(True)).alias("c")
    s = src.withColumn("_in_s", F.lit(True)).alias("s")
    j = cur.join(s, F.col(f"c.{key}") == F.col(f"s.{key}"), "full_outer")

    in_cur = F.col("c._in_c").isNotNull()
    in_src = F.col("s._in_s").isNotNull()
    changed = in_cur & in_src & differs([F.col(f"s.{c}") for c in tracked], [F.col(f"c.{c}") for c in tracked])
    c_from = F.col(f"c.{VALID_FROM}")
    close = changed & (c_from < eff)
    replace = changed & (c_from == eff)
    out_of_order = changed & (c_from > eff)
    insert = (in_src & ~in_cur) | close

    def version(prefix: str, valid_from: Column, valid_to: Column, current: Column, key_col: Column) -> Column:
        fields = [F.col(f"{prefix}.{c}").alias(c) for c in attrs]
        fields += [valid_from.alias(VALID_FROM), valid_to.alias(VALID_TO), current.alias(CURRENT), key_col.alias(sk)]
        return F.struct(*fields)

    kept = version("c", c_from, F.col(f"c.{VALID_TO}"), F.col(f"c.{CURRENT}"), F.col(f"c.{sk}"))
    closed = version("c", c_from, eff, F.lit(False), F.col(f"c.{sk}"))
    replaced = version("s", c_from, F.col(f"c.{VALID_TO}"), F.lit(True), F.col(f"c.{sk}"))
    opened = version("s", eff, F.lit(None).cast("timestamp"), F.lit(True), versioned_key(F.col(f"s.{key}"), eff))

    first = (
        F.when(out_of_order, F.raise_error(F.concat(F.lit(f"type-2 load out of order for {key}="), F.col(f"s.{key}").cast("string"))))
        .when(replace, replaced)
        .when(close, closed)
        .when(in_cur, kept)
    )
    second = F.when(insert, opened)
    rows = j.select(F.explode(F.array_compact(F.array(first, second))).alias("v")).select("v.*")
    return hist.unionByName(rows)

