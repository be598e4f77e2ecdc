"""Bronze ingest and the silver step of one batch, over a :class:`Lake`."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.dedupe import latest_per_key
from strata.operators.quality import REASON, Counts, clean_part, rejected_part, tag_rejects
from strata.plans.conform import ENTITIES, Entity, centroids, point_sums
from strata.session import cut_lineage, together
from strata.sources.csv import read_raw
from strata.sources.lake import Lake
from strata.sources.specs import BATCH_ID, META, RAW_RECORD, SOURCES, Source


def source_path(lake: Lake, batches_dir: str, batch_id: str, source: Source) -> str | None:
    """Where a batch's file of ``source`` lives: ``<dir>/<batch>/<file>``
    (one folder per batch), or ``<dir>/<source>/batch_id=<batch>/`` (as a
    partitioned writer lays it out); None when the batch lacks it."""
    root = batches_dir.rstrip("/")
    for candidate in (f"{root}/{batch_id}/{source.file}", f"{root}/{source.name}/batch_id={batch_id}"):
        if lake.path_exists(candidate):
            return candidate
    return None


def ingest_bronze(lake: Lake, batches_dir: str, batch_id: str) -> dict[str, Counts]:
    """Replace this batch's slice of every bronze table whose file exists
    in the batch (a header-only file empties the slice)."""

    def ingest(name: str, source: Source) -> Counts | None:
        path = source_path(lake, batches_dir, batch_id, source)
        if path is None:
            return None
        raw = read_raw(lake.spark, path, source, batch_id)
        n = lake.replace_batch(raw, "bronze", name, batch_id)
        return Counts(n, n, 0)

    counts = together(lake.spark, [partial(ingest, *named) for named in SOURCES.items()])
    return {name: c for name, c in zip(SOURCES, counts) if c is not None}


def with_raw_record(raw: DataFrame, source: str) -> DataFrame:
    """The source columns of each row as one struct, :data:`RAW_RECORD`."""
    cols = [c for c in SOURCES[source].columns if c in raw.columns]
    return raw.withColumn(RAW_RECORD, F.struct(*[F.col(f"`{c}`") for c in cols]))


def raw_as_text(rejected: DataFrame) -> DataFrame:
    """The raw record as JSON text, made for rejected rows only."""
    return rejected.withColumn(RAW_RECORD, F.to_json(F.col(RAW_RECORD), {"ignoreNullFields": "false"}))


def raw_from_text(quarantine: DataFrame, source: str) -> DataFrame:
    """The raw records of quarantined rows, as their source delivered them:
    the source's columns (all text), the audit columns and ``_raw``."""
    schema = ", ".join(f"`{c}` string" for c in SOURCES[source].columns)
    record = F.from_json(RAW_RECORD, schema, {"mode": "FAILFAST"}).alias("_record")
    return quarantine.select(record, RAW_RECORD, *META).select("_record.*", RAW_RECORD, *META)


def conform(lake: Lake, entity: Entity, raw: DataFrame) -> DataFrame:
    if entity.name == "product":
        translation = lake.read("silver", "category_translation")
        if translation is None:
            translation = lake.spark.createDataFrame([], "category_pt string, category_en string")
        return entity.conform(raw, translation)
    return entity.conform(raw)


def typed_slice(lake: Lake, entity: Entity, batch_id: str) -> DataFrame | None:
    raw = lake.read_batch("bronze", entity.source, batch_id)
    if raw is None:
        return None
    return conform(lake, entity, with_raw_record(raw, entity.source))


def keep_point_sums(lake: Lake, batch_id: str, points: DataFrame) -> None:
    """Per zip the sums of this batch's valid points, in place of those of
    its last run."""
    lake.write_batch(point_sums(points), "state", "zip_points", batch_id)


def centroids_of(lake: Lake, zips: DataFrame) -> DataFrame:
    """Centroids of the given zips from the sums of every batch, so a zip
    re-delivered later keeps the points of earlier batches."""
    return centroids(lake.read("state", "zip_points").join(zips, "zip_prefix", "left_semi"))


def restore_point_sums(lake: Lake, entity: Entity) -> None:
    """The sums of a lake that has bronze points but no sums yet."""
    if lake.exists("state", "zip_points") or not lake.exists("bronze", entity.source):
        return
    raw = lake.read("bronze", entity.source)
    points = clean_part(tag_rejects(conform(lake, entity, raw), list(entity.rules)))
    lake.replace_batches(point_sums(points, BATCH_ID), "state", "zip_points")


# Columns whose previous value gold needs when a key is re-delivered: a
# customer record can move to another person, an order to another customer.
TRACK_PREVIOUS = {"customer": ["customer_unique_id"], "order": ["customer_id"]}


def stage_previous_values(lake: Lake, entity: Entity, deduped: DataFrame, batch_id: str) -> None:
    """Before the upsert, keep the current values of the tracked columns
    for the keys this batch re-delivers (read from their buckets only)."""
    cols = TRACK_PREVIOUS.get(entity.name)
    if not cols:
        return
    keys = list(entity.keys)
    current = lake.read_touched("silver", entity.name, deduped.select(*keys), keys)
    if current is None:
        return
    prev = current.join(deduped.select(*keys), keys, "left_semi").select(*keys, *cols)
    lake.remember(prev, f"prev_{entity.name}", batch_id)


def touched_zips(lake: Lake, batch_id: str, points: DataFrame) -> DataFrame:
    """Zips whose centroid this delivery may change: those it delivers now
    and those the batch delivered when it was last run (their points may be
    withdrawn). The batch's own list is kept for its next run."""
    now = points.select("zip_prefix").distinct()
    earlier = lake.read_batch("ops", "zips_of_batch", batch_id)
    touched = now if earlier is None else now.unionByName(earlier.select("zip_prefix")).distinct()
    lake.remember(touched, "touched_zips", batch_id)
    lake.write_batch(now, "ops", "zips_of_batch", batch_id)
    staged = lake.read_batch("ops", "touched_zips", batch_id)
    return now if staged is None else staged.select("zip_prefix")


def stage_gone_rows(lake: Lake, entity: Entity, kept: DataFrame | None, batch_id: str) -> bool:
    """Silver rows this batch delivered earlier but no longer delivers
    (a re-run with fewer rows), staged before anything is rewritten. Tells
    whether there are any."""
    if entity.name == "geolocation" or not lake.exists("silver", entity.name):
        return False
    keys = list(entity.keys)
    labelled = lake.read("silver", entity.name).filter(F.col("_batch_id") == batch_id)
    gone = labelled if kept is None else labelled.join(kept.select(*keys), keys, "left_anti")
    return lake.remember(gone.drop("_batch_id"), f"gone_{entity.name}", batch_id)


def delete_gone_rows(lake: Lake, entity: Entity, batch_id: str) -> None:
    gone = lake.read_batch("ops", f"gone_{entity.name}", batch_id)
    if gone is None:
        return
    keys = list(entity.keys)
    empty = lake.read("silver", entity.name).limit(0)
    lake.refresh_keyed(empty, gone.select(*keys), "silver", entity.name, keys)


def load_entity(
    lake: Lake, entity: Entity, batch_id: str, prune: bool = False, delivered: set[str] | None = None
) -> Counts | None:
    """validate -> quarantine -> dedupe -> upsert.

    All rejects of the batch (every rule) replace the batch's quarantine
    slice in one write, with their raw record; the clean rows are
    deduplicated and upserted with the batch id as version, so replaying
    an older batch cannot overwrite rows a newer batch already delivered.
    Counts are read back from the written slices.
    """
    typed = typed_slice(lake, entity, batch_id)
    if typed is None:
        if entity.name == "geolocation" and entity.source in (delivered or set()):
            load_points(lake, entity, batch_id, None)
        if prune and entity.source in (delivered or set()):
            # delivered, but empty: every key this batch gave earlier is gone
            if stage_gone_rows(lake, entity, None, batch_id):
                delete_gone_rows(lake, entity, batch_id)
            return Counts(0, 0, 0)
        return None
    # the bronze slice is scanned for the rejects and for the clean rows, which
    # costs less than a tagged copy of it: a slice has as many rows as it has
    # typed ones (products meet at most one translation)
    tagged = tag_rejects(typed, list(entity.rules))
    n_in = lake.count_batch("bronze", entity.source, batch_id)
    n_bad = lake.replace_batch(raw_as_text(rejected_part(tagged)), "silver", f"quarantine_{entity.name}", batch_id)
    clean = clean_part(tagged).drop(RAW_RECORD)
    if entity.name == "geolocation":
        return Counts(n_in, load_points(lake, entity, batch_id, clean), n_bad)
    deduped = latest_per_key(clean, list(entity.keys), entity.dedupe_order())
    # The batch's clean rows are computed once, into a staging slice; the
    # previous-value staging, the bucket listing and the upsert read it.
    stage = f"stage_silver_{entity.name}"
    rows_out = lake.replace_batch(deduped.withColumnRenamed("_batch_id", "_version"), "ops", stage, batch_id)
    staged = None
    if rows_out:
        staged = lake.read_batch("ops", stage, batch_id).drop("_batch_id").withColumnRenamed("_version", "_batch_id")
    any_gone = stage_gone_rows(lake, entity, staged, batch_id) if prune else False
    if staged is not None:
        stage_previous_values(lake, entity, staged, batch_id)
        lake.upsert_keyed(staged, "silver", entity.name, list(entity.keys), version_col="_batch_id", batch_id=batch_id)
    if any_gone:
        delete_gone_rows(lake, entity, batch_id)
    return Counts(n_in, rows_out, n_bad)


def load_points(lake: Lake, entity: Entity, batch_id: str, clean: DataFrame | None) -> int:
    """Recompute the centroids of the touched zips from the sums of every
    batch's points; a zip without points loses its centroid. Returns the
    centroids."""
    points = clean if clean is not None else lake.spark.createDataFrame([], "zip_prefix string, lat double, lng double, _ingest_ts timestamp, _batch_id string")
    zips = touched_zips(lake, batch_id, points)
    restore_point_sums(lake, entity)
    keep_point_sums(lake, batch_id, points)
    keys = list(entity.keys)
    if lake.exists("state", "zip_points"):
        fresh = centroids_of(lake, zips)
    else:
        fresh = lake.read("silver", entity.name)
        if fresh is None:
            return 0
        fresh = fresh.limit(0)
    stage = f"stage_silver_{entity.name}"
    n = lake.replace_batch(fresh.withColumnRenamed("_batch_id", "_version"), "ops", stage, batch_id)
    if n:
        fresh = lake.read_batch("ops", stage, batch_id).drop("_batch_id").withColumnRenamed("_version", "_batch_id")
    elif not lake.exists("silver", entity.name):
        return 0
    else:
        fresh = lake.read("silver", entity.name).limit(0)
    lake.refresh_keyed(fresh, zips, "silver", entity.name, keys)
    return n


def refresh_product_categories(lake: Lake, batch_id: str) -> Counts | None:
    """A translation delivered by this batch reaches products already in
    silver: those whose English category changes are updated and labelled
    with this batch, so the type-2 dimension versions them from here on."""
    translation = lake.read("silver", "category_translation")
    products = lake.read("silver", "product")
    if translation is None or products is None:
        return None
    new = translation.filter(F.col("_batch_id") == batch_id).select(
        F.col("category_pt"), F.col("category_en").alias("_new_en")
    )
    stale = products.join(new, "category_pt").filter(~F.col("category_en").eqNullSafe(F.col("_new_en")))
    fixed = stale.withColumn("_was", F.col("_batch_id")).withColumn("category_en", F.col("_new_en")).drop("_new_en").withColumns(
        {"_batch_id": F.lit(batch_id), "_ingest_ts": F.current_timestamp()}
    )
    fixed = fixed.filter(F.col("_was") <= batch_id).drop("_was")  # a newer delivery of the product stays
    n = lake.replace_batch(fixed.withColumnRenamed("_batch_id", "_version"), "ops", "stage_product_refresh", batch_id)
    if not n:
        return None
    staged = lake.read_batch("ops", "stage_product_refresh", batch_id).drop("_batch_id").withColumnRenamed("_version", "_batch_id")
    lake.upsert_keyed(staged, "silver", "product", ["product_id"], version_col="_batch_id", batch_id=batch_id)
    return Counts(n, n, 0)


def replay_rejects(lake: Lake, entity: Entity, rules: list[tuple[str, str]], batch_id: str) -> Counts | None:
    """Judge a batch's quarantined records anew, by ``rules``.

    Accepted rows go to silver as rows of that batch, unless the batch or a
    newer one has given their key another row, and leave quarantine; the
    others stay there with the reason they have now. Staged as a delivery is,
    so gold can follow. Silver is written before quarantine: a replay that
    broke off is run again with the same result.
    """
    if entity.name == "geolocation":
        raise ValueError("points add up: run their batch again under the changed rules instead")
    quarantine = lake.read_batch("silver", f"quarantine_{entity.name}", batch_id)
    if quarantine is None:
        return None
    tagged = tag_rejects(conform(lake, entity, raw_from_text(quarantine, entity.source)), rules)
    n_in = lake.replace_batch(tagged.withColumnRenamed("_batch_id", "_version"), "ops", f"stage_tagged_{entity.name}", batch_id)
    tagged = lake.read_batch("ops", f"stage_tagged_{entity.name}", batch_id).drop("_batch_id").withColumnRenamed("_version", "_batch_id")
    keys = list(entity.keys)
    clean = latest_per_key(clean_part(tagged).drop(RAW_RECORD), keys, entity.dedupe_order())
    held = lake.read_touched("silver", entity.name, clean.select(*keys), keys)
    if held is not None:
        clean = clean.join(held.filter(F.col("_batch_id") >= batch_id).select(*keys), keys, "left_anti")
    stage = f"stage_silver_{entity.name}"
    if lake.resuming and (earlier := lake.read_batch("ops", stage, batch_id)) is not None:
        # rows that the broken replay has brought to silver; gold still has to follow them
        earlier = earlier.drop("_batch_id").withColumnRenamed("_version", "_batch_id").select(*clean.columns)
        clean = clean.unionByName(earlier.join(clean.select(*keys), keys, "left_anti"))
    clean = cut_lineage(lake.spark, clean)
    n_out = lake.replace_batch(clean.withColumnRenamed("_batch_id", "_version"), "ops", stage, batch_id)
    if n_out:
        staged = lake.read_batch("ops", stage, batch_id).drop("_batch_id").withColumnRenamed("_version", "_batch_id")
        stage_previous_values(lake, entity, staged, batch_id)
        lake.upsert_keyed(staged, "silver", entity.name, keys, version_col="_batch_id", batch_id=batch_id)
    n_left = lake.replace_batch(rejected_part(tagged), "silver", f"quarantine_{entity.name}", batch_id)
    return Counts(n_in, n_out, n_left)


def build_silver(
    lake: Lake, batch_id: str, prune: bool = False, delivered: set[str] | None = None
) -> dict[str, Counts]:
    """Silver for one batch. With ``prune`` a re-run that no longer
    delivers some keys removes them (default: upsert only); ``delivered``
    names the sources whose file the batch held, even if empty. The tables
    are loaded side by side, the products after the translation."""
    translated = ("category_translation", "product")

    def load(names: tuple[str, ...]) -> dict[str, Counts | None]:
        counts = {}
        for name in names:
            counts[name] = load_entity(lake, ENTITIES[name], batch_id, prune, delivered)
            if name == "category_translation" and counts[name] is not None:
                counts["product_category_refresh"] = refresh_product_categories(lake, batch_id)
        return counts

    chains = [translated, *((name,) for name in ENTITIES if name not in translated)]
    found = {name: c for part in together(lake.spark, [partial(load, chain) for chain in chains]) for name, c in part.items()}
    order = [n for name in ENTITIES for n in ((name, "product_category_refresh") if name == "category_translation" else (name,))]
    return {name: found[name] for name in order if found.get(name) is not None}


__all__ = ["ingest_bronze", "build_silver", "load_entity", "REASON"]
