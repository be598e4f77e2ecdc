"""Run batches end to end: bronze -> silver -> gold -> run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from strata.operators.quality import Counts
from strata.plans.conform import ENTITIES
from strata.plans.gold import build_gold
from strata.plans.silver import build_silver, ingest_bronze, replay_rejects
from strata.session import configure, without_call_sites
from strata.sources.lake import Lake
from strata.sources.specs import BATCH_ID, SOURCES

DQ_SCHEMA = (
    "batch_id string, layer string, tbl string, rows_in long, rows_out long, rows_quarantined long, logged_at timestamp"
)


def list_batches(lake: Lake, batches_dir: str) -> list[str]:
    """Batch ids in lexical (= time) order: sub-folders ``YYYY-MM`` of the
    batches folder, or ``batch_id=YYYY-MM`` folders under per-source
    folders (as a partitioned writer lays them out)."""
    names = set()
    for n in lake.list_dirs(batches_dir):
        if n in SOURCES:
            names.update(
                d.split("=", 1)[1] for d in lake.list_dirs(f"{batches_dir.rstrip('/')}/{n}") if d.startswith("batch_id=")
            )
        elif not n.startswith((".", "_")):
            names.add(n.split("=", 1)[1] if n.startswith("batch_id=") else n)
    return sorted(names)


@without_call_sites()
def run_batch(
    lake: Lake, batches_dir: str, batch_id: str, prune: bool = False, date_range: tuple[str, str] | None = None
) -> list[tuple]:
    """Load one batch through all layers; re-running it is idempotent, also
    after a run that broke off.

    The run log rows (one per table) replace the batch's slice of
    ``ops/dq_log``. With ``prune`` a re-run that no longer delivers some
    keys removes them from silver and from the facts built from them
    (their aggregate groups and type-1 rows are refreshed); by default
    silver and facts are upsert-only. ``date_range`` fixes the calendar,
    which else follows the data.
    """
    configure(lake.spark)
    lake.begin(batch_id)
    log: list[tuple] = []

    def add(layer: str, counts: dict[str, Counts]) -> None:
        now = datetime.now()
        for tbl, c in counts.items():
            log.append((batch_id, layer, tbl, int(c.rows_in), int(c.rows_out), int(c.rows_quarantined), now))

    bronze_counts = ingest_bronze(lake, batches_dir, batch_id)
    add("bronze", bronze_counts)
    silver_counts = build_silver(lake, batch_id, prune, delivered=set(bronze_counts))
    add("silver", silver_counts)
    changed = None if prune else {name for name, c in silver_counts.items() if c.rows_out > 0}
    add("gold", build_gold(lake, batch_id, date_range, changed=changed, prune=prune))
    lake.replace_rows(log, DQ_SCHEMA, "ops", "dq_log", batch_id)
    lake.complete(batch_id)
    return log


@without_call_sites()
def replay_quarantine(lake: Lake, name: str, rules: list[tuple[str, str]] | None = None, batches: list[str] | None = None) -> dict[str, Counts]:
    """Judge the quarantined records of silver table ``name`` anew, batch by
    batch (default: all), by ``rules`` ((reason, condition) pairs; default:
    the table's rules as they are now). What they accept goes through silver
    and gold as a delivery of its batch. Per batch: records read, rows that
    reached silver, records left in quarantine; also kept in ``ops/replays``."""
    configure(lake.spark)
    entity, out = ENTITIES[name], {}
    prefix = f"{BATCH_ID}="
    kept = [d[len(prefix) :] for d in lake.list_dirs(lake.path("silver", f"quarantine_{name}")) if d.startswith(prefix)]
    for batch_id in batches or kept:
        lake.begin(batch_id, "replay")
        counts = replay_rejects(lake, entity, list(rules or entity.rules), batch_id)
        if counts is not None:
            out[batch_id] = counts
            if counts.rows_out:
                build_gold(lake, batch_id, changed={name})
            row = (name, int(counts.rows_in), int(counts.rows_out), int(counts.rows_quarantined), datetime.now())
            lake.replace_rows([row], "tbl string, rows_in long, rows_out long, rows_left long, logged_at timestamp", "ops", "replays", batch_id)
        lake.complete(batch_id)
    return out


def run_all(spark: SparkSession, lake_root: str, batches_dir: str, batches: list[str] | None = None) -> Lake:
    lake = Lake(spark, lake_root)
    for b in batches or list_batches(lake, batches_dir):
        run_batch(lake, batches_dir, b)
    return lake
