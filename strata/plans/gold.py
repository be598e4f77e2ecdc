"""The gold step of one batch, over a :class:`Lake`."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.history import keys_that_differ
from strata.operators.quality import SOFT_CHECKS, Counts, soft_check_counts
from strata.plans import aggs, dims, facts
from strata.plans.conform import ENTITIES
from strata.session import together
from strata.sources.lake import BUCKET, Lake
from strata.sources.specs import BATCH_ID

SILVER_SCHEMAS = {
    "customer": "customer_id string, customer_unique_id string, zip_prefix string, city string, state string, "
    "_ingest_ts timestamp, _batch_id string",
    "seller": "seller_id string, zip_prefix string, city string, state string, _ingest_ts timestamp, _batch_id string",
    "geolocation": "zip_prefix string, lat double, lng double, n_points long, _ingest_ts timestamp, _batch_id string",
    "order": "order_id string, customer_id string, order_status string, purchase_ts timestamp, approved_ts timestamp, "
    "delivered_carrier_ts timestamp, delivered_customer_ts timestamp, estimated_delivery_ts timestamp, "
    "_ingest_ts timestamp, _batch_id string",
    "order_item": "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_ts timestamp, "
    "price decimal(12,2), freight_value decimal(12,2), _ingest_ts timestamp, _batch_id string",
    "order_payment": "order_id string, payment_sequential int, payment_type string, payment_installments int, "
    "payment_value decimal(12,2), _ingest_ts timestamp, _batch_id string",
    "order_review": "review_id string, order_id string, review_score int, comment_title string, comment_message string, "
    "creation_ts timestamp, answer_ts timestamp, _ingest_ts timestamp, _batch_id string",
    "product": "product_id string, category_pt string, category_en string, photos_qty int, name_length int, "
    "description_length int, weight_g int, length_cm int, height_cm int, width_cm int, _ingest_ts timestamp, "
    "_batch_id string",
}


def silver(lake: Lake, name: str) -> DataFrame:
    """A silver table, or an empty one with its declared schema."""
    from pyspark.sql.types import _parse_datatype_string

    return lake.read("silver", name, _parse_datatype_string(SILVER_SCHEMAS[name]))


def delivered(lake: Lake, entity: str, batch_id: str) -> DataFrame:
    """The rows of ``entity`` this batch put into silver: its staging slice
    (the batch's own rows, not a scan of the table), less those that a newer
    batch has delivered since."""
    staged = lake.read_batch("ops", f"stage_silver_{entity}", batch_id)
    table = silver(lake, entity)
    if staged is None:
        return table.limit(0)
    keys = list(ENTITIES[entity].keys)
    staged = staged.drop("_batch_id").withColumnRenamed("_version", "_batch_id").select(*table.columns)
    newest = lake.newest("silver", entity)
    if newest is not None and newest <= batch_id:
        return staged  # no newer batch has written the table
    newer = lake.read_touched("silver", entity, staged.select(*keys), keys).filter(F.col("_batch_id") > batch_id)
    return staged.join(newer.select(*keys), keys, "left_anti")


def narrowed(lake: Lake, entity: str, by: DataFrame) -> DataFrame:
    """The rows of a silver table whose columns match a row of ``by``, read
    from the buckets that may hold them only (``by`` has the columns that
    the table is bucketed by)."""
    table = silver(lake, entity)
    near = lake.read_touched("silver", entity, by, list(ENTITIES[entity].keys))
    near = table if near is None else near.select(*table.columns)
    return near.join(by, by.columns, "left_semi")


def with_batch_rows(lake: Lake, entity: str, touched_orders: DataFrame, batch_id: str) -> DataFrame:
    """Rows of orders this batch changed (their facts depend on the order's
    dates and status), plus rows delivered by this batch for other orders. The
    delivered rows are in silver already, so the two parts share none."""
    touched = touched_orders.select("order_id")
    changed = narrowed(lake, entity, touched)
    rest = delivered(lake, entity, batch_id).join(touched, "order_id", "left_anti")
    return changed.unionByName(rest.select(*changed.columns))


def stage_orders_of(lake: Lake, name: str, rows: DataFrame, batch_id: str) -> tuple[DataFrame, DataFrame]:
    """The orders of ``rows``, staged since several steps read them, and the
    customers of these orders."""
    orders = silver(lake, "order")
    near = narrowed(lake, "order", rows.select("order_id"))
    lake.write_batch(near.drop(BATCH_ID), "ops", f"stage_orders_of_{name}", batch_id)
    staged = lake.read_batch("ops", f"stage_orders_of_{name}", batch_id)
    near = orders.limit(0) if staged is None else staged.select(*orders.columns)
    return near, narrowed(lake, "customer", near.select("customer_id"))


def products_of(lake: Lake, batch_id: str) -> DataFrame:
    """Products this batch delivered, or relabelled by a new translation."""
    own = delivered(lake, "product", batch_id)
    refreshed = lake.read_batch("ops", "stage_product_refresh", batch_id)
    if refreshed is None:
        return own
    refreshed = refreshed.drop("_batch_id").withColumnRenamed("_version", "_batch_id").select(*own.columns)
    return refreshed.join(own.select("product_id"), "product_id", "left_anti").unionByName(own)


SEEN = "seen_products"


def observe_products(lake: Lake, batch_id: str) -> tuple[int, list[str]]:
    """Keep what this batch says of its products (``state/seen_products``, a
    slice per batch; products it named in an earlier run and no longer names
    stay, as in silver). Returns the rows this run said and the batches that
    had been seen before. A product relabelled by the batch's translations
    counts as said by it, unless a newer batch has delivered the product."""
    before = [d.split("=", 1)[1] for d in lake.list_dirs(lake.path("state", SEEN)) if d.startswith(f"{BATCH_ID}=")] if lake.exists("state", SEEN) else []
    parts = []
    own = lake.read_batch("ops", "stage_silver_product", batch_id)
    if own is not None:
        parts.append(own.select(*dims.PRODUCT_ATTRS))
    relabelled = lake.read_batch("ops", "stage_product_refresh", batch_id)
    if relabelled is not None:
        known = [p.select("product_id") for p in parts]
        if before:
            known.append(lake.read("state", SEEN).filter(F.col(BATCH_ID) > batch_id).select("product_id"))
        relabelled = relabelled.select(*dims.PRODUCT_ATTRS)
        parts.append(relabelled.join(_union(known), "product_id", "left_anti") if known else relabelled)
    if not parts:
        return 0, before
    said = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    n = lake.replace_batch(said, "ops", "stage_said_products", batch_id)
    if not n:
        return 0, before
    said = lake.read_batch("ops", "stage_said_products", batch_id).select(*dims.PRODUCT_ATTRS)
    earlier = lake.read_batch("state", SEEN, batch_id) if before else None
    if earlier is not None:
        said = said.unionByName(earlier.select(*dims.PRODUCT_ATTRS).join(said.select("product_id"), "product_id", "left_anti"))
        lake.write_batch(said, "ops", "stage_seen_products", batch_id)
        said = lake.read_batch("ops", "stage_seen_products", batch_id).select(*dims.PRODUCT_ATTRS)
    lake.write_batch(said, "state", SEEN, batch_id)
    return n, before


def splice_products(lake: Lake, batch_id: str, before: list[str]) -> None:
    """Bring a batch that is not the newest, or comes again, into the
    history: the versions of its products are made anew from all that was
    ever seen of them, so batches in any order give the same dimension. A
    batch older than all others becomes the first one, and the versions of
    every product are made anew, since the first one's are valid from the
    start. Products whose intervals changed are staged: their orders' facts
    are made anew."""
    seen = lake.read("state", SEEN)
    touched = seen if batch_id < min(before) else seen.filter(F.col(BATCH_ID) == batch_id)
    lake.remember(touched.select("product_id").distinct(), "touched_seen_products", batch_id)
    touched = lake.read_batch("ops", "touched_seen_products", batch_id).select("product_id")
    first = min([batch_id, *before])
    lake.set_marker(lake.path("gold", "dim_product"), "_first_batch", first)
    fresh = dims.dim_product_seen(seen.join(touched, "product_id", "left_semi"), first)
    old = lake.read_touched("gold", "dim_product", touched, ["product_id"]).join(touched, "product_id", "left_semi")
    lake.remember(keys_that_differ(old, fresh, "product_id"), "touched_versions", batch_id)
    lake.refresh_keyed(fresh, touched, "gold", "dim_product", ["product_id"])


def build_dim_product(lake: Lake, batch_id: str) -> Counts | None:
    """Type-2 load of the products this batch delivered, reading and
    rewriting only the dimension buckets those products live in. The
    first load also writes the unknown member (key -1). A batch newer than
    all others is applied to the current versions; one that is older, or
    comes again, is spliced into the history. (A dimension made before
    observations were kept goes on without them.)"""
    start = not lake.exists("gold", "dim_product")
    if start or lake.exists("state", SEEN):
        n, before = observe_products(lake, batch_id)
        if not n:
            return None
        if not start and (batch_id in before or any(b > batch_id for b in before)):
            splice_products(lake, batch_id, before)
            return Counts(n, n, 0)
    src = products_of(lake, batch_id).select(*dims.PRODUCT_ATTRS)
    n = lake.replace_batch(src, "ops", "stage_dim_product", batch_id)
    if not n:
        return None
    src = lake.read_batch("ops", "stage_dim_product", batch_id).drop("_batch_id")
    path = lake.path("gold", "dim_product")
    if start:
        first = dims.dim_product(None, src, None).unionByName(dims.unknown_product(lake.spark))
        lake.replace_keyed(first, "gold", "dim_product", ["product_id"])
        lake.set_marker(path, "_first_batch", batch_id)
    else:
        again = lake.marker(path, "_first_batch") == batch_id
        current = lake.read_touched("gold", "dim_product", src, ["product_id"]).drop(BUCKET)
        lake.replace_keyed(dims.dim_product(current, src, None if again else batch_id), "gold", "dim_product", ["product_id"])
    return Counts(n, n, 0)


ITEM_KEYS = ["order_id", "order_item_id"]


def stage_fact_orders(lake: Lake, orders: DataFrame | None, gone: DataFrame | None, batch_id: str) -> None:
    """The orders whose fact rows this batch writes (a row for each in
    ``orders``) or removes."""
    parts = [p.select("order_id") for p in (orders, gone) if p is not None]
    lake.remember(_union(parts) if gone is not None else parts[0], "touched_fact_orders", batch_id)


def delete_gone_facts(lake: Lake, table: str, gone: DataFrame | None, keys: list[str]) -> None:
    if gone is None or not lake.exists("gold", table):
        return
    lake.refresh_keyed(lake.read("gold", table).limit(0), gone.select(*keys), "gold", table, keys)


def refresh_aggregates(lake: Lake, batch_id: str) -> None:
    """Bring the aggregates up to the fact by signed deltas.

    State: per aggregate the sums of each (bucket of the fact, group), and
    of each group. A batch sums up the buckets it rewrote, anew minus old is
    added to its groups' sums, and an extreme that was retracted is sought
    among the parts of its group. The fact's other buckets are not read. All
    new state is staged first and a mark set; replacing the state by it can be
    repeated, so a run that broke off is brought to its end before the next
    deltas are taken. The first build sums up the whole fact.
    """

    def refresh(agg: aggs.Aggregate) -> None:
        if not lake.exists("state", f"part_{agg.table}"):
            build_aggregate(lake, agg)
            return
        replace_state(lake, agg)
        orders = lake.read_batch("ops", "touched_fact_orders", batch_id)
        if orders is not None:
            stage_state(lake, agg, orders.select("order_id"), batch_id)
            replace_state(lake, agg)

    together(lake.spark, [partial(refresh, agg) for agg in aggs.AGGREGATES])


def build_aggregate(lake: Lake, agg: aggs.Aggregate) -> None:
    fact = lake.read_buckets("gold", "fact_order_items")
    if fact is None:
        return
    lake.replace_keyed(agg.sums(fact), "state", f"sum_{agg.table}", [agg.group], whole=True)
    sums = lake.read("state", f"sum_{agg.table}")
    lake.replace_keyed(agg.result(sums), "gold", agg.table, [agg.group], whole=True)
    lake.replace_keyed(agg.sums(fact, BUCKET), "state", f"part_{agg.table}", [BUCKET], whole=True)


def stage_state(lake: Lake, agg: aggs.Aggregate, orders: DataFrame, batch_id: str) -> None:
    """Stage the new parts of the buckets that hold ``orders`` and the new
    sums of the groups these change, and mark them as ready."""
    def staged(df: DataFrame, name: str) -> DataFrame:
        lake.write_batch(df, "ops", name, batch_id)
        back = lake.read_batch("ops", name, batch_id)
        return lake.spark.createDataFrame([], df.schema) if back is None else back.select(*df.columns)

    hit = lake.buckets_holding("gold", "fact_order_items", orders, ITEM_KEYS)
    parts = lake.read_buckets("state", f"part_{agg.table}")
    fact = lake.read_buckets("gold", "fact_order_items", hit)
    new = parts.limit(0) if fact is None else agg.sums(fact, BUCKET)
    new = staged(new.select(F.col(BUCKET).alias("fact_bucket"), *[c for c in parts.columns if c != BUCKET]), f"stage_part_{agg.table}")
    change = staged(aggs.delta(agg, new, parts.filter(F.col(BUCKET).isin(hit))), f"stage_delta_{agg.table}")
    sums = lake.read_touched("state", f"sum_{agg.table}", change, [agg.group])
    if sums is None:  # the last group went with an earlier batch
        sums = lake.spark.createDataFrame([], new.drop("fact_bucket").schema)
    after = staged(aggs.applied(agg, change, sums), f"stage_after_{agg.table}")
    if agg.extremes and not after.filter("_again").isEmpty():
        columns = [agg.group, *agg.extremes]
        rest = parts.filter(~F.col(BUCKET).isin(hit)).select(*columns).unionByName(new.select(*columns))
        staged(aggs.with_extremes(agg, after, rest), f"stage_sum_{agg.table}")
    else:
        staged(after.drop("_again"), f"stage_sum_{agg.table}")
    lake.set_marker(lake.path("state", f"part_{agg.table}"), "_replace", f"{batch_id} {','.join(map(str, hit))}")


def replace_state(lake: Lake, agg: aggs.Aggregate) -> None:
    """Replace parts, sums and the aggregate's rows by what a mark says is
    staged for them, then drop the mark."""
    path = lake.path("state", f"part_{agg.table}")
    mark = lake.marker(path, "_replace")
    if not mark:
        return
    batch_id, _, hit = mark.partition(" ")
    change = lake.read_batch("ops", f"stage_delta_{agg.table}", batch_id)
    if change is not None:
        sums = lake.read_batch("ops", f"stage_sum_{agg.table}", batch_id).drop("_batch_id").filter(F.col("orders") > 0)
        lake.refresh_keyed(sums, change, "state", f"sum_{agg.table}", [agg.group])
        lake.refresh_keyed(agg.result(sums), change, "gold", agg.table, [agg.group])
    new = lake.read_batch("ops", f"stage_part_{agg.table}", batch_id)
    columns = lake.read_buckets("state", f"part_{agg.table}")
    new = columns.limit(0) if new is None else new.withColumnRenamed("fact_bucket", BUCKET).select(*columns.columns)
    lake.replace_buckets(new, "state", f"part_{agg.table}", [int(b) for b in hit.split(",") if b])
    lake.drop_marker(path, "_replace")


def log_soft_checks(lake: Lake, items: DataFrame, orders: DataFrame, batch_id: str) -> None:
    """Warnings (never rejects) on this batch's items with their orders."""
    o = orders.select("order_id", "purchase_ts", "approved_ts", "delivered_customer_ts")
    j = items.select("order_id", "shipping_limit_ts").join(o, "order_id")
    lake.write_batch(soft_check_counts(j, SOFT_CHECKS), "ops", "soft_checks", batch_id)


# Type-1 dimensions and the silver tables they depend on.
DIM_INPUTS = {
    "dim_customer": {"customer", "order", "geolocation"},
    "dim_seller": {"seller", "geolocation"},
}


def _previous(lake: Lake, entity: str, batch_id: str, col: str, prefix: str = "prev") -> DataFrame | None:
    """Earlier values staged by silver: of re-delivered keys (prev) or of
    keys a pruning re-run removed (gone)."""
    prev = lake.read_batch("ops", f"{prefix}_{entity}", batch_id)
    return None if prev is None else prev.select(col)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def zips_changed(lake: Lake, geo: DataFrame, batch_id: str) -> DataFrame:
    """Zips whose centroid this batch recomputed or removed."""
    zips = lake.read_batch("ops", "touched_zips", batch_id)
    return (geo.limit(0) if zips is None else zips).select("zip_prefix")


def touched_persons(lake: Lake, batch_id: str, customers: DataFrame, orders: DataFrame, geo: DataFrame) -> DataFrame:
    """People whose type-1 row this batch can change: their customer
    records arrived or left them, one of their orders arrived or moved
    away, or the geolocation of a zip they live at changed."""
    persons = [delivered(lake, "customer", batch_id).select("customer_unique_id")]
    for prefix in ("prev", "gone"):
        earlier = _previous(lake, "customer", batch_id, "customer_unique_id", prefix)
        if earlier is not None:
            persons.append(earlier)
    buyers = [delivered(lake, "order", batch_id).select("customer_id")]
    for prefix in ("prev", "gone"):
        earlier = _previous(lake, "order", batch_id, "customer_id", prefix)
        if earlier is not None:
            buyers.append(earlier)
    persons.append(narrowed(lake, "customer", _union(buyers)).select("customer_unique_id"))
    zips = zips_changed(lake, geo, batch_id)
    persons.append(customers.join(zips, "zip_prefix", "left_semi").select("customer_unique_id"))
    return _union(persons)


def build_dim_customer(lake: Lake, batch_id: str, customers: DataFrame, orders: DataFrame, geo: DataFrame) -> None:
    """Type-1 customer dimension: the first build is full; later batches
    recompute only the touched people (their records, and only their
    customers' orders) and rewrite only the buckets holding them."""
    if not lake.exists("gold", "dim_customer"):
        lake.replace_keyed(dims.dim_customer(customers, orders, geo), "gold", "dim_customer", ["customer_unique_id"])
        return
    lake.remember(touched_persons(lake, batch_id, customers, orders, geo), "touched_dim_customer", batch_id)
    touched = lake.read_batch("ops", "touched_dim_customer", batch_id)
    if touched is None:
        return
    touched = touched.select("customer_unique_id")
    fresh = dims.dim_customer_of(touched, customers, orders, geo)
    lake.refresh_keyed(fresh, touched, "gold", "dim_customer", ["customer_unique_id"])


def build_dim_seller(lake: Lake, batch_id: str, sellers: DataFrame, geo: DataFrame) -> None:
    """Type-1 seller dimension, refreshed for sellers delivered in this
    batch or located at a zip whose geolocation changed."""
    if not lake.exists("gold", "dim_seller"):
        lake.replace_keyed(dims.dim_seller(sellers, geo), "gold", "dim_seller", ["seller_id"])
        return
    zips = zips_changed(lake, geo, batch_id)
    parts = [
        delivered(lake, "seller", batch_id).select("seller_id"),
        sellers.join(zips, "zip_prefix", "left_semi").select("seller_id"),
    ]
    removed = _previous(lake, "seller", batch_id, "seller_id", "gone")
    if removed is not None:
        parts.append(removed)
    lake.remember(_union(parts), "touched_dim_seller", batch_id)
    staged = lake.read_batch("ops", "touched_dim_seller", batch_id)
    if staged is None:
        return
    staged = staged.select("seller_id")
    fresh = dims.dim_seller(sellers.join(staged, "seller_id", "left_semi"), geo)
    lake.refresh_keyed(fresh, staged, "gold", "dim_seller", ["seller_id"])


def build_dim_date(lake: Lake, orders: DataFrame, date_range: tuple[str, str] | None) -> None:
    """The calendar: a given range, or whole years around the purchase,
    delivery and estimate days in ``orders``. It is rewritten when a batch
    brings days it lacks, and never shrinks."""
    days = ("purchase_ts", "delivered_customer_ts", "estimated_delivery_ts")
    if date_range is None:
        b = orders.agg(F.min(F.least(*days)).alias("lo"), F.max(F.greatest(*days)).alias("hi")).first()
        if b["lo"] is None:
            return
        date_range = (f"{b['lo'].year:04d}-01-01", f"{b['hi'].year:04d}-12-31")
    lo, hi = date_range
    path = lake.path("gold", "dim_date")
    if kept := lake.marker(path, "_range"):
        old_lo, old_hi = kept.split()
        if old_lo <= lo and hi <= old_hi:
            return
        lo, hi = min(lo, old_lo), max(hi, old_hi)
    lake.overwrite(dims.dim_date(lake.spark, lo, hi), "gold", "dim_date")
    lake.set_marker(path, "_range", f"{lo} {hi}")


def stage_gone_facts(lake: Lake, table: str, staged: DataFrame | None, touched: DataFrame, keys: list[str], batch_id: str) -> DataFrame | None:
    """Fact rows of touched orders that a pruning re-run no longer gives:
    their item, order or customer went."""
    fact = lake.read_touched("gold", table, touched.select("order_id"), keys)
    if fact is None:
        return None
    gone = fact.join(touched.select("order_id"), "order_id", "left_semi")
    if staged is not None:
        gone = gone.join(staged.select(*keys), keys, "left_anti")
    lake.remember(gone.select(*keys), f"gone_{table}", batch_id)
    return lake.read_batch("ops", f"gone_{table}", batch_id)


def build_gold(
    lake: Lake,
    batch_id: str,
    date_range: tuple[str, str] | None = None,
    changed: set[str] | None = None,
    prune: bool = False,
) -> dict[str, Counts]:
    """Gold for one batch. ``changed`` names the silver tables this batch
    delivered rows to; a type-1 dimension none of whose inputs changed is
    not rebuilt (None: rebuild all). The calendar follows the data unless
    ``date_range`` gives its first and last day."""
    spark = lake.spark

    def stale(dim: str) -> bool:
        return changed is None or bool(DIM_INPUTS[dim] & changed) or not lake.exists("gold", dim)

    customers, orders, geo = silver(lake, "customer"), silver(lake, "order"), silver(lake, "geolocation")
    own_orders = delivered(lake, "order", batch_id)

    def gone(entity: str, col: str) -> DataFrame | None:
        rows = lake.read_batch("ops", f"gone_{entity}", batch_id) if prune else None
        return None if rows is None else rows.select(col)

    def touched_orders() -> DataFrame:
        # orders whose facts this batch changes: delivered now, or placed by a
        # customer record delivered now (it may belong to another person), or
        # with a product whose versions were spliced anew (the only look at all
        # items), or (pruning) withdrawn, or with a withdrawn customer, item or payment
        own_customers = lake.read_batch("ops", "stage_silver_customer", batch_id)  # without any, no scan of the orders
        buyers = [None if own_customers is None else delivered(lake, "customer", batch_id).select("customer_id"), gone("customer", "customer_id")]
        parts = [own_orders.select("order_id"), gone("order", "order_id"), gone("order_item", "order_id"), gone("order_payment", "order_id")]
        parts += [orders.join(b, "customer_id", "left_semi").select("order_id") for b in buyers if b is not None]
        if (spliced := lake.read_batch("ops", "touched_versions", batch_id)) is not None:
            parts.append(silver(lake, "order_item").join(spliced.select("product_id"), "product_id", "left_semi").select("order_id"))
        lake.write_batch(_union([p for p in parts if p is not None]), "ops", "stage_orders", batch_id)
        touched = lake.read_batch("ops", "stage_orders", batch_id)
        return (orders.limit(0) if touched is None else touched).select("order_id")

    def item_fact(touched: DataFrame) -> dict[str, Counts]:
        # the batch's items are gathered once, and so are their orders; customers
        # are narrowed to them before they are joined
        counts = {}
        products = lake.read("gold", "dim_product")
        if products is None:
            products = dims.unknown_product(spark).filter(F.lit(False))
        n_items = lake.replace_batch(with_batch_rows(lake, "order_item", touched, batch_id).withColumnRenamed("_batch_id", "_version"), "ops", "stage_items", batch_id)
        staged, near_orders, n_out = None, None, 0
        if n_items:
            items = lake.read_batch("ops", "stage_items", batch_id).drop("_batch_id")
            near_orders, near_customers = stage_orders_of(lake, "items", items, batch_id)
            fact = facts.fact_order_items(items, near_orders, near_customers, products)
            n_out, _ = together(
                spark,
                [partial(lake.replace_batch, fact, "ops", "stage_fact_order_items", batch_id), partial(log_soft_checks, lake, items, near_orders, batch_id)],
            )
            staged = lake.read_batch("ops", "stage_fact_order_items", batch_id)
            counts["fact_order_items"] = Counts(n_items, n_out, n_items - n_out)  # inner join on a key: the rest are orphans
        gone_facts = stage_gone_facts(lake, "fact_order_items", staged, touched, ITEM_KEYS, batch_id) if prune else None
        if staged is not None or gone_facts is not None:
            stage_fact_orders(lake, None if staged is None else near_orders, gone_facts, batch_id)
            if staged is not None:
                lake.upsert_keyed(staged, "gold", "fact_order_items", ITEM_KEYS, label_col="_batch_id", batch_id=batch_id)
            delete_gone_facts(lake, "fact_order_items", gone_facts, ITEM_KEYS)
            refresh_aggregates(lake, batch_id)
        return counts

    def other_fact(table: str, entity: str, fact: DataFrame) -> dict[str, Counts]:
        # computed once into a staging slice, then upserted from it; facts
        # are made from guarded silver, so they need no version of their own
        keys = list(ENTITIES[entity].keys)
        n = lake.replace_batch(fact, "ops", f"stage_{table}", batch_id)
        if n:
            lake.upsert_keyed(lake.read_batch("ops", f"stage_{table}", batch_id), "gold", table, keys, label_col="_batch_id", batch_id=batch_id)
        if prune:
            delete_gone_facts(lake, table, lake.read_batch("ops", f"gone_{entity}", batch_id), keys)
        return {table: Counts(n, n, 0)} if n else {}

    def payment_fact(touched: DataFrame) -> dict[str, Counts]:
        payments = with_batch_rows(lake, "order_payment", touched, batch_id).withColumnRenamed("_batch_id", "_version")
        if lake.write_batch(payments, "ops", "stage_payments", batch_id):
            payments = lake.read_batch("ops", "stage_payments", batch_id)
        else:
            payments = silver(lake, "order_payment").limit(0)
        near_orders, near_customers = stage_orders_of(lake, "payments", payments, batch_id)
        return other_fact("fact_payments", "order_payment", facts.fact_payments(payments, near_orders, near_customers))

    def review_fact() -> dict[str, Counts]:
        return other_fact("fact_reviews", "order_review", facts.fact_reviews(delivered(lake, "order_review", batch_id)))

    def product_and_order_facts() -> dict[str, Counts]:
        c = build_dim_product(lake, batch_id)
        touched = touched_orders()
        items, payments = together(spark, [partial(item_fact, touched), partial(payment_fact, touched)])
        return ({} if c is None else {"dim_product": c}) | items | payments

    # what does not need another's tables is built side by side
    steps = [product_and_order_facts, review_fact, partial(build_dim_date, lake, own_orders, date_range)]
    if stale("dim_customer"):
        steps.append(partial(build_dim_customer, lake, batch_id, customers, orders, geo))
    if stale("dim_seller"):
        steps.append(partial(build_dim_seller, lake, batch_id, silver(lake, "seller"), geo))
    order_counts, review_counts, *_ = together(spark, steps)
    return order_counts | review_counts
