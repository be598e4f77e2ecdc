"""DuckDB SQL twins of the driver catalogue (see :mod:`strata.catalog`).

Each statement recomputes an entry straight from the test tables, without
the raw-text round trip. Shared steps are common table expressions; a
statement includes the ones it needs. Averages are written as
``sum / count`` divisions so both engines do the same floating division.
"""

from __future__ import annotations

from strata.sources import testdata as td

# Fixed values, written out here and not taken from the engine, so that a
# wrong rule there shows as a difference.
RULE_CATEGORY = "category_pt IS NOT NULL"
RULE_CUSTOMER = "customer_id IS NOT NULL AND customer_unique_id IS NOT NULL"
RULE_SELLER = "seller_id IS NOT NULL"
REASON_OUTSIDE = "coordinates outside Brazil"
RULE_INSIDE = "lat BETWEEN -34 AND 6 AND lng BETWEEN -74 AND -34"
RULE_ZIP = "zip_prefix IS NOT NULL"
RULE_PRODUCT = "product_id IS NOT NULL AND (weight_g IS NULL OR weight_g >= 0)"
RULE_ORDER = "order_id IS NOT NULL AND customer_id IS NOT NULL AND purchase_ts IS NOT NULL"
RULE_ORDER_ITEM = (
    "order_id IS NOT NULL AND order_item_id IS NOT NULL AND product_id IS NOT NULL "
    "AND seller_id IS NOT NULL AND price >= 0 AND freight_value >= 0"
)
RULE_PAYMENT = "order_id IS NOT NULL AND payment_sequential IS NOT NULL AND payment_value >= 0"
RULE_REVIEW = "review_id IS NOT NULL AND order_id IS NOT NULL AND review_score BETWEEN 1 AND 5"
PRODUCT_TRACKED = ["category_pt", "category_en", "weight_g", "length_cm", "height_cm", "width_cm"]
HASH_SEPARATOR = "||"
HASH_NULL_TEXT = "<null>"


def initcap(x: str) -> str:
    """Spark's ``initcap``: lower-case, then capitalise after each space."""
    return f"array_to_string(list_transform(string_split(lower({x}), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"


def ymd(x: str) -> str:
    return f"CAST(strftime({x}, '%Y%m%d') AS INTEGER)"


def dedupe(src: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS _rn "
        f"FROM {src}) WHERE _rn = 1"
    )


def desc(*cols: str) -> str:
    return ", ".join(f"{c} DESC NULLS LAST" for c in cols)


CHANGE_TS = f"TIMESTAMP '{td.CHANGE_START}'"
INITIAL_TS = "TIMESTAMP '1900-01-01 00:00:00'"

CTE: dict[str, str] = {}

CTE["places"] = """places AS (
  SELECT n.n_nationkey, n.n_name AS city_raw, lower(r.r_name) AS state_raw
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

CTE["cust_t"] = f"""cust_t AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS customer_id, CASE WHEN c.c_acctbal >= {td.POOR} THEN 'person-' || CAST(c.c_custkey // 2 AS VARCHAR) END AS customer_unique_id,
         lpad(CAST(c.c_nationkey AS VARCHAR), 5, '0') AS zip_prefix,
         {initcap('trim(p.city_raw)')} AS city, upper(trim(p.state_raw)) AS state
  FROM customer c LEFT JOIN places p ON c.c_nationkey = p.n_nationkey)"""
CTE["cust_c"] = f"""cust_c AS ({dedupe(f"(SELECT * FROM cust_t WHERE coalesce({RULE_CUSTOMER}, false))", "customer_id",
                                      desc("customer_unique_id", "zip_prefix", "city", "state"))})"""

CTE["sell_t"] = f"""sell_t AS (
  SELECT s.id AS seller_id, lpad(CAST(s.s_nationkey AS VARCHAR), 5, '0') AS zip_prefix,
         {initcap('trim(p.city_raw)')} AS city, upper(trim(p.state_raw)) AS state
  FROM (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_nationkey FROM supplier
        UNION ALL SELECT NULL, s_nationkey FROM supplier WHERE s_acctbal < 0) s LEFT JOIN places p ON s.s_nationkey = p.n_nationkey)"""
CTE["sell_c"] = f"""sell_c AS ({dedupe(f"(SELECT * FROM sell_t WHERE coalesce({RULE_SELLER}, false))", "seller_id",
                                      desc("zip_prefix", "city", "state"))})"""

CTE["geo_tag"] = f"""geo_tag AS (
  SELECT *, CASE WHEN NOT coalesce({RULE_INSIDE}, false) THEN '{REASON_OUTSIDE}'
                 WHEN NOT coalesce({RULE_ZIP}, false) THEN '{RULE_ZIP}' END AS _reject_reason
  FROM (SELECT CASE WHEN NOT (event_type = 'error' AND value < {td.SMALL_EVENT}) THEN lpad(CAST(user_id AS VARCHAR), 5, '0') END AS zip_prefix,
               floor(value) / 4 - 30 AS lat, -40 - floor(value) / 8 AS lng FROM events))"""
CTE["geo_c"] = """geo_c AS (
  SELECT zip_prefix, sum(lat) / count(lat) AS lat, sum(lng) / count(lng) AS lng, count(*) AS n_points
  FROM geo_tag WHERE _reject_reason IS NULL GROUP BY zip_prefix)"""

CTE["tr"] = f"""tr AS (
  SELECT DISTINCT CASE WHEN p_type <> '{td.UNTRANSLATED}' THEN p_type END AS category_pt, lower(p_type) AS category_en FROM part)"""
CTE["tr_c"] = f"""tr_c AS (SELECT * FROM tr WHERE coalesce({RULE_CATEGORY}, false))"""


def _product_select(cat: str, weight: str, photos: str) -> str:
    return f"""CAST(p.p_partkey AS VARCHAR) AS product_id, {cat} AS category_pt,
         coalesce(tr_c.category_en, {cat}, 'unknown') AS category_en,
         CAST({photos} AS INTEGER) AS photos_qty, CAST(length(p.p_name) AS INTEGER) AS name_length,
         CAST(length(p.p_brand) + length(p.p_type) AS INTEGER) AS description_length,
         CAST(trunc({weight}) AS INTEGER) AS weight_g, p.p_size AS length_cm,
         CAST(length(p.p_type) AS INTEGER) AS height_cm, CAST(length(p.p_brand) AS INTEGER) AS width_cm"""


_WEIGHT1 = f"CASE WHEN p.p_size = {td.BAD_SIZE} THEN -p.p_retailprice ELSE p.p_retailprice END"
CTE["p1_t"] = f"""p1_t AS (
  SELECT {_product_select('p.p_type', _WEIGHT1, 'length(p.p_brand) - 6')}
  FROM part p LEFT JOIN tr_c ON p.p_type = tr_c.category_pt WHERE p.p_size < {td.NEW_PRODUCT_MIN_SIZE})"""
CTE["pa_t"] = f"""pa_t AS (
  SELECT {_product_select('p.p_type', _WEIGHT1, 'length(p.p_brand) - 6')}
  FROM part p LEFT JOIN tr_c ON p.p_type = tr_c.category_pt)"""
_RED = "starts_with(p.p_name, 'red')"
_BLUE = "starts_with(p.p_name, 'blue')"
_CAT2 = f"CASE WHEN {_RED} THEN '{td.UNTRANSLATED}' ELSE p.p_type END"
CTE["p2_t"] = f"""p2_t AS (
  SELECT {_product_select(_CAT2, f"CASE WHEN {_RED} THEN floor(p.p_retailprice * 1.1) ELSE p.p_retailprice END",
                           f"length(p.p_brand) - 6 + CASE WHEN {_BLUE} THEN 1 ELSE 0 END")}
  FROM part p LEFT JOIN tr_c ON {_CAT2} = tr_c.category_pt)"""
_PRODUCT_ORDER = desc("category_pt", "category_en", "photos_qty", "name_length", "description_length", "weight_g",
                      "length_cm", "height_cm", "width_cm")
CTE["p1"] = f"""p1 AS ({dedupe(f"(SELECT * FROM p1_t WHERE coalesce({RULE_PRODUCT}, false))", "product_id", _PRODUCT_ORDER)})"""
CTE["pa"] = f"""pa AS ({dedupe(f"(SELECT * FROM pa_t WHERE coalesce({RULE_PRODUCT}, false))", "product_id", _PRODUCT_ORDER)})"""
CTE["p2"] = f"""p2 AS ({dedupe(f"(SELECT * FROM p2_t WHERE coalesce({RULE_PRODUCT}, false))", "product_id", _PRODUCT_ORDER)})"""

_DIFF = " OR ".join(f"p2.{c} IS DISTINCT FROM p1.{c}" for c in PRODUCT_TRACKED)
CTE["cls"] = f"""cls AS (
  SELECT p2.*, CASE WHEN p1.product_id IS NULL THEN 'new' WHEN {_DIFF} THEN 'changed' ELSE 'unchanged' END AS change
  FROM p2 LEFT JOIN p1 ON p2.product_id = p1.product_id)"""
_ATTRS = ("product_id, category_pt, category_en, weight_g, length_cm, height_cm, width_cm, photos_qty, "
          "name_length, description_length")
_HASH = "sha256(concat_ws('{sep}', {parts}))".format(
    sep=HASH_SEPARATOR,
    parts=", ".join(f"coalesce(CAST({c} AS VARCHAR), '{HASH_NULL_TEXT}')" for c in PRODUCT_TRACKED),
)
CTE["dim"] = f"""dim AS (
  SELECT {_ATTRS}, {_HASH} AS _hash, effective_from, effective_to, is_current FROM (
    SELECT {", ".join("p1." + a.strip() for a in _ATTRS.split(","))}, {INITIAL_TS} AS effective_from,
           CASE WHEN cls.change = 'changed' THEN {CHANGE_TS} END AS effective_to,
           coalesce(cls.change, 'unchanged') <> 'changed' AS is_current
    FROM p1 LEFT JOIN cls ON p1.product_id = cls.product_id
    UNION ALL
    SELECT {_ATTRS}, {CHANGE_TS} AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, true AS is_current
    FROM cls WHERE change IN ('new', 'changed')))"""

CTE["ord_t"] = f"""ord_t AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN o_totalprice >= {td.SMALL_ORDER} THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
         lower(trim(o_orderstatus)) AS order_status,
         o_orderdate AS purchase_ts, o_orderdate + to_days(CASE WHEN o_orderstatus = 'P' THEN -1 ELSE 1 END) AS approved_ts,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 2 DAY END AS delivered_carrier_ts,
         CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + to_days(2 * TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - CASE WHEN o_totalprice > {td.GREAT_ORDER} THEN 20 ELSE 0 END)
              + INTERVAL 10 HOUR END AS delivered_customer_ts,
         o_orderdate + INTERVAL 6 DAY AS estimated_delivery_ts
  FROM orders)"""
CTE["ord_c"] = f"""ord_c AS ({dedupe(f"(SELECT * FROM ord_t WHERE coalesce({RULE_ORDER}, false))", "order_id",
                                    desc("purchase_ts", "customer_id", "order_status", "approved_ts",
                                         "delivered_carrier_ts", "delivered_customer_ts", "estimated_delivery_ts"))})"""

CTE["item_t"] = f"""item_t AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CAST(l_suppkey AS VARCHAR) AS seller_id, l_shipdate AS shipping_limit_ts,
         CAST(CASE WHEN l_returnflag = 'R' AND l_quantity = {td.BAD_QUANTITY} THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(12,2)) AS price, CAST(l_quantity AS DECIMAL(12,2)) AS freight_value
  FROM lineitem)"""
CTE["item_c"] = f"""item_c AS ({dedupe(f"(SELECT * FROM item_t WHERE coalesce({RULE_ORDER_ITEM}, false))",
                                      "order_id, order_item_id",
                                      desc("shipping_limit_ts", "product_id", "seller_id", "price", "freight_value"))})"""

CTE["pay_t"] = f"""pay_t AS (
  SELECT CAST(user_id AS VARCHAR) AS order_id, CAST(event_id AS INTEGER) AS payment_sequential,
         lower(trim(upper(event_type))) AS payment_type, CAST(ceil(value / 50) AS INTEGER) AS payment_installments,
         CAST(CASE WHEN value < {td.SMALL_EVENT} THEN -value ELSE value END AS DECIMAL(12,2)) AS payment_value
  FROM events WHERE event_type = 'purchase')"""
CTE["pay_c"] = f"""pay_c AS ({dedupe(f"(SELECT * FROM pay_t WHERE coalesce({RULE_PAYMENT}, false))",
                                    "order_id, payment_sequential",
                                    desc("payment_type", "payment_installments", "payment_value"))})"""

CTE["rev_t"] = """rev_t AS (
  SELECT CAST(CAST(floor(event_id / 2) AS BIGINT) AS VARCHAR) AS review_id, CAST(user_id AS VARCHAR) AS order_id,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ceil(value / 40) AS INTEGER) END AS review_score,
         event_type AS comment_title,
         CASE WHEN event_type IN ('click', 'view') THEN props END AS comment_message,
         ts AS creation_ts, ts + to_minutes(CAST(floor(value) AS INTEGER)) AS answer_ts
  FROM events WHERE event_type <> 'purchase')"""
CTE["rev_c"] = f"""rev_c AS ({dedupe(f"(SELECT * FROM rev_t WHERE coalesce({RULE_REVIEW}, false))", "review_id, order_id",
                                    desc("creation_ts", "review_score", "comment_title", "comment_message", "answer_ts"))})"""

CTE["oc"] = """oc AS (
  SELECT o.order_id, o.customer_id, o.order_status, o.purchase_ts, o.delivered_customer_ts, o.estimated_delivery_ts,
         c.customer_unique_id
  FROM ord_c o LEFT JOIN cust_c c ON o.customer_id = c.customer_id)"""
CTE["foi"] = f"""foi AS (
  SELECT i.order_id, i.order_item_id, i.product_id, d.effective_from AS product_valid_from, i.seller_id,
         oc.customer_unique_id, {ymd('oc.purchase_ts')} AS purchase_date_key,
         {ymd('oc.delivered_customer_ts')} AS delivered_date_key, {ymd('oc.estimated_delivery_ts')} AS estimated_date_key,
         oc.order_status, i.price, i.freight_value, i.price + i.freight_value AS item_total,
         CAST(date_diff('day', oc.purchase_ts, oc.delivered_customer_ts) AS INTEGER) AS delivery_days,
         CAST(date_diff('day', oc.estimated_delivery_ts, oc.delivered_customer_ts) AS INTEGER) AS delay_days,
         oc.delivered_customer_ts > oc.estimated_delivery_ts AS is_late
  FROM item_c i JOIN oc ON i.order_id = oc.order_id
  LEFT JOIN dim d ON i.product_id = d.product_id AND oc.purchase_ts >= d.effective_from
       AND (d.effective_to IS NULL OR oc.purchase_ts < d.effective_to))"""

CTE["months"] = """months AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, strftime(o_orderdate, '%Y-%m') AS batch_id
  FROM orders WHERE o_orderdate IS NOT NULL)"""

# dependencies between the expressions, in definition order
DEPS = {
    "cust_t": ["places"],
    "cust_c": ["cust_t"],
    "sell_t": ["places"],
    "sell_c": ["sell_t"],
    "geo_c": ["geo_tag"],
    "tr_c": ["tr"],
    "p1_t": ["tr_c"],
    "pa_t": ["tr_c"],
    "pa": ["pa_t"],
    "p2_t": ["tr_c"],
    "p1": ["p1_t"],
    "p2": ["p2_t"],
    "cls": ["p1", "p2"],
    "dim": ["cls"],
    "ord_c": ["ord_t"],
    "item_c": ["item_t"],
    "pay_c": ["pay_t"],
    "rev_c": ["rev_t"],
    "oc": ["ord_c", "cust_c"],
    "foi": ["item_c", "oc", "dim"],
}


def with_(*names: str) -> str:
    needed: list[str] = []

    def visit(n: str) -> None:
        for dep in DEPS.get(n, []):
            visit(dep)
        if n not in needed:
            needed.append(n)

    for n in names:
        visit(n)
    order = list(CTE)
    return "WITH " + ",\n".join(CTE[n] for n in sorted(needed, key=order.index)) + "\n"


def _daily(src: str) -> str:
    return f"""SELECT purchase_date_key, count(DISTINCT order_id) AS orders, count(*) AS items,
  CAST(sum(price) AS DOUBLE) AS gmv, CAST(sum(freight_value) AS DOUBLE) AS freight,
  CAST(sum(delivery_days) AS DOUBLE) / NULLIF(count(delivery_days), 0) AS avg_delivery_days,
  CAST(sum(CAST(is_late AS INTEGER)) AS DOUBLE) / NULLIF(count(is_late), 0) AS late_rate
FROM {src} GROUP BY purchase_date_key"""


def _silver_count(name: str, typed_cte: str, rule: str, keys: str, reason_sql: str | None = None) -> str:
    bad = f"NOT coalesce({rule}, false)" if reason_sql is None else f"{reason_sql} IS NOT NULL"
    good = f"coalesce({rule}, false)" if reason_sql is None else f"{reason_sql} IS NULL"
    return f"""SELECT '{td.FIRST_BATCH}' AS batch_id, 'silver' AS layer, '{name}' AS tbl,
  (SELECT count(*) FROM {typed_cte}) AS rows_in,
  (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {typed_cte} WHERE {good})) AS rows_out,
  (SELECT count(*) FROM {typed_cte} WHERE {bad}) AS rows_quarantined"""


_SILVER_COUNTS = (
    with_("tr", "cust_t", "sell_t", "geo_tag", "pa_t", "ord_t", "item_t", "pay_t", "rev_t")
    + "\nUNION ALL\n".join(
        [
            _silver_count("category_translation", "tr", RULE_CATEGORY, "category_pt"),
            _silver_count("customer", "cust_t", RULE_CUSTOMER, "customer_id"),
            _silver_count("seller", "sell_t", RULE_SELLER, "seller_id"),
            _silver_count("geolocation", "geo_tag", "", "zip_prefix", reason_sql="_reject_reason"),
            _silver_count("product", "pa_t", RULE_PRODUCT, "product_id"),
            _silver_count("order", "ord_t", RULE_ORDER, "order_id"),
            _silver_count("order_item", "item_t", RULE_ORDER_ITEM, "order_id, order_item_id"),
            _silver_count("order_payment", "pay_t", RULE_PAYMENT, "order_id, payment_sequential"),
            _silver_count("order_review", "rev_t", RULE_REVIEW, "review_id, order_id"),
        ]
    )
)



def _coarse(month: str) -> str:
    """The batch of the loaded lake that holds a month."""
    first, second, third = td.COARSE
    return f"CASE WHEN {month} >= '{third}' THEN '{third}' WHEN {month} >= '{second}' THEN '{second}' ELSE '{first}' END"


def _run_log() -> str:
    """What the lake's run log must say: three batches, the first one run
    again after the others (so its facts are all that its customers reach)."""
    first, change = td.COARSE[0], td.CHANGE_BATCH
    rows = {  # silver table: source, rows with their batch, rule, key
        "category_translation": ("category_translation", f"SELECT *, '{first}' AS batch_id FROM tr", RULE_CATEGORY, "category_pt"),
        "customer": ("customers", f"SELECT *, '{first}' AS batch_id FROM cust_t", RULE_CUSTOMER, "customer_id"),
        "seller": ("sellers", f"SELECT *, '{first}' AS batch_id FROM sell_t", RULE_SELLER, "seller_id"),
        "geolocation": ("geolocation", f"SELECT *, '{first}' AS batch_id FROM geo_tag", "_reject_reason IS NULL", "zip_prefix"),
        "product": ("products", f"SELECT *, '{first}' AS batch_id FROM p1_t UNION ALL SELECT *, '{change}' FROM p2_t", RULE_PRODUCT, "product_id"),
        "order": (
            "orders",
            f"SELECT *, {_coarse("strftime(purchase_ts, '%Y-%m')")} AS batch_id FROM ord_t WHERE purchase_ts IS NOT NULL",
            RULE_ORDER,
            "order_id",
        ),
        "order_item": ("order_items", "SELECT * FROM item_t JOIN home USING (order_id)", RULE_ORDER_ITEM, "(order_id, order_item_id)"),
        "order_payment": ("order_payments", "SELECT * FROM pay_t JOIN home USING (order_id)", RULE_PAYMENT, "(order_id, payment_sequential)"),
        "order_review": ("order_reviews", "SELECT * FROM rev_t JOIN home USING (order_id)", RULE_REVIEW, "(review_id, order_id)"),
    }
    parts = []
    for tbl, (source, src, rule, key) in rows.items():
        parts.append(f"SELECT batch_id, 'bronze' AS layer, '{source}' AS tbl, count(*) AS rows_in, count(*) AS rows_out, 0 AS rows_quarantined FROM ({src}) GROUP BY batch_id")
        parts.append(
            f"SELECT batch_id, 'silver', '{tbl}', count(*), count(DISTINCT {key}) FILTER (WHERE {rule}), "
            f"count(*) FILTER (WHERE NOT coalesce({rule}, false)) FROM ({src}) GROUP BY batch_id"
        )
    for fact, silver, dropped in (("fact_order_items", "item_c", "k.order_id IS NULL"), ("fact_payments", "pay_c", "false")):
        src = (
            f"SELECT home.batch_id, {dropped} AS gone FROM {silver} i JOIN home USING (order_id) LEFT JOIN oc k USING (order_id) WHERE home.batch_id <> '{first}' "
            f"UNION ALL SELECT '{first}', {dropped} FROM {silver} i JOIN home USING (order_id) LEFT JOIN oc k USING (order_id) "
            f"WHERE home.batch_id = '{first}' OR k.customer_id IN (SELECT customer_id FROM cust_c)"
        )
        parts.append(f"SELECT batch_id, 'gold', '{fact}', count(*), count(*) FILTER (WHERE NOT gone), count(*) FILTER (WHERE gone) FROM ({src}) GROUP BY batch_id")
    parts.append("SELECT batch_id, 'gold', 'fact_reviews', count(*), count(*), 0 FROM rev_c JOIN home USING (order_id) GROUP BY batch_id")
    for batch, products in ((first, "p1"), (change, "p2")):
        parts.append(f"SELECT '{batch}', 'gold', 'dim_product', count(*), count(*), 0 FROM {products}")
    home = f", home AS (SELECT order_id, {_coarse('max(batch_id)')} AS batch_id FROM months GROUP BY order_id)\n"
    return with_("months", "tr", "sell_t", "geo_tag", "p1", "p2", "rev_c", "pay_c", "item_c", "oc") + home + "\nUNION ALL\n".join(parts)


SQL: dict[str, str] = {
    "bronze_ingest": f"""SELECT CAST(COLUMNS(* EXCLUDE (c_name)) AS VARCHAR), 'say "' || c_name || '", so' AS c_name,
  '{td.FIRST_BATCH}' AS _batch_id, true AS audited FROM customer""",
    "bronze_replace_batch": """SELECT strftime(o_orderdate, '%Y-%m') AS _batch_id, count(*) AS rows
FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1""",
    "conform_category": with_("tr") + "SELECT category_pt, category_en FROM tr",
    "conform_customer": with_("cust_t") + "SELECT * FROM cust_t",
    "conform_seller": with_("sell_t") + "SELECT * FROM sell_t",
    "conform_orders": with_("ord_t") + "SELECT * FROM ord_t",
    "conform_order_items": with_("item_t") + "SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value) FROM item_t",
    "conform_payments": with_("pay_t") + "SELECT * REPLACE (CAST(payment_value AS DOUBLE) AS payment_value) FROM pay_t",
    "conform_reviews": with_("rev_t") + "SELECT * FROM rev_t",
    "rule_clean": "SELECT * FROM customer WHERE coalesce(c_acctbal >= 0, false)",
    "rule_quarantine": "SELECT *, 'c_acctbal >= 0' AS _reject_reason FROM customer WHERE NOT coalesce(c_acctbal >= 0, false)",
    "geo_outliers": with_("geo_tag") + "SELECT zip_prefix, lat, lng, _reject_reason FROM geo_tag WHERE _reject_reason IS NOT NULL",
    "geo_centroid": with_("geo_c") + "SELECT zip_prefix, lat, lng, n_points FROM geo_c",
    "dedupe_latest": with_("item_c") + "SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value) FROM item_c",
    "upsert_orders": """SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice, o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate IS NOT NULL""",
    "product_category_fallback": with_("pa_t") + "SELECT product_id, category_pt, category_en FROM pa_t",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(CAST(d AS DATE) AS TIMESTAMP) AS date,
  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS d
      FROM orders)""",
    "dim_customer": with_("cust_c", "ord_c", "geo_c")
    + """, last_buy AS (SELECT customer_id, max(purchase_ts) AS purchase_ts FROM ord_c GROUP BY customer_id),
latest AS (SELECT * FROM (
  SELECT c.*, row_number() OVER (PARTITION BY c.customer_unique_id ORDER BY l.purchase_ts DESC NULLS LAST,
         c.customer_id DESC NULLS LAST, c.zip_prefix DESC NULLS LAST, c.city DESC NULLS LAST, c.state DESC NULLS LAST) AS rn
  FROM cust_c c LEFT JOIN last_buy l ON c.customer_id = l.customer_id) WHERE rn = 1)
SELECT latest.customer_unique_id, latest.zip_prefix, latest.city, latest.state, g.lat, g.lng
FROM latest LEFT JOIN geo_c g ON latest.zip_prefix = g.zip_prefix""",
    "dim_seller": with_("sell_c", "geo_c")
    + """SELECT s.seller_id, s.zip_prefix, s.city, s.state, g.lat, g.lng
FROM sell_c s LEFT JOIN geo_c g ON s.zip_prefix = g.zip_prefix""",
    "scd2_classify": with_("cls") + "SELECT product_id, change FROM cls",
    "scd2_product": with_("dim") + "SELECT * FROM dim",
    "scd2_history": with_("dim")
    + "SELECT product_id, category_en, weight_g, effective_from, effective_to FROM dim WHERE NOT is_current",
    "asof_product_version": with_("foi") + "SELECT order_id, order_item_id, product_id, product_valid_from FROM foi",
    "asof_sliced": with_("foi") + "SELECT order_id, order_item_id, product_id, product_valid_from FROM foi",
    "scd2_any_order": with_("dim") + "SELECT * FROM dim",
    "fact_order_items": with_("foi") + "SELECT * REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value, CAST(item_total AS DOUBLE) AS item_total) FROM foi",
    "orphan_items": with_("item_c", "ord_c")
    + """SELECT i.order_id, i.order_item_id, i.product_id FROM item_c i
WHERE NOT EXISTS (SELECT 1 FROM ord_c o WHERE o.order_id = i.order_id)""",
    "fact_payments": with_("pay_c", "oc")
    + f"""SELECT p.order_id, p.payment_sequential, oc.customer_unique_id, {ymd('oc.purchase_ts')} AS purchase_date_key,
  p.payment_type, p.payment_installments, CAST(p.payment_value AS DOUBLE) AS payment_value
FROM pay_c p LEFT JOIN oc ON p.order_id = oc.order_id""",
    "fact_reviews": with_("rev_c")
    + f"""SELECT review_id, order_id, review_score, {ymd('creation_ts')} AS review_creation_date_key,
  (floor(epoch(answer_ts)) - floor(epoch(creation_ts))) / 3600 AS response_hours,
  comment_message IS NOT NULL AS has_comment
FROM rev_c""",
    "agg_daily_sales": with_("foi") + _daily("foi"),
    "agg_customer_ltv": with_("foi")
    + """SELECT customer_unique_id, count(DISTINCT order_id) AS orders, count(*) AS items,
  CAST(sum(item_total) AS DOUBLE) AS total_spent, min(purchase_date_key) AS first_purchase_date_key,
  max(purchase_date_key) AS last_purchase_date_key,
  CAST((CAST(sum(item_total) * 100 AS HUGEINT) * 20000 + count(DISTINCT order_id)) // (2 * count(DISTINCT order_id))
       AS DOUBLE) / 1000000 AS avg_order_value
FROM foi GROUP BY customer_unique_id""",
    "incremental_aggregates": with_("foi") + _daily("foi"),
    "incremental_dim_customer": None,  # filled below: equals the full dimension
    "quarantine_raw": f"""WITH raw AS (
  SELECT CAST(CAST(floor(event_id / 2) AS BIGINT) AS VARCHAR) AS review_id, CAST(user_id AS VARCHAR) AS order_id,
         CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(CAST(ceil(value / 40) AS BIGINT) AS VARCHAR) END AS review_score,
         event_type AS review_comment_title,
         CASE WHEN event_type IN ('click', 'view') THEN props END AS review_comment_message,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS review_creation_date,
         strftime(ts + to_minutes(CAST(floor(value) AS INTEGER)), '%Y-%m-%d %H:%M:%S.%f') AS review_answer_timestamp,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ceil(value / 40) AS INTEGER) END AS score
  FROM events WHERE event_type <> 'purchase')
SELECT review_id, order_id, '{RULE_REVIEW}' AS _reject_reason,
       to_json({{'review_id': review_id, 'order_id': order_id, 'review_score': review_score,
                'review_comment_title': review_comment_title, 'review_comment_message': review_comment_message,
                'review_creation_date': review_creation_date, 'review_answer_timestamp': review_answer_timestamp}}) AS _raw
FROM raw WHERE NOT coalesce(review_id IS NOT NULL AND order_id IS NOT NULL AND score BETWEEN 1 AND 5, false)""",
    "quarantine_replay": """WITH raw AS (
  SELECT CAST(CAST(floor(event_id / 2) AS BIGINT) AS VARCHAR) AS review_id, CAST(user_id AS VARCHAR) AS order_id,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(ceil(value / 40) AS INTEGER) END AS review_score,
         event_type AS comment_title, ts AS creation_ts
  FROM events WHERE event_type <> 'purchase')
SELECT review_id, order_id, review_score, comment_title, creation_ts,
       CASE WHEN review_id IS NULL OR order_id IS NULL OR review_score NOT BETWEEN 1 AND 5 THEN 'score out of range' END AS _reject_reason
FROM raw WHERE review_id IS NULL OR order_id IS NULL OR review_score IS NULL OR review_score NOT BETWEEN 1 AND 5""",
    "revenue_by_category": with_("foi")
    + """SELECT d.category_en, CAST(round(sum(f.price), 2) AS DOUBLE) AS revenue
FROM foi f JOIN dim d ON f.product_id = d.product_id AND f.product_valid_from = d.effective_from
GROUP BY d.category_en ORDER BY revenue DESC, d.category_en LIMIT 10""",
    "multi_version_products": with_("dim")
    + """SELECT product_id, category_en, weight_g, effective_from, effective_to, is_current FROM dim
WHERE product_id IN (SELECT product_id FROM dim GROUP BY 1 HAVING count(*) > 1)
ORDER BY product_id, effective_from LIMIT 20""",
    "batch_health": _run_log(),
    "dq_log": _SILVER_COUNTS,
    "split_orders_by_month": with_("months") + "SELECT order_id, batch_id FROM months",
    "orders_per_month": with_("months") + "SELECT batch_id, count(*) AS orders FROM months GROUP BY batch_id",
    "route_children": with_("months")
    + """, c AS (
  SELECT 'order_items' AS source, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS id FROM lineitem
  UNION ALL SELECT 'order_payments', CAST(user_id AS VARCHAR), CAST(event_id AS VARCHAR) FROM events WHERE event_type = 'purchase'
  UNION ALL SELECT 'order_reviews', CAST(user_id AS VARCHAR), CAST(CAST(floor(event_id / 2) AS BIGINT) AS VARCHAR) FROM events WHERE event_type <> 'purchase')
SELECT c.*, m.batch_id FROM c JOIN (SELECT order_id, max(batch_id) AS batch_id FROM months GROUP BY order_id) m USING (order_id)""",
    "assign_reference_batch": with_("months", "tr", "sell_t")
    + f""", r AS (
  SELECT 'customers' AS source, CAST(c_custkey AS VARCHAR) AS id FROM customer
  UNION ALL SELECT 'sellers', seller_id FROM sell_t
  UNION ALL SELECT 'products', CAST(p_partkey AS VARCHAR) FROM part
  UNION ALL SELECT 'geolocation', CASE WHEN NOT (event_type = 'error' AND value < {td.SMALL_EVENT}) THEN CAST(user_id AS VARCHAR) END FROM events
  UNION ALL SELECT 'category_translation', category_pt FROM tr)
SELECT r.*, (SELECT min(batch_id) FROM months) AS batch_id FROM r""",
    "surrogate_keys": with_("foi", "cust_c", "sell_c")
    + """SELECT 'product' AS kind, d.product_id AS id, d.effective_from, CAST(1 AS BIGINT) AS sharing, false AS missing_key, count(f.order_id) AS fact_rows
FROM dim d LEFT JOIN foi f ON d.product_id = f.product_id AND d.effective_from = f.product_valid_from GROUP BY ALL
UNION ALL SELECT 'customer', c.customer_unique_id, NULL, 1, false, count(f.order_id)
FROM (SELECT DISTINCT customer_unique_id FROM cust_c) c LEFT JOIN foi f USING (customer_unique_id) GROUP BY ALL
UNION ALL SELECT 'seller', s.seller_id, NULL, 1, false, count(f.order_id) FROM sell_c s LEFT JOIN foi f USING (seller_id) GROUP BY ALL""",
    "date_key": with_("ord_c")
    + f"""SELECT order_id, {ymd('purchase_ts')} AS purchase_date_key, {ymd('delivered_customer_ts')} AS delivered_date_key
FROM ord_c""",
    "change_hash": with_("pa") + f"SELECT product_id, {_HASH} AS _hash FROM pa",
    "unknown_member": with_("dim")
    + """SELECT product_id, category_en, effective_from, is_current FROM dim
UNION ALL SELECT '<unknown>', 'unknown', CAST(NULL AS TIMESTAMP), true""",
    "soft_checks": with_("item_c", "ord_c")
    + """, j AS (SELECT i.shipping_limit_ts, o.purchase_ts, o.approved_ts, o.delivered_customer_ts
          FROM item_c i JOIN ord_c o ON i.order_id = o.order_id)
SELECT 'delivered before purchase' AS soft_check, CAST(count_if(coalesce(delivered_customer_ts < purchase_ts, false)) AS BIGINT) AS rows_flagged,
       count(*) AS rows_checked FROM j
UNION ALL SELECT 'approved before purchase', CAST(count_if(coalesce(approved_ts < purchase_ts, false)) AS BIGINT), count(*) FROM j
UNION ALL SELECT 'shipping limit before purchase', CAST(count_if(coalesce(shipping_limit_ts < purchase_ts, false)) AS BIGINT), count(*) FROM j""",
}


SQL["incremental_dim_customer"] = SQL["dim_customer"]
# The batch path must end where the one-shot computation does.
for _lake, _whole in {
    "fact_order_items": "fact_order_items",
    "fact_payments": "fact_payments",
    "fact_reviews": "fact_reviews",
    "dim_product": "scd2_product",
    "dim_customer": "dim_customer",
    "dim_seller": "dim_seller",
    "agg_daily_sales": "agg_daily_sales",
    "agg_customer_ltv": "agg_customer_ltv",
}.items():
    SQL[f"lake_{_lake}"] = SQL[_whole]


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
