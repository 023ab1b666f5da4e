"""DuckDB SQL giving the same result as the query of the same name."""

from __future__ import annotations

NULL_PART = "_dbt_utils_surrogate_key_null_"

# --- shared relations ------------------------------------------------------------------

_SWITCH = "CAST(DATE '1998-01-01' + CAST({key} % 4 * 100 AS INTEGER) AS TIMESTAMP)"
_PART_SWITCH = _SWITCH.format(key="p_partkey")
_CUST_SWITCH = _SWITCH.format(key="c_custkey")

PRODUCTS = f"""
    SELECT md5(CAST(p_partkey AS VARCHAR) || '-' || CAST(v.vf AS VARCHAR)) AS product_key,
           p_partkey AS product_id, p_name AS product_name, p_type AS category,
           CASE WHEN v.n = 1 THEN p_retailprice ELSE p_retailprice * CAST(1.1 AS DOUBLE) END AS price,
           p_brand AS description, 'img/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS image_url,
           p_size / CAST(10 AS DOUBLE) AS rating_score, p_size AS rating_count,
           v.vf AS effective_from, v.vt AS effective_to,
           v.vf AS loaded_at, CAST(v.vf AS DATE) AS load_date
    FROM part CROSS JOIN LATERAL (
        SELECT 1 AS n, TIMESTAMP '1996-01-01' AS vf, {_PART_SWITCH} AS vt
        UNION ALL SELECT 2, {_PART_SWITCH}, CAST(NULL AS TIMESTAMP)) v"""

CUSTOMERS = f"""
    SELECT md5(CAST(c_custkey AS VARCHAR) || '-' || CAST(v.vf AS VARCHAR)) AS customer_key,
           c_custkey AS user_id,
           CASE WHEN c_custkey % 5 <> 0 THEN split_part(c_name, '#', 1) END AS first_name,
           split_part(c_name, '#', 2) AS last_name,
           CASE WHEN c_custkey % 5 <> 0
                THEN split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) END AS full_name,
           c_name || '@v' || CAST(v.n AS VARCHAR) AS email, c_name AS username,
           CAST(c_nationkey AS VARCHAR) AS city, c_mktsegment AS street, '0000' AS zipcode,
           CAST(NULL AS VARCHAR) AS phone,
           v.vf AS effective_from, v.vt AS effective_to,
           v.vf AS loaded_at, CAST(v.vf AS DATE) AS load_date
    FROM customer CROSS JOIN LATERAL (
        SELECT 1 AS n, TIMESTAMP '1996-01-01' AS vf, {_CUST_SWITCH} AS vt
        UNION ALL SELECT 2, {_CUST_SWITCH}, CAST(NULL AS TIMESTAMP)) v"""

ITEMS = """
    SELECT l_orderkey * 10 + l_linenumber AS order_item_id, l_orderkey AS order_id,
           o_custkey AS user_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
           l_extendedprice AS unit_price, l_quantity * l_extendedprice AS total_price,
           o_orderdate AS order_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

SPINE = """
    SELECT CAST(DATE '1995-01-01' + CAST(i AS INTEGER) AS DATE) AS full_date
    FROM range(0, 2000) AS r(i)"""

DATE_KEY = "CAST(strftime({day}, '%Y%m%d') AS INTEGER)"

CART_ITEMS = """
    SELECT o_orderkey, o_custkey, o_orderdate, o_custkey + s.i AS product_id,
           CAST((o_orderkey + s.i) % 5 + 1 AS INTEGER) AS quantity
    FROM orders JOIN (VALUES (0), (1), (2)) AS s(i) ON s.i < o_orderkey % 4
    WHERE o_orderkey % 11 <> 10"""

CART_RUNS = """(VALUES ('run-1', TIMESTAMP '2024-01-01 06:00:00', DATE '2024-01-01'),
            ('run-2', TIMESTAMP '2024-01-03 06:00:00', DATE '2024-01-03')) AS r(run_id, loaded_at, load_date)"""

LANDED = "strftime(o_orderdate, 'raw/orders/year=%Y/month=%m/day=%d')"


def _valid(at: str, version: str) -> str:
    return (
        f"{at} >= {version}.effective_from "
        f"AND ({version}.effective_to IS NULL OR {at} < {version}.effective_to)"
    )


_ASOF_PRODUCT = f"""
    SELECT i.order_item_id, i.order_id, i.user_id, i.product_id, i.quantity, i.order_date,
           p.product_key, p.price AS price_then, p.effective_from AS version_from
    FROM ({ITEMS}) i LEFT JOIN ({PRODUCTS}) p
      ON i.product_id = p.product_id AND {_valid('i.order_date', 'p')}"""


def _history(run_of_order: str, runs: tuple[str, ...], hard_deletes: bool) -> str:
    """Gaps and islands over one row per customer and run."""
    listed = ", ".join(f"({n}, TIMESTAMP '{ts}')" for n, ts in enumerate(runs, start=1))
    gap = "OR prev_n <> n - 1" if hard_deletes else ""
    if hard_deletes:
        closing = "(SELECT r.ts FROM runs r WHERE r.n = v.last_n + 1)"
    else:
        closing = "lead(v.ts) OVER (PARTITION BY v.customer_id ORDER BY v.n)"
    return f"""
WITH runs(n, ts) AS (VALUES {listed}),
ranked AS (
    SELECT o_custkey AS customer_id, nullif(o_orderstatus, 'P') AS status,
           o_totalprice > 250000 AS large, o_orderkey AS last_order, r.n, r.ts,
           row_number() OVER (PARTITION BY o_custkey, r.n
                              ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS pos
    FROM orders JOIN runs r ON r.n = {run_of_order}),
log AS (
    SELECT *, lag(n) OVER w AS prev_n, lag(status) OVER w AS prev_status,
           lag(large) OVER w AS prev_large
    FROM ranked WHERE pos = 1 WINDOW w AS (PARTITION BY customer_id ORDER BY n)),
flagged AS (
    SELECT *, (prev_n IS NULL {gap} OR status IS DISTINCT FROM prev_status
               OR large IS DISTINCT FROM prev_large) AS starts FROM log),
islands AS (
    SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END)
              OVER (PARTITION BY customer_id ORDER BY n) AS island FROM flagged),
v AS (
    SELECT * FROM (SELECT *, max(n) OVER (PARTITION BY customer_id, island) AS last_n FROM islands)
    WHERE starts)
SELECT v.customer_id, v.status, v.large, v.last_order,
       md5(CAST(v.customer_id AS VARCHAR) || '|' || CAST(v.ts AS VARCHAR)) AS scd_id,
       v.ts AS updated_at, v.ts AS valid_from, {closing} AS valid_to
FROM v"""


_ONE = "1"
_HALF = "CASE WHEN o_orderdate < TIMESTAMP '1998-05-01' THEN 1 ELSE 2 END"
_THIRD = (
    "CASE WHEN o_orderdate < TIMESTAMP '1997-03-15' THEN 1 "
    "WHEN o_orderdate < TIMESTAMP '1999-05-20' THEN 2 ELSE 3 END"
)
_YEAR = "year(o_orderdate) - 1994"
_YEAR_ENDS = tuple(f"{year}-01-01" for year in range(1996, 2003))


def _check(name: str, failing: str) -> str:
    return f"SELECT '{name}' AS check_name, CAST(({failing}) AS BIGINT) AS failing"


def _overlaps(source: str) -> str:
    return (
        f"SELECT count(*) FROM (SELECT effective_to AS t, lead(effective_from) OVER "
        f"(PARTITION BY product_id ORDER BY effective_from, effective_to NULLS LAST) AS nf "
        f"FROM ({source})) WHERE nf IS NOT NULL AND (t IS NULL OR nf < t)"
    )


_LATE_PRODUCTS = f"""
    SELECT product_id, effective_from,
           effective_to + CASE WHEN product_id % 5 = 0 THEN INTERVAL 10 DAY ELSE INTERVAL 0 DAY END
               AS effective_to
    FROM ({PRODUCTS})"""

_NEWEST_EVENT = "ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS LAST"
_EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"


def _newest_per(keys: str) -> str:
    return f"""
SELECT {_EVENT_COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY {keys} {_NEWEST_EVENT}) AS pos FROM events)
WHERE pos = 1"""


_CHAIN_VERSIONS = """(VALUES
    (0, TIMESTAMP '1996-01-01', TIMESTAMP '1998-01-01', TIMESTAMP '2024-01-01 06:00:00', DATE '2024-01-01'),
    (1, TIMESTAMP '1998-01-01', CAST(NULL AS TIMESTAMP), TIMESTAMP '2024-01-02 06:00:00', DATE '2024-01-02')
    ) AS v(step, vf, vt, loaded_at, load_date)"""

CHAIN_PRODUCTS = f"""
    SELECT md5(CAST(p_partkey AS VARCHAR) || '-' || CAST(v.vf AS VARCHAR)) AS product_key,
           p_partkey AS product_id, p_name AS product_name, p_type AS category,
           p_retailprice + v.step * 10 AS price, p_brand AS description,
           'img/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS image_url,
           p_size / CAST(10 AS DOUBLE) AS rating_score, p_size AS rating_count,
           v.vf AS effective_from, v.vt AS effective_to, v.loaded_at, v.load_date
    FROM part CROSS JOIN {_CHAIN_VERSIONS}"""

CHAIN_CUSTOMERS = f"""
    SELECT md5(CAST(c_custkey AS VARCHAR) || '-' || CAST(v.vf AS VARCHAR)) AS customer_key,
           c_custkey AS user_id, split_part(c_name, '#', 1) AS first_name,
           split_part(c_name, '#', 2) AS last_name,
           split_part(c_name, '#', 1) || ' ' || split_part(c_name, '#', 2) AS full_name,
           c_name || '@mail.test' AS email, c_name AS username, n_name AS city,
           c_mktsegment || ' street' AS street,
           lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS zipcode,
           '555-' || CAST(c_custkey AS VARCHAR) || '-' || CAST(v.step AS VARCHAR) AS phone,
           v.vf AS effective_from, v.vt AS effective_to, v.loaded_at, v.load_date
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey CROSS JOIN {_CHAIN_VERSIONS}"""


def _fact(products: str, customers: str) -> str:
    return f"""
WITH p AS ({products}), c AS ({customers}), d AS ({SPINE}),
cart AS (SELECT k.*, r.loaded_at FROM ({CART_ITEMS}) k CROSS JOIN {CART_RUNS})
SELECT md5(CAST(k.o_orderkey AS VARCHAR) || '-' || CAST(k.product_id AS VARCHAR)) AS order_item_key,
       k.o_orderkey AS order_id, c.customer_key, p.product_key,
       {DATE_KEY.format(day='d.full_date')} AS date_key, k.product_id, k.o_custkey AS user_id,
       k.quantity, p.price AS unit_price, k.quantity * p.price AS total_price,
       k.o_orderdate AS order_date, k.loaded_at, CAST(NULL AS VARCHAR) AS run_id
FROM cart k
LEFT JOIN p ON k.product_id = p.product_id AND {_valid('k.o_orderdate', 'p')}
LEFT JOIN c ON k.o_custkey = c.user_id AND {_valid('k.o_orderdate', 'c')}
LEFT JOIN d ON CAST(k.o_orderdate AS DATE) = d.full_date
UNION ALL
SELECT md5(CAST(i.order_item_id AS VARCHAR)), i.order_id, c.customer_key, p.product_key,
       {DATE_KEY.format(day='d.full_date')}, i.product_id, i.user_id, i.quantity, i.unit_price,
       i.total_price, i.order_date, CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR)
FROM ({ITEMS}) i
LEFT JOIN p ON i.product_id = p.product_id AND {_valid('i.order_date', 'p')}
LEFT JOIN c ON i.user_id = c.user_id AND {_valid('i.order_date', 'c')}
LEFT JOIN d ON CAST(i.order_date AS DATE) = d.full_date"""


# --- one statement per query -----------------------------------------------------------

ORACLES: dict[str, str] = {
    "enrich_customer": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       TIMESTAMP '2024-03-01 06:30:15' AS _loaded_at, 'order-tables' AS _source,
       'users' AS _entity, DATE '2024-03-01' AS _load_date, 'run-7' AS _run_id
FROM customer""",
    "bronze_events": """
SELECT event_id AS id, value AS v, event_type AS kind, ts AS at, CAST(ts AS DATE) AS day,
       user_id AS user
FROM events WHERE event_id % 7 <> 0""",
    "bronze_rejects": """
SELECT event_id, 'raw/events/' || event_type || '.json' AS _file
FROM events WHERE event_id % 7 = 0""",
    "load_summary": """
SELECT 'raw/events/' || event_type || '.json' AS _file, count(*) AS parsed,
       count(*) FILTER (WHERE event_id % 7 <> 0) AS loaded,
       count(*) FILTER (WHERE event_id % 7 = 0) AS rejected
FROM events GROUP BY event_type""",
    "path_extract_cast": """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "partition_columns": """
SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
       strftime(o_orderdate, '%d') AS day
FROM orders""",
    "path_suffix": f"""
SELECT o_orderkey, replace({LANDED}, 'raw/orders/', '') AS suffix FROM orders""",
    "new_files_anti": f"""
SELECT DISTINCT n.path FROM (SELECT {LANDED} AS path FROM orders) n
WHERE NOT EXISTS (
    SELECT 1 FROM (SELECT {LANDED} AS path FROM orders
                   WHERE o_orderdate < TIMESTAMP '2000-01-01') s
    WHERE s.path = n.path)""",
    "json_array_scan": """
SELECT o_orderkey::BIGINT AS o_orderkey, o_custkey::BIGINT AS o_custkey, o_orderstatus, o_totalprice::DOUBLE AS o_totalprice,
       '}"],' || chr(10) || '{ "' || o_orderstatus AS note
FROM orders""",
    "line_totals_rounded": """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(round(CAST(l_quantity AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2)), 2)
            AS DECIMAL(18,2)) AS line_total
FROM lineitem""",
    "dedup_latest": _newest_per("user_id"),
    "dedup_per_run": _newest_per("user_id, event_type"),
    "dedup_incremental": _newest_per("user_id"),
    "stg_products": """
SELECT p_partkey AS product_id, p_name AS product_name, p_retailprice + 10 AS price,
       p_brand AS description, p_type AS category,
       'img/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS image_url,
       p_size / CAST(10 AS DOUBLE) AS rating_score, p_size AS rating_count,
       TIMESTAMP '2024-01-02 06:00:00' AS loaded_at, 'order-tables' AS source_system,
       DATE '2024-01-02' AS load_date, 'run-2' AS run_id
FROM part""",
    "stg_users": """
SELECT c_custkey AS user_id, c_name || '@mail.test' AS email, c_name AS username,
       split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
       n_name AS city, c_mktsegment || ' street' AS street,
       lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS zipcode,
       c_acctbal AS latitude, -c_acctbal AS longitude,
       '555-' || CAST(c_custkey AS VARCHAR) || '-1' AS phone,
       TIMESTAMP '2024-01-02 06:00:00' AS loaded_at, 'order-tables' AS source_system,
       DATE '2024-01-02' AS load_date, 'run-2' AS run_id
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "cart_items_explode": f"""
SELECT o_orderkey, product_id, quantity FROM ({CART_ITEMS})""",
    "stg_carts": f"""
SELECT c.o_orderkey AS cart_id, c.o_custkey AS user_id, c.o_orderdate AS cart_date,
       c.product_id, c.quantity, r.loaded_at, 'order-tables' AS source_system, r.load_date, r.run_id
FROM ({CART_ITEMS}) c CROSS JOIN {CART_RUNS}""",
    "scd2_initial": _history(_ONE, ("2002-01-01",), True),
    "scd2_two_batches": _history(_HALF, ("1998-05-01", "2002-01-01"), False),
    "scd2_hard_deletes": _history(_HALF, ("1998-05-01", "2002-01-01"), True),
    "scd2_reappear": _history(_THIRD, ("1997-03-15", "1999-05-20", "2002-01-01"), True),
    "scd2_history": _history(_YEAR, _YEAR_ENDS, True),
    "scd2_history_keep": _history(_YEAR, _YEAR_ENDS, False),
    "dim_product": PRODUCTS,
    "dim_customer": CUSTOMERS,
    "dim_current": f"SELECT * FROM ({PRODUCTS}) WHERE effective_to IS NULL",
    "dim_as_of": f"""
SELECT * FROM ({PRODUCTS}) p WHERE {_valid("TIMESTAMP '1998-06-01'", 'p')}""",
    "dim_date": f"""
SELECT o.o_orderkey, {DATE_KEY.format(day='d.full_date')} AS date_key, d.full_date,
       CAST(dayofweek(d.full_date) AS INTEGER) AS day_of_week,
       strftime(d.full_date, '%a') AS day_name, CAST(month(d.full_date) AS INTEGER) AS month,
       strftime(d.full_date, '%b') AS month_name, CAST(quarter(d.full_date) AS INTEGER) AS quarter,
       CAST(year(d.full_date) AS INTEGER) AS year,
       dayofweek(d.full_date) IN (0, 6) AS is_weekend
FROM orders o LEFT JOIN ({SPINE}) d ON CAST(o.o_orderdate AS DATE) = d.full_date""",
    "surrogate_keys": f"""
SELECT o_orderkey,
       md5(coalesce(CAST(o_orderkey AS VARCHAR), '{NULL_PART}') || '-' ||
           coalesce(nullif(o_orderstatus, 'P'), '{NULL_PART}') || '-' ||
           coalesce(CAST(o_orderdate AS VARCHAR), '{NULL_PART}')) AS order_sk
FROM orders""",
    "asof_product": _ASOF_PRODUCT,
    "asof_product_hot": _ASOF_PRODUCT,
    "asof_product_bucketed": _ASOF_PRODUCT,
    "asof_customer": f"""
SELECT i.order_item_id, i.order_id, i.user_id, i.product_id, i.quantity, i.order_date,
       c.customer_key, c.email
FROM ({ITEMS}) i LEFT JOIN ({CUSTOMERS}) c
  ON i.user_id = c.user_id AND {_valid('i.order_date', 'c')}""",
    "price_at_order": f"""
SELECT md5(CAST(a.order_item_id AS VARCHAR)) AS order_item_key, a.order_id, a.product_id,
       a.order_date, a.price_then AS unit_price
FROM ({_ASOF_PRODUCT}) a""",
    "date_key_join": f"""
SELECT o.o_orderkey, o.o_orderdate, {DATE_KEY.format(day='d.full_date')} AS date_key
FROM orders o LEFT JOIN ({SPINE}) d ON CAST(o.o_orderdate AS DATE) = d.full_date""",
    "fact_order_items": _fact(PRODUCTS, CUSTOMERS),
    "chain_products": CHAIN_PRODUCTS,
    "chain_customers": CHAIN_CUSTOMERS,
    "chain_fact": _fact(CHAIN_PRODUCTS, CHAIN_CUSTOMERS),
    "entity_counts": """
SELECT 'products' AS entity, count(*) AS records FROM part
UNION ALL SELECT 'users', count(*) FROM customer
UNION ALL SELECT 'carts', count(*) FROM orders
UNION ALL SELECT 'total', (SELECT count(*) FROM part) + (SELECT count(*) FROM customer)
                          + (SELECT count(*) FROM orders)""",
    "seed_summary": """
SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_amount,
       count(DISTINCT o_custkey) AS distinct_count,
       arg_min(o_orderdate, o_orderkey) AS first_date, arg_max(o_orderdate, o_orderkey) AS last_date
FROM orders""",
    "units_by_category_month": f"""
SELECT p.p_type AS category, strftime(a.order_date, '%Y-%m') AS month,
       CAST(sum(CAST(a.quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS units
FROM ({_ASOF_PRODUCT}) a JOIN part p ON a.product_id = p.p_partkey
WHERE a.product_key IS NOT NULL
GROUP BY p.p_type, strftime(a.order_date, '%Y-%m')""",
    "first_n_items": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100",
    "month_weight_lookup": """
SELECT o_orderkey, CAST(coalesce(w.weight, 1.0) AS DOUBLE) AS weight
FROM orders LEFT JOIN (VALUES (1, 1.4), (2, 0.8), (3, 0.9), (4, 0.9), (5, 1.0), (6, 1.0), (7, 1.1),
                              (8, 1.1), (9, 1.0), (10, 1.2), (11, 1.5), (12, 2.0)) AS w(m, weight)
  ON month(o_orderdate) = w.m""",
    "month_weighted_sample": """
SELECT o_orderkey, o_orderdate
FROM orders JOIN (VALUES (1, 1.4), (2, 0.8), (3, 0.9), (4, 0.9), (5, 1.0), (6, 1.0), (7, 1.1),
                         (8, 1.1), (9, 1.0), (10, 1.2), (11, 1.5), (12, 2.0)) AS w(m, weight)
  ON month(o_orderdate) = w.m
WHERE CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT)
          / CAST(4294967296 AS DOUBLE) > CAST(1 AS DOUBLE) / CAST(w.weight AS DOUBLE)""",
    "dq_not_null": " UNION ALL ".join(
        _check(f"items.{c} not_null", f"SELECT count(*) FROM ({_ASOF_PRODUCT}) WHERE {c} IS NULL")
        for c in ("order_id", "product_id", "product_key", "price_then")
    ),
    "dq_unique": _check(
        "lineitem unique",
        "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber "
        "HAVING count(*) > 1)",
    )
    + " UNION ALL "
    + _check(
        "orders unique",
        "SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)",
    ),
    "dq_foreign_key": _check(
        "lineitem has order",
        "SELECT count(*) FROM lineitem WHERE NOT EXISTS "
        "(SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)",
    )
    + " UNION ALL "
    + _check(
        "order has lineitem",
        "SELECT count(*) FROM orders WHERE NOT EXISTS "
        "(SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
    ),
    "dq_accepted_values": _check(
        "orderstatus accepted",
        "SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
    ),
    "dq_no_overlap": _check("products no overlap", _overlaps(PRODUCTS))
    + " UNION ALL "
    + _check("late products no overlap", _overlaps(_LATE_PRODUCTS)),
    "dq_fields": _check(
        "events.k present",
        "SELECT count(*) FROM events WHERE json_extract_string(props, '$.k') IS NULL",
    )
    + " UNION ALL "
    + _check(
        "events.z present",
        "SELECT count(*) FROM events WHERE json_extract_string(props, '$.z') IS NULL",
    ),
}
