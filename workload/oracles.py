"""SQL counterparts of the registered queries, written for DuckDB over the supplied tables."""

from __future__ import annotations

# The views of ``tables.py``, as common table expressions.
VIEWS = {
    "sales": """SELECT l_suppkey AS customer_id, CAST(l_shipdate AS DATE) AS order_date,
        l_partkey AS product_id FROM lineitem""",
    "order_sales": """SELECT l_orderkey AS customer_id, CAST(l_shipdate AS DATE) AS order_date,
        l_partkey AS product_id FROM lineitem""",
    "menu": """SELECT p_partkey AS product_id, p_type AS product_name,
        CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part""",
    "members": """SELECT s_suppkey AS customer_id,
        CAST(DATE '1994-12-01' + CAST(s_suppkey * 37 % 1400 AS INTEGER) AS DATE) AS join_date
        FROM supplier WHERE s_acctbal > 0""",
    "employees": """SELECT s_suppkey AS employee_number, s_name AS first_name, n_name AS last_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "details": """SELECT l_orderkey AS order_number, l_partkey AS product_code,
        CAST(l_quantity AS INTEGER) AS quantity,
        CAST(l_extendedprice AS DECIMAL(12,2)) AS price_each FROM lineitem""",
    "revenue_orders": """SELECT o_orderkey AS order_id, o_custkey AS order_customer_id,
        CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS order_date,
        lower(o_orderstatus) AS order_status FROM orders""",
    "staff": """SELECT o_orderkey AS emp, o_orderpriority AS dept,
        CAST(o_totalprice AS DECIMAL(12,2)) AS salary FROM orders""",
    "first_raw": """SELECT
        CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' THEN 'x'
             ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
        CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O'
             THEN strftime(o_orderdate, '%Y-%m-%d')
             ELSE strftime(o_orderdate, '%d-%m-%Y') END AS order_date,
        CAST(o_custkey AS VARCHAR) AS order_customer_id,
        o_orderstatus AS order_status,
        CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN NULL
             WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P'
             THEN '-' || CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR)
             ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS amount
        FROM orders""",
    "raw_orders": """SELECT * FROM first_raw UNION ALL
        SELECT order_id, order_date, order_customer_id, ' ' || lower(order_status) || ' ', amount
        FROM first_raw WHERE order_status = 'F'""",
    "typed_orders": """SELECT TRY_CAST(order_id AS INTEGER) AS order_id,
        TRY_CAST(order_customer_id AS INTEGER) AS order_customer_id,
        TRY_CAST(amount AS DOUBLE) AS "sum",
        CAST(try_strptime(order_date, '%d-%m-%Y') AS DATE) AS order_date,
        lower(trim(order_status)) AS order_status FROM raw_orders""",
    "unique_orders": "SELECT DISTINCT * FROM typed_orders",
    "complete_orders": """SELECT * FROM unique_orders WHERE order_id IS NOT NULL
        AND order_customer_id IS NOT NULL AND "sum" IS NOT NULL AND order_date IS NOT NULL
        AND order_status IS NOT NULL""",
    "valid_orders": """SELECT * FROM complete_orders
        WHERE order_id > 0 AND order_customer_id > 0 AND "sum" >= 0""",
    "videos": """SELECT event_id AS video_id, user_id AS channel_title, event_type AS country,
        CAST(event_id % 7 AS INTEGER) AS category_id, CAST(floor(value) AS BIGINT) AS views,
        event_id % 101 AS likes, event_id % 13 AS dislikes, event_id % 29 AS comment_count,
        CAST(CAST(ts AS DATE) + to_months(CAST(event_id % 12 AS INTEGER)) AS DATE)
            AS trending_date,
        ts AS publish_ts FROM events""",
    "first_crawl": """SELECT event_type, CAST(event_id AS VARCHAR) AS video_id,
        CAST(user_id AS VARCHAR) AS channel_title,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS publish_time,
        strftime(ts, '%y.%d.%m') AS trending_date,
        CAST(event_id % 7 AS VARCHAR) AS category_id,
        CASE WHEN floor(value) < 5 THEN 'n/a'
             ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS views,
        CAST(event_id % 101 AS VARCHAR) AS likes,
        CASE WHEN floor(value) > 200 THEN NULL
             ELSE CAST(event_id % 13 AS VARCHAR) END AS dislikes,
        CAST(event_id % 29 AS VARCHAR) AS comment_count,
        CASE WHEN event_type = 'click' THEN 'true' ELSE 'false' END AS comments_disabled,
        CASE WHEN event_type = 'error' AND floor(value) < 20 THEN 'unknown' ELSE 'False' END
            AS ratings_disabled,
        CASE WHEN event_type = 'error' THEN 'TRUE' ELSE 'FALSE' END AS video_error_or_removed
        FROM events""",
    "raw_videos": """SELECT * FROM first_crawl UNION ALL
        SELECT * REPLACE ('2024-03-01T' || substr(publish_time, 12, 20) AS publish_time,
                          '1000' AS views)
        FROM first_crawl WHERE event_type = 'purchase'""",
    "old_feed": """SELECT o_custkey AS customer_id, o_orderpriority AS priority,
        arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order,
        arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status,
        arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS total
        FROM orders WHERE o_orderdate < TIMESTAMP '1998-04-01' GROUP BY 1, 2""",
    "new_feed": """SELECT o_custkey AS customer_id, o_orderpriority AS priority,
        arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS last_order,
        nullif(arg_max(o_orderstatus, (o_orderdate, o_orderkey)), 'P') AS status,
        arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS total
        FROM orders WHERE o_orderdate >= TIMESTAMP '1998-04-01' GROUP BY 1, 2""",
    "merged_feed": """SELECT coalesce(n.customer_id, o.customer_id) AS customer_id,
        coalesce(n.priority, o.priority) AS priority,
        CASE WHEN n.customer_id IS NOT NULL THEN n.last_order ELSE o.last_order END AS last_order,
        CASE WHEN n.customer_id IS NOT NULL THEN n.status ELSE o.status END AS status,
        CASE WHEN n.customer_id IS NOT NULL THEN n.total ELSE o.total END AS total
        FROM old_feed o FULL JOIN new_feed n
        ON o.customer_id = n.customer_id AND o.priority = n.priority""",
    "hourly": """SELECT event_id, event_type, date_trunc('hour', ts) AS publish_ts FROM events""",
    "fresh": "SELECT * FROM hourly WHERE publish_ts > TIMESTAMP '2024-01-03 12:00:00'",
    "items": """SELECT p_partkey AS item_id, p_name AS name,
        CAST(p_retailprice AS DECIMAL(10,2)) AS price, p_size * 20 AS stock
        FROM part WHERE p_type <> 'ECONOMY'""",
    "lines": """SELECT l_orderkey AS cart_id, l_linenumber AS line_no,
        CAST(l_shipdate AS DATE) AS placed_on, l_partkey AS item_id,
        CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS qty
        FROM lineitem""",
    "carts": "SELECT o_orderkey AS cart_id, o_custkey % 45 AS distance_km FROM orders",
    "numbered_lines": """SELECT l.*, i.stock, row_number() OVER (PARTITION BY l.item_id
        ORDER BY placed_on, cart_id, line_no) AS nth
        FROM lines l JOIN items i ON l.item_id = i.item_id WHERE qty > 0""",
}

# Sequential stock hand-out, one line per item and step.
FOLD = """RECURSIVE {views},
    fold AS (
        SELECT cart_id, line_no, placed_on, item_id, qty, nth, qty <= stock AS taken,
               CASE WHEN qty <= stock THEN stock - qty ELSE stock END AS left_over
        FROM numbered_lines WHERE nth = 1
        UNION ALL
        SELECT n.cart_id, n.line_no, n.placed_on, n.item_id, n.qty, n.nth, n.qty <= f.left_over,
               CASE WHEN n.qty <= f.left_over THEN f.left_over - n.qty ELSE f.left_over END
        FROM fold f JOIN numbered_lines n ON n.item_id = f.item_id AND n.nth = f.nth + 1
    ),
    filled AS (SELECT cart_id, line_no, placed_on, item_id, qty FROM fold WHERE taken),
    remaining AS (
        SELECT i.item_id, CAST(i.stock - coalesce(sum(f.qty), 0) AS BIGINT) AS remaining
        FROM items i LEFT JOIN filled f ON i.item_id = f.item_id GROUP BY i.item_id, i.stock
    )"""


def _with(names: str, body: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names.split()) + " " + body


def _fold(body: str) -> str:
    views = ", ".join(f"{n} AS ({VIEWS[n]})" for n in ("items", "lines", "numbered_lines", "carts"))
    return "WITH " + FOLD.format(views=views) + " " + body


def _rollup(keys: str, measures: str, rows: str = "videos") -> str:
    return f"SELECT {keys}, {measures} FROM {rows} GROUP BY ALL"


_CHANNEL = """CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
    CAST(sum(dislikes) AS BIGINT) AS total_dislikes,
    CAST(sum(comment_count) AS BIGINT) AS total_comments, count(*) AS video_count"""
_KPIS = """CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
    CAST(sum(comment_count) AS BIGINT) AS total_comments, count(*) AS total_videos"""
_VIEWS_AND_COUNT = "CAST(sum(views) AS BIGINT) AS total_views, count(*) AS video_count"
_MONTH = """CAST(year(trending_date) AS INTEGER) AS "year",
    CAST(month(trending_date) AS INTEGER) AS "month", country"""


def _rule(table: str, rule: str, failed: str, source: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{rule}' AS rule, CAST(n AS BIGINT) AS failed_rows,
        n = 0 AS success FROM (SELECT {failed} AS n FROM {source})"""


def _not_null(table: str, column: str, source: str) -> str:
    return _rule(table, f"not_null({column})", f'count(*) FILTER (WHERE "{column}" IS NULL)', source)


def _unique(table: str, columns: list[str], source: str) -> str:
    cols = ", ".join(f'"{c}"' for c in columns)
    known = " OR ".join(f'"{c}" IS NOT NULL' for c in columns)
    groups = f"""(SELECT count(*) AS copies FROM {source} WHERE {known}
        GROUP BY {cols} HAVING count(*) > 1)"""
    return _rule(table, f"unique({','.join(columns)})", "coalesce(sum(copies), 0)", groups)


def _min_rows(table: str, source: str) -> str:
    return _rule(table, "min_rows(1)", "greatest(1 - count(*), 0)", source)


def _dq_gold() -> str:
    lost = "(SELECT * REPLACE (nullif(country, 'error') AS country) FROM videos)"
    tables = {
        "channel_performance": (["channel_title", "country"], "channel_title, country"),
        "category_performance": (["category_id", "country"], "category_id, country"),
        "monthly_trending": (["year", "month", "country"], _MONTH),
        "overall_kpis": (["country"], "country"),
        "channel_country": (["channel_title", "country"], "channel_title, country"),
    }
    parts = []
    for name, (keys, select) in tables.items():
        rollup = _rollup(select, "count(*) AS n_rows", lost)
        source = f"(WITH r AS ({rollup}) FROM r UNION ALL FROM r WHERE country = 'click')"
        parts.append(_min_rows(name, source))
        parts += [_not_null(name, k, source) for k in keys]
        parts.append(_unique(name, keys, source))
    return _with("videos", " UNION ALL ".join(parts))


def _dq_silver() -> str:
    source = """(SELECT * REPLACE (CASE WHEN likes <= 90 THEN likes END AS likes) FROM videos)"""
    columns = [
        "video_id", "channel_title", "country", "category_id", "views", "likes", "dislikes",
        "comment_count", "trending_date", "publish_ts",
    ]
    name = "silver_videos"
    parts = [_min_rows(name, source), *[_not_null(name, c, source) for c in columns]]
    parts.append(_unique(name, ["video_id"], source))
    parts.append(_rule(name, "has_type(views,bigint)", "0", "(SELECT 1)"))
    parts.append(_rule(name, "has_type(category_id,bigint)", "count(*)", source))
    return _with("videos", " UNION ALL ".join(parts))


def _dq_primary_key() -> str:
    keys = {
        "customer": ["c_custkey"],
        "orders": ["o_orderkey"],
        "part": ["p_partkey"],
        "supplier": ["s_suppkey"],
        "lineitem": ["l_orderkey", "l_linenumber"],
    }
    parts = []
    for table, columns in keys.items():
        parts += [_not_null(table, c, table) for c in columns]
        parts.append(_unique(table, columns, table))
    return " UNION ALL ".join(parts)


def _dq_foreign_key() -> str:
    references = [
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
        ("customer", "c_nationkey", "nation", "n_nationkey"),
        ("documents", "doc_id", "labels", "doc_id"),
    ]
    return " UNION ALL ".join(
        _rule(
            child,
            f"references({fk})",
            "count(*)",
            f"""(SELECT 1 FROM {child} c WHERE c.{fk} IS NOT NULL
                 AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk}))""",
        )
        for child, fk, parent, pk in references
    )


ORACLES: dict[str, str] = {
    # loyalty
    "spend_per_customer": _with("sales menu", """
        SELECT s.customer_id, CAST(sum(m.price) AS DOUBLE) AS total_amount_spent
        FROM sales s JOIN menu m ON s.product_id = m.product_id GROUP BY s.customer_id"""),
    "visit_days": _with("sales", """
        SELECT customer_id, count(DISTINCT order_date) AS visit_days
        FROM sales GROUP BY customer_id"""),
    "first_item_rowvalue": _with("order_sales menu", """
        SELECT s.customer_id, m.product_name AS first_item
        FROM order_sales s JOIN menu m ON s.product_id = m.product_id
        WHERE (s.customer_id, s.order_date, s.product_id) IN (
            SELECT (customer_id, min(order_date), min(product_id))
            FROM order_sales GROUP BY customer_id)"""),
    "first_item_true": _with("order_sales menu", """
        SELECT customer_id, product_name AS first_item FROM (
            SELECT customer_id, product_id,
                   row_number() OVER (PARTITION BY customer_id ORDER BY order_date, product_id) AS n
            FROM order_sales) f JOIN menu m ON f.product_id = m.product_id WHERE n = 1"""),
    "most_purchased": _with("sales menu", """
        SELECT m.product_name, count(*) AS times_purchased
        FROM sales s JOIN menu m ON s.product_id = m.product_id
        GROUP BY m.product_name ORDER BY times_purchased DESC, product_name LIMIT 1"""),
    "top_item_per_customer": _with("sales menu", """
        SELECT customer_id, product_name, total_ordered FROM (
            SELECT s.customer_id, m.product_name, count(*) AS total_ordered,
                   rank() OVER (PARTITION BY s.customer_id ORDER BY count(*) DESC) AS place
            FROM sales s JOIN menu m ON s.product_id = m.product_id
            GROUP BY s.customer_id, m.product_name) WHERE place = 1"""),
    "first_item_after": _with("sales menu members", """
        SELECT s.customer_id, m.product_name AS "FirstProduct",
               CAST(s.order_date AS VARCHAR) AS order_date
        FROM sales s JOIN menu m ON s.product_id = m.product_id
        JOIN members b ON s.customer_id = b.customer_id
        JOIN (SELECT s2.customer_id, min(s2.order_date) AS first_day
              FROM sales s2 JOIN members b2 ON s2.customer_id = b2.customer_id
              WHERE s2.order_date >= b2.join_date GROUP BY s2.customer_id) d
          ON d.customer_id = s.customer_id AND d.first_day = s.order_date"""),
    "last_item_before": _with("sales menu members", """
        SELECT s.customer_id, m.product_name AS "ProductBeforeMem",
               CAST(s.order_date AS VARCHAR) AS order_date
        FROM sales s JOIN menu m ON s.product_id = m.product_id
        JOIN members b ON s.customer_id = b.customer_id
        JOIN (SELECT s2.customer_id, max(s2.order_date) AS last_day
              FROM sales s2 JOIN members b2 ON s2.customer_id = b2.customer_id
              WHERE s2.order_date < b2.join_date GROUP BY s2.customer_id) d
          ON d.customer_id = s.customer_id AND d.last_day = s.order_date"""),
    "before_member_totals": _with("sales menu members", """
        SELECT b.customer_id, count(s.product_id) AS total_items,
               CAST(sum(m.price) AS DOUBLE) AS amount_spent
        FROM members b
        LEFT JOIN sales s ON b.customer_id = s.customer_id AND s.order_date < b.join_date
        LEFT JOIN menu m ON s.product_id = m.product_id GROUP BY b.customer_id"""),
    "points_sushi": _with("sales menu", """
        SELECT s.customer_id,
               CAST(sum(m.price * 10 * CASE WHEN m.product_name = 'PROMO' THEN 2 ELSE 1 END)
                    AS DOUBLE) AS total_points
        FROM sales s JOIN menu m ON s.product_id = m.product_id GROUP BY s.customer_id"""),
    "points_first_week": _with("sales menu members", """
        SELECT s.customer_id, CAST(sum(m.price * 10 * CASE
                   WHEN s.order_date BETWEEN b.join_date AND b.join_date + 6 THEN 2
                   WHEN m.product_name = 'PROMO' THEN 2 ELSE 1 END) AS DOUBLE) AS total_points
        FROM sales s JOIN menu m ON s.product_id = m.product_id
        JOIN members b ON s.customer_id = b.customer_id
        WHERE s.order_date <= DATE '1998-12-31' GROUP BY s.customer_id"""),
    "top5_payers": _with("sales menu", """
        SELECT customer_id, CAST(total AS DOUBLE) AS total_amount FROM (
            SELECT s.customer_id, sum(m.price) AS total
            FROM sales s JOIN menu m ON s.product_id = m.product_id GROUP BY s.customer_id)
        ORDER BY total DESC, customer_id LIMIT 5"""),
    # sales model
    "top_reps": _with("employees details", """
        SELECT employee_number AS "employeeNumber", first_name AS "firstName",
               last_name AS "lastName", CAST(total AS DOUBLE) AS "totalRevenue" FROM (
            SELECT e.employee_number, e.first_name, e.last_name,
                   sum(d.quantity * d.price_each) AS total
            FROM employees e JOIN customer c ON e.employee_number = c.c_nationkey
            JOIN orders o ON c.c_custkey = o.o_custkey
            JOIN details d ON o.o_orderkey = d.order_number GROUP BY ALL)
        ORDER BY total DESC, employee_number LIMIT 5"""),
    "top_product_line": _with("details", """
        SELECT p_brand AS "productLine", CAST(sum(quantity * price_each) AS DOUBLE)
               AS "totalRevenue"
        FROM details JOIN part ON product_code = p_partkey
        JOIN (SELECT DISTINCT p_brand AS line FROM part) l ON l.line = part.p_brand
        GROUP BY p_brand ORDER BY sum(quantity * price_each) DESC, p_brand LIMIT 1"""),
    "never_sold": """
        SELECT d.doc_id AS "productCode", d.source AS "productName", d.lang AS "productLine"
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL""",
    "orders_per_month": """
        SELECT strftime(o_orderdate, '%Y-%m') AS "yearMonth", count(*) AS "ordersCount"
        FROM orders WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 12 MONTH GROUP BY 1""",
    "top_products": _with("details", """
        SELECT p_partkey AS "productCode", p_name AS "productName",
               CAST(sum(quantity) AS BIGINT) AS total_quantity
        FROM details JOIN part ON product_code = p_partkey GROUP BY p_partkey, p_name
        ORDER BY total_quantity DESC, p_partkey LIMIT 10"""),
    "customers_per_rep": _with("employees", """
        SELECT e.employee_number AS "employeeNumber",
               e.first_name || ' ' || e.last_name AS "employeeName",
               count(c.c_custkey) AS "customerCount"
        FROM employees e LEFT JOIN customer c ON e.employee_number = c.c_nationkey
        GROUP BY ALL"""),
    # order analytics
    "customer_revenue_rank": _with("revenue_orders", """
        SELECT order_customer_id, CAST(total AS DOUBLE) AS total_revenue,
               rank() OVER (ORDER BY total DESC) AS "rank" FROM (
            SELECT order_customer_id, sum(amount) AS total
            FROM revenue_orders GROUP BY order_customer_id)"""),
    "status_pivot": _with("revenue_orders", """
        SELECT order_customer_id,
               CAST(sum(amount) FILTER (WHERE order_status = 'f') AS DOUBLE) AS f,
               CAST(sum(amount) FILTER (WHERE order_status = 'o') AS DOUBLE) AS o,
               CAST(sum(amount) FILTER (WHERE order_status IS NULL OR order_status = 'p') AS DOUBLE)
                   AS other
        FROM (SELECT * REPLACE (CASE WHEN order_id % 7 <> 0 THEN order_status END AS order_status)
              FROM revenue_orders) GROUP BY order_customer_id"""),
    "status_pivot_all": _with("revenue_orders", """
        SELECT order_customer_id,
               CAST(sum(amount) FILTER (WHERE order_status = 'f') AS DOUBLE) AS f,
               CAST(sum(amount) FILTER (WHERE order_status = 'o') AS DOUBLE) AS o,
               CAST(sum(amount) FILTER (WHERE order_status = 'p') AS DOUBLE) AS p,
               CAST(sum(amount) FILTER (WHERE order_status IS NULL) AS DOUBLE) AS other
        FROM (SELECT * REPLACE (CASE WHEN order_id % 7 <> 0 THEN order_status END AS order_status)
              FROM revenue_orders) GROUP BY order_customer_id"""),
    "monthly_revenue": _with("revenue_orders", """
        SELECT strftime(order_date, '%Y-%m') AS year_month,
               CAST(sum(amount) AS DOUBLE) AS monthly_revenue FROM revenue_orders GROUP BY 1"""),
    "last_order_per_customer": _with("revenue_orders", """
        SELECT order_customer_id, CAST(max(order_date) AS VARCHAR) AS last_order_date
        FROM revenue_orders GROUP BY order_customer_id"""),
    "churned": _with("revenue_orders", """
        SELECT order_customer_id, CAST(last_day AS VARCHAR) AS last_order_date,
               CAST(silent AS INTEGER) AS days_since_last_order FROM (
            SELECT order_customer_id, max(order_date) AS last_day, date_diff('day',
                   max(order_date), (SELECT max(order_date) FROM revenue_orders)) AS silent
            FROM revenue_orders GROUP BY order_customer_id) WHERE silent > 300"""),
    # rollups
    "gold_channel_performance": _with("videos", _rollup("channel_title, country", _CHANNEL)),
    "gold_category_performance": _with("videos", _rollup("category_id, country", _VIEWS_AND_COUNT)),
    "gold_monthly_trending": _with("videos", _rollup(_MONTH, _VIEWS_AND_COUNT)),
    "gold_overall_kpis": _with("videos", _rollup("country", _KPIS)),
    "gold_channel_country": _with("videos", _rollup(
        "channel_title, country", "CAST(sum(views) AS BIGINT) AS total_views")),
    "rollup_merge": _with("videos", _rollup("channel_title, country", _CHANNEL)),
    "rollup_merge_in_place": _with("videos", _rollup("channel_title, country", _CHANNEL)),
    "rollup_merge_category_performance": _with("videos", _rollup("category_id, country", _VIEWS_AND_COUNT)),
    "rollup_merge_monthly_trending": _with("videos", _rollup(_MONTH, _VIEWS_AND_COUNT)),
    "rollup_merge_overall_kpis": _with("videos", _rollup("country", _KPIS)),
    "rollup_merge_channel_country": _with("videos", _rollup(
        "channel_title, country", "CAST(sum(views) AS BIGINT) AS total_views")),
    "gold_distinct_videos": _with("videos", """
        SELECT country, count(*) FILTER (WHERE publish_ts <= TIMESTAMP '2024-01-16')
                 + count(*) FILTER (WHERE publish_ts > TIMESTAMP '2024-01-16' - INTERVAL 5 DAY) AS row_count,
               count(DISTINCT video_id) AS distinct_videos, true AS within_2_percent
        FROM videos GROUP BY country"""),
    "daily_sales": _with("revenue_orders", """
        SELECT CAST(order_date AS VARCHAR) AS order_date, CAST(sum(amount) AS DOUBLE) AS total_sales
        FROM revenue_orders GROUP BY order_date"""),
    # patterns
    "above_group_avg": """
        SELECT o_orderkey AS emp, o_orderpriority AS dept,
               CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS salary
        FROM orders e WHERE o_totalprice > (
            SELECT avg(o_totalprice) FROM orders i WHERE i.o_orderpriority = e.o_orderpriority)""",
    "self_join": """
        SELECT e.c_name AS name, m.c_name AS manager FROM customer e
        JOIN customer m ON e.c_nationkey = m.c_custkey WHERE e.c_custkey <> e.c_nationkey""",
    "join_right": """
        SELECT d.doc_id, d.lang, l.quality
        FROM labels l RIGHT JOIN documents d ON l.doc_id = d.doc_id""",
    "join_full": _with("old_feed new_feed", """
        SELECT coalesce(o.customer_id, n.customer_id) AS customer_id,
               coalesce(o.priority, n.priority) AS priority,
               o.total AS old_total, n.total AS new_total
        FROM old_feed o FULL JOIN new_feed n
        ON o.customer_id = n.customer_id AND o.priority = n.priority"""),
    "join_cross": _with("revenue_orders", """
        SELECT c.c_custkey AS customer_id, s.status,
               CAST(coalesce(sum(r.amount), 0) AS DOUBLE) AS revenue
        FROM customer c CROSS JOIN (VALUES ('f'), ('o'), ('p')) s(status)
        LEFT JOIN revenue_orders r
          ON r.order_customer_id = c.c_custkey AND r.order_status = s.status
        GROUP BY c.c_custkey, s.status"""),
    "sum_over": _with("staff", """
        SELECT emp, dept, CAST(salary AS DOUBLE) AS salary,
               CAST(sum(salary) OVER (PARTITION BY dept) AS DOUBLE) AS dept_total FROM staff"""),
    "row_number": _with("staff", """
        SELECT emp, dept, CAST(salary AS DOUBLE) AS salary,
               row_number() OVER (PARTITION BY dept ORDER BY salary DESC, emp) AS row_number
        FROM staff"""),
    "rank": _with("staff", """
        SELECT emp, dept, CAST(salary AS DOUBLE) AS salary,
               rank() OVER (ORDER BY salary DESC) AS "rank" FROM staff"""),
    "dense_rank": _with("staff", """
        SELECT emp, dept, CAST(salary AS DOUBLE) AS salary,
               dense_rank() OVER (PARTITION BY dept ORDER BY salary DESC) AS dense_rank
        FROM staff"""),
    "ntile": _with("staff", """
        SELECT emp, dept, CAST(salary AS DOUBLE) AS salary,
               ntile(4) OVER (PARTITION BY dept ORDER BY salary DESC, emp) AS ntile FROM staff"""),
    "nth_per_group": _with("staff", """
        SELECT dept, CAST(salary AS DOUBLE) AS salary FROM (
            SELECT dept, salary,
                   dense_rank() OVER (PARTITION BY dept ORDER BY salary DESC) AS r FROM staff)
        WHERE r = 3"""),
    "third_highest": _with("staff", """
        SELECT CAST(salary AS DOUBLE) AS salary FROM staff
        ORDER BY staff.salary DESC, emp LIMIT 1 OFFSET 2"""),
    "dup_one": """
        SELECT text, count(*) AS occurrences FROM documents GROUP BY text HAVING count(*) > 1""",
    "dup_multi": """
        SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "union_all": """
        SELECT c_nationkey AS nation_key FROM customer
        UNION ALL SELECT s_nationkey FROM supplier""",
    "union_distinct": """
        SELECT c_nationkey AS nation_key FROM customer UNION SELECT s_nationkey FROM supplier""",
    "union_by_name": """
        SELECT c_custkey AS id, c_name AS name, 'c' AS kind FROM customer
        UNION ALL BY NAME SELECT 's' AS kind, s_suppkey AS id, s_name AS name FROM supplier
        UNION ALL BY NAME SELECT p_name AS name, 'p' AS kind, p_partkey AS id FROM part""",
    # cleaning
    "clean_orders": _with(
        "first_raw raw_orders typed_orders unique_orders complete_orders valid_orders", """
        SELECT order_id, order_customer_id, "sum", CAST(order_date AS VARCHAR) AS order_date,
               order_status FROM valid_orders"""),
    "clean_audit": _with(
        "first_raw raw_orders typed_orders unique_orders complete_orders valid_orders", """
        SELECT 1 AS step_no, 'loaded' AS step, (SELECT count(*) FROM typed_orders) AS n_rows
        UNION ALL SELECT 2, 'deduplicated', (SELECT count(*) FROM unique_orders)
        UNION ALL SELECT 3, 'complete', (SELECT count(*) FROM complete_orders)
        UNION ALL SELECT 4, 'valid', (SELECT count(*) FROM valid_orders)"""),
    "clean_events": _with("first_crawl raw_videos", """
        SELECT video_id, channel_title,
               strftime(trending_day, '%Y-%m-%d') AS trending_date,
               category_id, views, likes, dislikes, comment_count, comments_disabled,
               ratings_disabled, video_error_or_removed, epoch_us(publish_ts) AS publish_us
        FROM (
            SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY publish_ts DESC) AS age
            FROM (
                SELECT video_id, channel_title,
                       try_strptime(trending_date, '%y.%d.%m') AS trending_day,
                       TRY_CAST(category_id AS INTEGER) AS category_id,
                       TRY_CAST(views AS BIGINT) AS views, TRY_CAST(likes AS BIGINT) AS likes,
                       TRY_CAST(dislikes AS BIGINT) AS dislikes,
                       TRY_CAST(comment_count AS BIGINT) AS comment_count,
                       TRY_CAST(comments_disabled AS BOOLEAN) AS comments_disabled,
                       TRY_CAST(ratings_disabled AS BOOLEAN) AS ratings_disabled,
                       TRY_CAST(video_error_or_removed AS BOOLEAN) AS video_error_or_removed,
                       try_strptime(publish_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS publish_ts
                FROM raw_videos)
            WHERE trending_day IS NOT NULL AND category_id IS NOT NULL AND views IS NOT NULL
              AND likes IS NOT NULL AND dislikes IS NOT NULL AND comment_count IS NOT NULL
              AND comments_disabled IS NOT NULL AND ratings_disabled IS NOT NULL
              AND video_error_or_removed IS NOT NULL AND publish_ts IS NOT NULL)
        WHERE age = 1"""),
    "clean_rejects": _with("first_crawl raw_videos", """
        SELECT unnest(['accepted', 'missing value', 'unreadable number', 'unreadable flag', 'unreadable day', 'older copy']) AS reason,
               unnest([count(*) FILTER (good AND age = 1), count(*) FILTER (missing), count(*) FILTER (bad_number),
                       count(*) FILTER (bad_flag), count(*) FILTER (bad_day), count(*) FILTER (good AND age > 1)]) AS n_rows
        FROM (
            SELECT *, row_number() OVER (PARTITION BY video_id, good ORDER BY publish_ts DESC) AS age FROM (
                SELECT *, NOT (missing OR bad_number OR bad_flag OR bad_day) AS good FROM (
                    SELECT video_id, try_strptime(publish_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS publish_ts,
                           video_id IS NULL OR channel_title IS NULL OR trending_date IS NULL OR category_id IS NULL
                             OR views IS NULL OR likes IS NULL OR dislikes IS NULL OR comment_count IS NULL
                             OR comments_disabled IS NULL OR ratings_disabled IS NULL OR video_error_or_removed IS NULL
                             OR try_strptime(publish_time, '%Y-%m-%dT%H:%M:%S.%fZ') IS NULL AS missing,
                           (category_id IS NOT NULL AND TRY_CAST(category_id AS INTEGER) IS NULL)
                             OR (views IS NOT NULL AND TRY_CAST(views AS BIGINT) IS NULL)
                             OR (likes IS NOT NULL AND TRY_CAST(likes AS BIGINT) IS NULL)
                             OR (dislikes IS NOT NULL AND TRY_CAST(dislikes AS BIGINT) IS NULL)
                             OR (comment_count IS NOT NULL AND TRY_CAST(comment_count AS BIGINT) IS NULL) AS bad_number,
                           (comments_disabled IS NOT NULL AND TRY_CAST(comments_disabled AS BOOLEAN) IS NULL)
                             OR (ratings_disabled IS NOT NULL AND TRY_CAST(ratings_disabled AS BOOLEAN) IS NULL)
                             OR (video_error_or_removed IS NOT NULL
                                 AND TRY_CAST(video_error_or_removed AS BOOLEAN) IS NULL) AS bad_flag,
                           trending_date IS NOT NULL AND try_strptime(trending_date, '%y.%d.%m') IS NULL AS bad_day
                    FROM raw_videos)))"""),
    "dedup_full": "SELECT DISTINCT text, lang, source FROM documents",
    "dedup_latest": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC)
              AS age FROM events) WHERE age = 1""",
    # table changes
    "merge_upsert_in_place": _with("old_feed new_feed merged_feed", "SELECT * FROM merged_feed"),
    "merge_upsert": _with("old_feed new_feed merged_feed", "SELECT * FROM merged_feed"),
    "delete_missing": _with("old_feed new_feed", """
        SELECT * FROM old_feed o WHERE EXISTS (SELECT 1 FROM new_feed n
            WHERE n.customer_id = o.customer_id AND n.priority = o.priority)"""),
    "full_sync": _with("old_feed new_feed merged_feed", """
        SELECT * FROM merged_feed o WHERE EXISTS (SELECT 1 FROM new_feed n
            WHERE n.customer_id = o.customer_id AND n.priority = o.priority)"""),
    "delete_where": _with("new_feed", """
        SELECT customer_id, priority, status FROM new_feed
        WHERE (status = 'F') IS NOT TRUE"""),
    # quality
    "dq_gold": _dq_gold(),
    "dq_silver": _dq_silver(),
    "dq_primary_key": _dq_primary_key(),
    "dq_foreign_key": _dq_foreign_key(),
    # incremental
    "incr_batch": """
        SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS publish_ts
        FROM (SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-03 12:00:00'
              ORDER BY ts, event_id LIMIT 5000)""",
    "incr_batch_ties": _with("hourly fresh", """
        SELECT event_id, event_type, strftime(publish_ts, '%Y-%m-%d %H:%M:%S.%f') AS publish_ts
        FROM fresh WHERE publish_ts <= (
            SELECT max(publish_ts) FROM (
                SELECT publish_ts FROM fresh ORDER BY publish_ts, event_id LIMIT 5000))"""),
    "incr_late_dropped": _with("hourly", """
        SELECT event_type,
               count(*) FILTER (WHERE publish_ts <= TIMESTAMP '2024-01-03 12:00:00') AS dropped,
               count(*) FILTER (WHERE publish_ts > TIMESTAMP '2024-01-03 12:00:00') AS readable
        FROM hourly GROUP BY event_type"""),
    "incr_plan": _with("hourly", """
        SELECT row_number() OVER (ORDER BY publish_ts) AS batch,
               strftime(lag(publish_ts) OVER (ORDER BY publish_ts), '%Y-%m-%d %H:%M:%S.%f') AS after,
               strftime(publish_ts, '%Y-%m-%d %H:%M:%S.%f') AS border,
               CAST(seen - coalesce(lag(seen) OVER (ORDER BY publish_ts), 0) AS BIGINT) AS rows
        FROM (
            SELECT publish_ts, count(*) AS n, sum(count(*)) OVER (ORDER BY publish_ts) AS seen,
                   max(publish_ts) OVER () AS last
            FROM hourly WHERE publish_ts > TIMESTAMP '2024-01-03 12:00:00' GROUP BY publish_ts)
        WHERE floor(seen / 100) > floor((seen - n) / 100) OR publish_ts = last"""),
    # fulfilment
    "cart_rejects": _with("items lines", """
        SELECT l.cart_id, l.line_no, CAST(l.placed_on AS VARCHAR) AS placed_on, l.item_id, l.qty,
               CASE WHEN i.item_id IS NULL THEN 'unknown item'
                    ELSE 'quantity not positive' END AS reason
        FROM lines l LEFT JOIN items i ON l.item_id = i.item_id
        WHERE i.item_id IS NULL OR l.qty <= 0"""),
    "cart_accepted": _fold("""
        SELECT cart_id, line_no, CAST(placed_on AS VARCHAR) AS placed_on, item_id, qty
        FROM filled"""),
    "cart_remaining": _fold("SELECT item_id, remaining FROM remaining"),
    "cart_delivery": _with("carts", """
        SELECT cart_id, distance_km, CAST(CASE WHEN distance_km <= 15 THEN 50
               WHEN distance_km <= 30 THEN 100 ELSE 0 END AS INTEGER) AS delivery FROM carts"""),
    "cart_bill": _fold("""
        SELECT c.cart_id, CAST(goods AS DOUBLE) AS goods, CAST(charge AS INTEGER) AS delivery,
               CAST(goods + charge AS DOUBLE) AS total
        FROM (SELECT cart_id, CASE WHEN distance_km <= 15 THEN 50
                     WHEN distance_km <= 30 THEN 100 ELSE 0 END AS charge FROM carts) c
        JOIN (SELECT f.cart_id, sum(i.price * f.qty) AS goods
              FROM filled f JOIN items i ON f.item_id = i.item_id GROUP BY f.cart_id) g
          ON c.cart_id = g.cart_id"""),
    "inventory_after": _fold("""
        SELECT i.item_id, i.name, CAST(i.price AS DOUBLE) AS price, r.remaining AS stock
        FROM items i JOIN remaining r ON i.item_id = r.item_id"""),
}

# The revenue questions once more, over what is left of the raw orders after cleaning.
_CLEANED = _with(
    "first_raw raw_orders typed_orders unique_orders complete_orders valid_orders", ""
).rstrip() + """, revenue_orders AS (
    SELECT order_id, order_customer_id, CAST("sum" AS DECIMAL(18, 2)) AS amount, order_date,
           order_status FROM valid_orders) """
for _question in ("customer_revenue_rank", "monthly_revenue", "churned"):
    ORACLES[f"clean_{_question}"] = _CLEANED + ORACLES[_question].removeprefix(
        _with("revenue_orders", "")
    )
ORACLES["clean_status_pivot"] = _CLEANED + """
    SELECT order_customer_id,
           CAST(sum(amount) FILTER (WHERE order_status = 'o') AS DOUBLE) AS o,
           CAST(sum(amount) FILTER (WHERE order_status IS DISTINCT FROM 'o') AS DOUBLE) AS other
    FROM revenue_orders GROUP BY order_customer_id"""
