"""The registry of queries, each beside the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BUCKET = "CAST('0x' || substr(md5(concat_ws('|', {key}, epoch_us(updated_at))), 1, 4) AS BIGINT)"


def _versioned(source: str, key: str, surrogate: str, rules: str) -> str:
    return f"""
    SELECT (row_number() OVER (PARTITION BY b ORDER BY {key}, updated_at) - 1) * 65536 + b + 1 AS {surrogate},
           * EXCLUDE (b)
    FROM (SELECT *, updated_at AS "__START_AT",
                 lead(updated_at) OVER (PARTITION BY {key} ORDER BY updated_at) AS "__END_AT",
                 {BUCKET.format(key=key)} AS b
          FROM {source} WHERE {rules})"""


# The model in SQL; a query's text is prefixed with the parts it mentions.
MODEL: dict[str, str] = {
    "m_category": """
    SELECT DISTINCT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS category_id,
           p_brand AS category_name
    FROM part""",
    "m_product": """
    SELECT p_partkey AS product_id, p_name AS product_name,
           CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS category_id,
           p_retailprice AS list_price
    FROM part""",
    "m_customer": """
    SELECT c_custkey AS customer_id, c_name AS full_name,
           lower(c_mktsegment) || '.test' AS email_domain,
           TIMESTAMP '1995-01-01 00:00:00' AS registered_at
    FROM customer""",
    "m_order": """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS ordered_at,
           CASE o_orderstatus WHEN 'O' THEN 'placed' WHEN 'P' THEN 'shipped'
                WHEN 'F' THEN 'delivered' ELSE o_orderstatus END AS status
    FROM orders""",
    "m_order_line": """
    SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_number,
           l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity,
           l_extendedprice / l_quantity AS unit_price
    FROM lineitem""",
    "m_price_feed": """
    SELECT l_partkey AS product_id, l_shipdate AS updated_at,
           max(l_extendedprice / l_quantity) AS list_price
    FROM lineitem GROUP BY 1, 2""",
    "m_product_source": """
    SELECT f.product_id, p.product_name, COALESCE(c.category_name, 'Unknown') AS category_name,
           f.list_price, f.updated_at
    FROM m_price_feed f LEFT JOIN m_product p USING (product_id)
    LEFT JOIN m_category c USING (category_id)""",
    "m_customer_feed": """
    SELECT o_custkey AS customer_id, o_orderdate AS updated_at,
           replace(lower(substr(arg_max(o_orderpriority, o_orderkey), 3)), ' ', '-') || '.test' AS email_domain
    FROM orders GROUP BY 1, 2""",
    "m_customer_source": """
    SELECT f.customer_id, c.full_name, f.email_domain, f.updated_at
    FROM m_customer_feed f LEFT JOIN m_customer c USING (customer_id)""",
    "m_user_feed": """
    SELECT user_id, ts AS updated_at, event_type AS state, value FROM events""",
    "m_dim_product": _versioned(
        "m_product_source", "product_id", "product_key", "product_id IS NOT NULL AND list_price >= 0"
    ),
    "m_dim_customer": _versioned(
        "m_customer_source", "customer_id", "customer_key",
        "customer_id IS NOT NULL AND email_domain NOT LIKE '%@%'",
    ),
    "m_dim_date": """
    SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS calendar_date,
           year(d) AS year, quarter(d) AS quarter, month(d) AS month, day(d) AS day_of_month,
           dayofweek(d) IN (0, 6) AS is_weekend
    FROM (SELECT unnest(generate_series(date_trunc('day', min(o_orderdate)),
                 date_trunc('day', max(o_orderdate)), INTERVAL 1 DAY)) AS d FROM orders)""",
    "m_fact": """
    SELECT l.order_id, l.line_number, COALESCE(c.customer_key, -1) AS customer_key,
           COALESCE(p.product_key, -1) AS product_key,
           CAST(strftime(o.ordered_at, '%Y%m%d') AS INTEGER) AS date_key,
           l.quantity, l.unit_price, l.quantity * l.unit_price AS line_revenue
    FROM m_order_line l JOIN m_order o USING (order_id)
    LEFT JOIN m_dim_product p ON p.product_id = l.product_id AND o.ordered_at >= p."__START_AT"
         AND (p."__END_AT" IS NULL OR o.ordered_at < p."__END_AT")
    LEFT JOIN m_dim_customer c ON c.customer_id = o.customer_id AND o.ordered_at >= c."__START_AT"
         AND (c."__END_AT" IS NULL OR o.ordered_at < c."__END_AT")
    WHERE l.quantity > 0 AND l.quantity * l.unit_price >= 0""",
    "m_star": """
    SELECT f.*, p.product_name, p.category_name, c.email_domain, d.year, d.quarter, d.month
    FROM m_fact f
    JOIN (SELECT product_key, product_name, category_name FROM m_dim_product
          UNION ALL SELECT -1, 'Unknown', 'Unknown') p USING (product_key)
    JOIN (SELECT customer_key, email_domain FROM m_dim_customer
          UNION ALL SELECT -1, 'Unknown') c USING (customer_key)
    JOIN m_dim_date d USING (date_key)""",
}

_NAME = re.compile(r"\bm_[a-z_]+\b")


def expanded(sql: str) -> str:
    """The SQL with the model parts it needs, in order, as common table expressions."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _NAME.findall(text):
            if name in MODEL and name not in needed:
                visit(MODEL[name])
                needed.append(name)

    visit(sql)
    body = sql.strip()
    recursive = body.upper().startswith("WITH RECURSIVE")
    parts = [f"{name} AS ({MODEL[name].strip()})" for name in needed]
    if body.upper().startswith("WITH"):
        head = "WITH RECURSIVE" if recursive else "WITH"
        rest = body[len(head):].strip()
        return f"{head} " + ", ".join([*parts, rest]) if parts else body
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = expanded(sql)
        return function

    return register
