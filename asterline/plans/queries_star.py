"""Projections, joins, history, aggregates, windows and set operations on the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterline.contracts import END, FLOW_RULES, ORDER_STATUSES, SEQUENCE, START, UNKNOWN_KEY
from asterline.functions import scalars
from asterline.operators import asof, lookup, scd2
from asterline.operators.quality import keep
from asterline.operators.surrogate import assign_keys
from asterline.operators.timeline import with_neighbour
from asterline.plans import model as M
from asterline.plans import star as S
from asterline.plans.catalog import query
from asterline.plans.warehouse import dimensions, joined, star
from asterline.session import scratch, stored, table

PRODUCT_VERSION = 'product_id, product_name, category_name, list_price, updated_at, "__START_AT", "__END_AT"'


def ntz(text: str):
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


# --- projections and predicates ------------------------------------------------


@query("proj_product_source", "SELECT * FROM m_product_source")
def proj_product_source(spark: SparkSession, sf: str) -> DataFrame:
    return M.product_source(spark, sf, M.price_feed(spark, sf))


@query(
    "proj_unknown_category",
    """SELECT doc_id, COALESCE(CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END, 'Unknown') AS category_name
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def proj_unknown_category(spark: SparkSession, sf: str) -> DataFrame:
    """Documents by the name of their label; most have no label."""
    documents, labels = M.labelled(spark, sf)
    named = lookup.lookup(documents, labels, "doc_id", ["category_name"])
    return named.select("doc_id", scalars.known_name("category_name").alias("category_name"))


@query(
    "proj_unknown_member",
    """SELECT d.doc_id, COALESCE(l.quality, -1) AS category_key
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def proj_unknown_member(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = M.labelled(spark, sf)
    found = lookup.lookup(documents, labels, "doc_id", ["category_key"])
    return found.select("doc_id", scalars.known_key("category_key").alias("category_key"))


@query(
    "proj_line_revenue",
    "SELECT order_id, line_number, quantity * unit_price AS line_revenue FROM m_order_line",
)
def proj_line_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return M.order_line(spark, sf).select(
        "order_id", "line_number", scalars.line_revenue().alias("line_revenue")
    )


@query(
    "proj_date_key",
    "SELECT order_id, CAST(strftime(ordered_at, '%Y%m%d') AS INTEGER) AS date_key FROM m_order",
)
def proj_date_key(spark: SparkSession, sf: str) -> DataFrame:
    return M.order(spark, sf).select("order_id", scalars.date_key("ordered_at").alias("date_key"))


@query(
    "filter_row_rules",
    """SELECT customer_id, email_domain, updated_at FROM m_customer_feed
       WHERE customer_id IS NOT NULL AND email_domain NOT LIKE '%@%'""",
)
def filter_row_rules(spark: SparkSession, sf: str) -> DataFrame:
    return keep(M.customer_feed(spark, sf), FLOW_RULES["dim_customer"]).select(
        "customer_id", "email_domain", SEQUENCE
    )


@query(
    "filter_open_versions",
    f"""SELECT {PRODUCT_VERSION}, product_key FROM m_dim_product
        WHERE product_id = 100 OR ("__END_AT" IS NULL AND product_id <> -1)""",
)
def filter_open_versions(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf).dim_product.filter(
        (F.col("product_id") == 100) | (F.col(END).isNull() & (F.col("product_id") != UNKNOWN_KEY))
    )


@query(
    "view_dim_reader",
    """SELECT customer_key, customer_id, full_name, email_domain, "__START_AT" AS valid_from,
              "__END_AT" AS valid_to, "__END_AT" IS NULL AS is_current FROM m_dim_customer""",
)
def view_dim_reader(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.reader_view(star(spark, sf).dim_customer)


@query(
    "prune_date_range",
    """SELECT date_key, count(*) AS lines, round(sum(line_revenue), 2) AS revenue FROM m_fact
       WHERE date_key BETWEEN 19970101 AND 19970331 GROUP BY date_key""",
)
def prune_date_range(spark: SparkSession, sf: str) -> DataFrame:
    """The range is on the partition column itself, so other days are not read."""
    fact = star(spark, sf).fact_order_line
    return (
        fact.filter(F.col("date_key").between(19970101, 19970331))
        .groupBy("date_key")
        .agg(F.count("*").alias("lines"), F.round(F.sum("line_revenue"), 2).alias("revenue"))
    )


@query(
    "filter_no_address",
    """SELECT customer_id, email_domain FROM m_customer
       WHERE email_domain NOT LIKE '%@%' AND NOT contains(email_domain, '@')""",
)
def filter_no_address(spark: SparkSession, sf: str) -> DataFrame:
    return (
        M.customer(spark, sf)
        .filter("email_domain NOT LIKE '%@%'")
        .select("customer_id", "email_domain")
    )


# --- joins ---------------------------------------------------------------------


@query(
    "join_lookup_left",
    """SELECT d.doc_id, d.source, CASE l.quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS category_name
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def join_lookup_left(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = M.labelled(spark, sf)
    return lookup.lookup(documents, labels, "doc_id", ["category_name"]).select("doc_id", "source", "category_name")


@query(
    "join_lines_orders",
    """SELECT order_id, line_number, product_id, customer_id, ordered_at, quantity, unit_price
       FROM m_order_line JOIN m_order USING (order_id)""",
)
def join_lines_orders(spark: SparkSession, sf: str) -> DataFrame:
    return (
        M.order_line(spark, sf)
        .join(M.order(spark, sf), "order_id")
        .select("order_id", "line_number", "product_id", "customer_id", "ordered_at", "quantity", "unit_price")
    )


def _lines_with_time(spark: SparkSession, sf: str) -> DataFrame:
    placed = M.order(spark, sf).select("order_id", "ordered_at")
    return M.order_line(spark, sf).join(placed, "order_id")


@query(
    "join_asof_product",
    """SELECT l.order_id, l.line_number, l.product_id, o.ordered_at, l.unit_price, v.list_price
       FROM m_order_line l JOIN m_order o USING (order_id)
       LEFT JOIN m_dim_product v ON v.product_id = l.product_id AND o.ordered_at >= v."__START_AT"
            AND (v."__END_AT" IS NULL OR o.ordered_at < v."__END_AT")""",
)
def join_asof_product(spark: SparkSession, sf: str) -> DataFrame:
    versions = stored(scd2.versions(M.price_feed(spark, sf), ["product_id"], unique=True), "price")
    return asof.asof_join(
        _lines_with_time(spark, sf), versions, "product_id", "ordered_at", ["list_price"]
    ).select("order_id", "line_number", "product_id", "ordered_at", "unit_price", "list_price")


@query(
    "join_asof_customer",
    """SELECT o.order_id, o.customer_id, o.ordered_at, v.email_domain FROM m_order o
       LEFT JOIN m_dim_customer v ON v.customer_id = o.customer_id AND o.ordered_at >= v."__START_AT"
            AND (v."__END_AT" IS NULL OR o.ordered_at < v."__END_AT")""",
)
def join_asof_customer(spark: SparkSession, sf: str) -> DataFrame:
    versions = stored(
        scd2.versions(M.customer_feed(spark, sf), ["customer_id"], unique=True), "domain"
    )
    orders = M.order(spark, sf).select("order_id", "customer_id", "ordered_at")
    return asof.asof_join(orders, versions, "customer_id", "ordered_at", ["email_domain"])


@query(
    "join_asof_merge",
    """SELECT e.event_id, e.user_id, v.updated_at AS state_since, v.state
       FROM events e LEFT JOIN (
            SELECT *, lead(updated_at) OVER (PARTITION BY user_id ORDER BY updated_at) AS until
            FROM m_user_feed WHERE state <> 'view') v
         ON v.user_id = e.user_id AND e.ts >= v.updated_at AND (v.until IS NULL OR e.ts < v.until)""",
)
def join_asof_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Each event with its user's last state that is not a view: many versions per user."""
    feed = M.user_feed(spark, sf).filter("state <> 'view'")
    versions = scd2.versions(feed, ["user_id"]).withColumn("state_since", F.col(START))
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return asof.asof_join(events, versions, "user_id", "ts", ["state_since", "state"]).select(
        "event_id", "user_id", "state_since", "state"
    )


#: Rows of a piece in the queries of hot keys: small, so that the given tables have timelines of many pieces.
HOT_PIECE = 1_000


@query(
    "asof_hot_instant",
    """WITH f AS (SELECT l_returnflag, l_shipdate AS updated_at, max(l_extendedprice) AS top FROM lineitem
                  WHERE l_quantity >= 45 GROUP BY ALL),
       v AS (SELECT *, lead(updated_at) OVER (PARTITION BY l_returnflag ORDER BY updated_at) AS until FROM f)
       SELECT l_orderkey, l_linenumber, l.l_returnflag, l_shipdate, v.top FROM lineitem l
       LEFT JOIN v ON v.l_returnflag = l.l_returnflag AND l_shipdate >= v.updated_at AND (v.until IS NULL OR l_shipdate < v.until)""",
)
def asof_hot_instant(spark: SparkSession, sf: str) -> DataFrame:
    """Three keys hold all lines, and every (key, day) many: the dearest bulk line of the last day up to a line's own."""
    lines = table(spark, sf, "lineitem")
    bulk = lines.where("l_quantity >= 45")
    feed = bulk.groupBy("l_returnflag", F.col("l_shipdate").alias(SEQUENCE)).agg(F.max("l_extendedprice").alias("top"))
    versions = stored(scd2.versions(feed, ["l_returnflag"], unique=True, rows_per_piece=HOT_PIECE), "hot-instant")
    left = lines.select("l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    return asof.asof_join(left, versions, "l_returnflag", "l_shipdate", ["top"], rows=HOT_PIECE)


@query(
    "anti_dangling_lines",
    """SELECT order_id, line_number, product_id FROM m_order_line l WHERE NOT EXISTS (
         SELECT 1 FROM m_order o JOIN m_price_feed f ON f.updated_at <= o.ordered_at
         WHERE o.order_id = l.order_id AND f.product_id = l.product_id)""",
)
def anti_dangling_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines whose product has no price yet when they are ordered."""
    first = M.price_feed(spark, sf).groupBy("product_id").agg(F.min("updated_at").alias("first_at"))
    lines = M.order_line(spark, sf).join(M.order(spark, sf).select("order_id", "ordered_at"), "order_id")
    known = lines.join(first, "product_id").where("first_at <= ordered_at").select("order_id", "line_number", "product_id")
    return lookup.dangling(
        M.order_line(spark, sf).select("order_id", "line_number", "product_id", F.struct("order_id", "product_id").alias("pair")),
        known.select(F.struct("order_id", "product_id").alias("pair")).distinct(), "pair", "pair",
    ).select("order_id", "line_number", "product_id")


@query(
    "anti_unused_category",
    """SELECT c.customer_id, c.full_name FROM m_customer c
       WHERE NOT EXISTS (SELECT 1 FROM m_order o WHERE o.customer_id = c.customer_id
                         AND o.status = 'delivered')""",
)
def anti_unused_category(spark: SparkSession, sf: str) -> DataFrame:
    """Parents without children: customers to whom nothing was delivered."""
    delivered = M.order(spark, sf).filter("status = 'delivered'")
    return lookup.unused(M.customer(spark, sf), delivered, "customer_id", "customer_id").select(
        "customer_id", "full_name"
    )


CHANGE_FROM = "2000-01-01 00:00:00"


@query(
    "semi_changed_keys",
    f"""SELECT DISTINCT a.product_id FROM m_price_feed a
        WHERE a.updated_at < TIMESTAMP '{CHANGE_FROM}' AND a.product_id IN
              (SELECT product_id FROM m_price_feed WHERE updated_at >= TIMESTAMP '{CHANGE_FROM}')""",
)
def semi_changed_keys(spark: SparkSession, sf: str) -> DataFrame:
    feed = M.raw_price_feed(spark, sf).select("product_id", SEQUENCE)
    first = feed.filter(F.col(SEQUENCE) < ntz(CHANGE_FROM)).select("product_id").distinct()
    second = feed.filter(F.col(SEQUENCE) >= ntz(CHANGE_FROM)).select("product_id").distinct()
    return first.join(second, "product_id", "left_semi")


@query(
    "change_detect",
    """SELECT customer_id, email_domain, updated_at FROM
       (SELECT *, lag(email_domain) OVER w AS b, row_number() OVER w AS n FROM m_customer_feed
        WINDOW w AS (PARTITION BY customer_id ORDER BY updated_at))
       WHERE n = 1 OR b IS DISTINCT FROM email_domain""",
)
def change_detect(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.changed_only(M.customer_feed(spark, sf), ["customer_id"], ["email_domain"]).select(
        "customer_id", "email_domain", SEQUENCE
    )


@query(
    "change_against_state",
    f"""SELECT b.product_id, b.list_price FROM
          (SELECT product_id, max_by(list_price, updated_at) AS list_price FROM m_price_feed GROUP BY 1) b
        LEFT JOIN (SELECT product_id, max_by(list_price, updated_at) AS was FROM m_price_feed
                   WHERE updated_at < TIMESTAMP '{CHANGE_FROM}' GROUP BY 1) s USING (product_id)
        WHERE s.was IS DISTINCT FROM b.list_price""",
)
def change_against_state(spark: SparkSession, sf: str) -> DataFrame:
    feed = M.price_feed(spark, sf)
    last = F.max_by("list_price", SEQUENCE).alias("list_price")
    batch = feed.groupBy("product_id").agg(last)
    state = feed.filter(F.col(SEQUENCE) < ntz(CHANGE_FROM)).groupBy("product_id").agg(last)
    return scd2.changed_against(batch, state, ["product_id"], ["list_price"])


@query(
    "ref_integrity",
    """SELECT 'line.order' AS reference, count(*) AS n_rows,
              count(*) FILTER (WHERE order_id NOT IN (SELECT order_id FROM m_order)) AS dangling FROM m_order_line
       UNION ALL SELECT 'line.product', count(*),
              count(*) FILTER (WHERE product_id NOT IN (SELECT product_id FROM m_product)) FROM m_order_line
       UNION ALL SELECT 'order.customer', count(*),
              count(*) FILTER (WHERE customer_id NOT IN (SELECT customer_id FROM m_customer)) FROM m_order
       UNION ALL SELECT 'product.category', count(*),
              count(*) FILTER (WHERE category_id NOT IN (SELECT category_id FROM m_category)) FROM m_product
       UNION ALL SELECT 'document.label', count(*),
              count(*) FILTER (WHERE doc_id NOT IN (SELECT doc_id FROM labels)) FROM documents""",
)
def ref_integrity(spark: SparkSession, sf: str) -> DataFrame:
    line, order, product = M.order_line(spark, sf), M.order(spark, sf), M.product(spark, sf)
    return lookup.integrity(
        {
            "line.order": (line, order, "order_id", "order_id"),
            "line.product": (line, product, "product_id", "product_id"),
            "order.customer": (order, M.customer(spark, sf), "customer_id", "customer_id"),
            "product.category": (product, M.category(spark, sf), "category_id", "category_id"),
            "document.label": (*M.labelled(spark, sf), "doc_id", "doc_id"),
        }
    )


FACT = "order_id, line_number, customer_key, product_key, date_key, quantity, unit_price, line_revenue"


@query("fact_order_line", f"SELECT {FACT} FROM m_fact")
def fact_order_line(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: lines at the versions true when ordered, built from the raw tables."""
    products, customers = dimensions(spark, sf)
    products, customers = stored(products, "dim_product"), stored(customers, "dim_customer")
    return S.fact_order_line(M.order_line(spark, sf), M.order(spark, sf), products, customers)


@query(
    "star_join",
    f"SELECT {FACT}, product_name, category_name, email_domain, year, quarter, month FROM m_star",
)
def star_join(spark: SparkSession, sf: str) -> DataFrame:
    return joined(spark, sf)


# --- history ---------------------------------------------------------------------


@query("scd2_product", f"SELECT {PRODUCT_VERSION} FROM m_dim_product")
def scd2_product(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.versions(M.product_source(spark, sf), ["product_id"])


@query(
    "scd2_customer",
    """SELECT customer_id, full_name, email_domain, updated_at, "__START_AT", "__END_AT" FROM m_dim_customer""",
)
def scd2_customer(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.versions(
        M.customer_source(spark, sf), ["customer_id"], prefer=M.CUSTOMER_PREFER
    )


USER_VERSIONS = """SELECT user_id, updated_at, state, value, updated_at AS "__START_AT",
       lead(updated_at) OVER (PARTITION BY user_id ORDER BY updated_at) AS "__END_AT" FROM m_user_feed"""


@query("scd2_out_of_order", USER_VERSIONS)
def scd2_out_of_order(spark: SparkSession, sf: str) -> DataFrame:
    """Arrival reversed and scattered over partitions: the sequence alone decides."""
    shuffled = M.user_feed(spark, sf).repartition(7, F.reverse(F.col("value").cast("string")))
    return scd2.versions(shuffled, ["user_id"])


@query(
    "scd2_hot_key",
    """SELECT event_type, ts AS updated_at, max(event_id) AS event_id, arg_max(value, event_id) AS value, ts AS "__START_AT",
              lead(ts) OVER (PARTITION BY event_type ORDER BY ts) AS "__END_AT"
       FROM events GROUP BY event_type, ts""",
)
def scd2_hot_key(spark: SparkSession, sf: str) -> DataFrame:
    """A few keys with all the rows: their timelines are cut, their versions are those of one window."""
    feed = table(spark, sf, "events").select("event_type", F.col("ts").alias(SEQUENCE), "event_id", "value")
    return scd2.versions(feed, ["event_type"], rows_per_piece=HOT_PIECE)


@query("scd2_late_arrival", USER_VERSIONS)
def scd2_late_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """Every fifth change arrives after all others and splits the interval it falls in."""
    feed = M.user_feed(spark, sf)
    late = F.pmod(F.xxhash64("user_id", SEQUENCE), F.lit(5)) == 0
    log = stored(feed.filter(~late), "log")
    return scd2.versions(
        log.unionByName(scd2.unseen(feed.filter(late), log, ["user_id"])), ["user_id"], unique=True
    )


@query(
    "scd2_dup_in_batch",
    """SELECT product_id, updated_at, list_price, updated_at AS "__START_AT",
       lead(updated_at) OVER (PARTITION BY product_id ORDER BY updated_at) AS "__END_AT" FROM m_price_feed""",
)
def scd2_dup_in_batch(spark: SparkSession, sf: str) -> DataFrame:
    """The raw feed has several prices per product and day; the greatest wins."""
    return scd2.versions(M.raw_price_feed(spark, sf), ["product_id"])


@query("scd2_rerun_idempotent", USER_VERSIONS)
def scd2_rerun_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    """The whole feed is delivered twice; the second delivery adds nothing."""
    feed = M.user_feed(spark, sf)
    log = stored(feed, "log")
    again = scd2.unseen(feed, log, ["user_id"])
    return scd2.versions(log.unionByName(again), ["user_id"], unique=True)


@query(
    "scd2_resend_versions",
    """SELECT customer_id, count(*) AS versions,
              count(*) FILTER (WHERE same) AS resent FROM
       (SELECT *, COALESCE(lag(email_domain) OVER w = email_domain, false) AS same FROM m_customer_feed
        WINDOW w AS (PARTITION BY customer_id ORDER BY updated_at)) GROUP BY customer_id""",
)
def scd2_resend_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A resent, unchanged row is a version all the same; how many are such."""
    versions = scd2.versions(M.customer_feed(spark, sf), ["customer_id"], unique=True)
    marked = with_neighbour(versions, ["customer_id"], START, F.col("email_domain"), "_b", "previous")
    return marked.groupBy("customer_id").agg(
        F.count("*").alias("versions"),
        F.count_if(F.coalesce(F.col("_b") == F.col("email_domain"), F.lit(False))).alias("resent"),
    )


@query(
    "scd2_current",
    """SELECT product_id, product_name, list_price, "__START_AT" FROM m_dim_product WHERE "__END_AT" IS NULL""",
)
def scd2_current(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.current(star(spark, sf).dim_product).select(
        "product_id", "product_name", "list_price", START
    )


@query(
    "scd2_as_of",
    """SELECT customer_id, email_domain, "__START_AT", "__END_AT" FROM m_dim_customer
       WHERE "__START_AT" <= TIMESTAMP '1998-06-15 00:00:00'
         AND ("__END_AT" IS NULL OR "__END_AT" > TIMESTAMP '1998-06-15 00:00:00')""",
)
def scd2_as_of(spark: SparkSession, sf: str) -> DataFrame:
    return scd2.as_of(star(spark, sf).dim_customer, ntz("1998-06-15 00:00:00")).select(
        "customer_id", "email_domain", START, END
    )


REBUILD_FROM = "1996-01-01 00:00:00"


@query(
    "star_rebuild",
    f"""SELECT f.product_id, f.updated_at AS "__START_AT", true AS kept_key, count(l.line_number) AS old_lines
        FROM m_dim_product f LEFT JOIN (
             SELECT l.line_number, v.product_id, v.updated_at FROM m_order_line l JOIN m_order o USING (order_id)
             JOIN (SELECT *, lead(updated_at) OVER (PARTITION BY product_id ORDER BY updated_at) AS until
                   FROM m_price_feed WHERE updated_at < TIMESTAMP '{REBUILD_FROM}') v
               ON v.product_id = l.product_id AND o.ordered_at >= v.updated_at AND (v.until IS NULL OR o.ordered_at < v.until)
             WHERE l.quantity > 0 AND l.quantity * l.unit_price >= 0) l USING (product_id, updated_at)
        WHERE f.updated_at < TIMESTAMP '{REBUILD_FROM}' GROUP BY ALL""",
)
def star_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """A star of the older feed, then a star of all of it: every older version keeps its key, and the older facts still join to it."""
    older = F.col(SEQUENCE) < ntz(REBUILD_FROM)
    products, customers = M.product_source(spark, sf), M.customer_source(spark, sf)
    orders, lines = M.order(spark, sf), M.order_line(spark, sf)
    first = S.build_star(
        spark, scratch(spark, "star-older"), S.dim_product(products.filter(older)),
        S.dim_customer(customers.filter(older), M.CUSTOMER_PREFER), orders, lines,
    )
    second = S.build_star(
        spark, scratch(spark, "star-newer"), S.dim_product(products), S.dim_customer(customers, M.CUSTOMER_PREFER),
        orders, lines, before=first,
    )
    version, old = ["product_id", START], first.dim_product.select("product_id", START, F.col("product_key").alias("old_key"))
    sold = first.fact_order_line.groupBy(F.col("product_key").alias("old_key")).agg(F.count("*").alias("old_lines"))
    kept = old.join(second.dim_product.select(*version, "product_key"), version, "left").join(sold, "old_key", "left")
    return kept.select(*version, F.col("product_key").eqNullSafe(F.col("old_key")).alias("kept_key"),
                       F.coalesce("old_lines", F.lit(0)).alias("old_lines"))


@query("surrogate_keys", """SELECT product_key, product_id, "__START_AT" FROM m_dim_product""")
def surrogate_keys(spark: SparkSession, sf: str) -> DataFrame:
    versions = scd2.versions(M.price_feed(spark, sf), ["product_id"], unique=True)
    return assign_keys(
        versions.select("product_id", SEQUENCE, START), ["product_id"], SEQUENCE, "product_key"
    ).drop(SEQUENCE)


@query(
    "surrogate_keys_rebuild",
    """SELECT product_id, "__START_AT", "__START_AT" < TIMESTAMP '1997-01-01' AS was_stored,
              "__START_AT" < TIMESTAMP '1997-01-01' AS same_key, 1 AS versions_of_key FROM m_dim_product""",
)
def surrogate_keys_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    """The older part of the feed is numbered first, then all of it: old versions keep their keys, new ones get others."""
    feed = scd2.versions(M.price_feed(spark, sf), ["product_id"], unique=True).select("product_id", SEQUENCE, START)
    old = feed.where(F.col(SEQUENCE) < F.expr("TIMESTAMP_NTZ'1997-01-01 00:00:00'"))
    first = stored(assign_keys(old, ["product_id"], SEQUENCE, "product_key"), "keys")
    both = stored(assign_keys(feed, ["product_id"], SEQUENCE, "product_key", stored=first), "keys")
    times = both.groupBy("product_key").agg(F.count("*").cast("int").alias("versions_of_key"))
    had = first.select("product_id", SEQUENCE, F.col("product_key").alias("had"))
    return both.join(had, ["product_id", SEQUENCE], "left").join(times, "product_key").select(
        "product_id", START, F.col("had").isNotNull().alias("was_stored"),
        F.coalesce(F.col("had") == F.col("product_key"), F.lit(False)).alias("same_key"), "versions_of_key",
    )


# --- aggregates --------------------------------------------------------------------


@query(
    "agg_versions_per_key",
    "SELECT product_id, count(*) AS versions FROM m_dim_product GROUP BY product_id",
)
def agg_versions_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf).dim_product.groupBy("product_id").agg(F.count("*").alias("versions"))


@query(
    "agg_open_per_key",
    """SELECT product_id, count(*) AS open_versions FROM m_dim_product
       WHERE "__END_AT" IS NULL GROUP BY product_id""",
)
def agg_open_per_key(spark: SparkSession, sf: str) -> DataFrame:
    return (
        scd2.current(star(spark, sf).dim_product)
        .groupBy("product_id")
        .agg(F.count("*").alias("open_versions"))
    )


@query(
    "agg_unknown_facts",
    """SELECT count(*) FILTER (WHERE product_key = -1) AS unknown_products,
              count(*) FILTER (WHERE customer_key = -1) AS unknown_customers, count(*) AS lines FROM m_fact""",
)
def agg_unknown_facts(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf).fact_order_line.agg(
        F.count_if(F.col("product_key") == UNKNOWN_KEY).alias("unknown_products"),
        F.count_if(F.col("customer_key") == UNKNOWN_KEY).alias("unknown_customers"),
        F.count("*").alias("lines"),
    )


@query(
    "agg_null_keys",
    """SELECT count(*) FILTER (WHERE product_key IS NULL OR customer_key IS NULL OR date_key IS NULL)
              AS null_keys, count(*) AS lines FROM m_fact""",
)
def agg_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    missing = F.col("product_key").isNull() | F.col("customer_key").isNull() | F.col("date_key").isNull()
    return star(spark, sf).fact_order_line.agg(
        F.count_if(missing).alias("null_keys"), F.count("*").alias("lines")
    )


@query(
    "agg_distinct_keys",
    """SELECT product_id, count(*) AS versions, count(DISTINCT product_key) AS keys
       FROM m_dim_product GROUP BY product_id""",
)
def agg_distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return (
        star(spark, sf)
        .dim_product.groupBy("product_id")
        .agg(F.count("*").alias("versions"), F.count_distinct("product_key").alias("keys"))
    )


def _measures():
    return [
        F.count("*").alias("lines"),
        F.sum("quantity").alias("quantity"),
        F.round(F.sum("line_revenue"), 2).alias("revenue"),
    ]


MEASURES = "count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS quantity, round(sum(line_revenue), 2) AS revenue"


def _totals(df: DataFrame, *by: str) -> DataFrame:
    """Additive measures of partial sums, under names for the total rows."""
    summed = df.agg(
        F.sum("lines").alias("lines"),
        F.sum("quantity").alias("quantity"),
        F.round(F.sum("revenue"), 2).alias("revenue"),
    )
    named = [F.coalesce(F.col(c).cast("string"), F.lit("all")).alias(c) for c in by]
    return summed.select(*named, "lines", "quantity", "revenue")


def _partial():
    return [
        F.count("*").alias("lines"),
        F.sum("quantity").alias("quantity"),
        F.sum("line_revenue").alias("revenue"),
    ]


def _by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Additive measures per day before any join, then the calendar's names."""
    s = star(spark, sf)
    days = s.fact_order_line.groupBy("date_key").agg(*_partial())
    return days.join(s.dim_date.select("date_key", "year", "quarter", "month"), "date_key")


@query(
    "star_rollup",
    f"""SELECT COALESCE(CAST(year AS VARCHAR), 'all') AS year, COALESCE(CAST(quarter AS VARCHAR), 'all') AS quarter,
               COALESCE(CAST(month AS VARCHAR), 'all') AS month, {MEASURES}
        FROM m_star GROUP BY ROLLUP (m_star.year, m_star.quarter, m_star.month)""",
)
def star_rollup(spark: SparkSession, sf: str) -> DataFrame:
    by = ("year", "quarter", "month")
    return _totals(_by_day(spark, sf).rollup(*by), *by)


@query(
    "star_cube",
    f"""SELECT COALESCE(category_name, 'all') AS category_name, COALESCE(email_domain, 'all') AS email_domain,
               COALESCE(CAST(year AS VARCHAR), 'all') AS year, {MEASURES}
        FROM m_star GROUP BY CUBE (m_star.category_name, m_star.email_domain, m_star.year)""",
)
def star_cube(spark: SparkSession, sf: str) -> DataFrame:
    """Grouped once at the finest level; the cube expands those groups, not the lines."""
    by = ("category_name", "email_domain", "year")
    return _totals(joined(spark, sf).groupBy(*by).agg(*_partial()).cube(*by), *by)


@query(
    "revenue_by_domain_category",
    f"SELECT email_domain, category_name, {MEASURES} FROM m_star GROUP BY email_domain, category_name",
)
def revenue_by_domain_category(spark: SparkSession, sf: str) -> DataFrame:
    return joined(spark, sf).groupBy("email_domain", "category_name").agg(*_measures())


@query("revenue_by_quarter", f"SELECT year, quarter, {MEASURES} FROM m_star GROUP BY year, quarter")
def revenue_by_quarter(spark: SparkSession, sf: str) -> DataFrame:
    """The quarter is read from the calendar, never derived from a timestamp."""
    by = ("year", "quarter")
    return _by_day(spark, sf).groupBy(*by).agg(
        F.sum("lines").alias("lines"),
        F.sum("quantity").alias("quantity"),
        F.round(F.sum("revenue"), 2).alias("revenue"),
    )


@query(
    "orders_by_status",
    """SELECT status, status IN ('placed', 'shipped', 'delivered', 'cancelled') AS listed,
              count(*) AS orders FROM m_order GROUP BY status""",
)
def orders_by_status(spark: SparkSession, sf: str) -> DataFrame:
    counted = M.order(spark, sf).groupBy("status").agg(F.count("*").alias("orders"))
    return counted.select("status", F.col("status").isin(*ORDER_STATUSES).alias("listed"), "orders")


@query(
    "price_change_history",
    """SELECT product_id, updated_at AS changed_at, before AS price_before, list_price AS price_after,
              list_price - before AS change
       FROM (SELECT *, lag(list_price) OVER (PARTITION BY product_id ORDER BY updated_at) AS before FROM m_dim_product)
       WHERE before <> list_price""",
)
def price_change_history(spark: SparkSession, sf: str) -> DataFrame:
    marked = with_neighbour(
        star(spark, sf).dim_product, ["product_id"], START, F.col("list_price"), "price_before", "previous"
    )
    return marked.filter(F.col("price_before") != F.col("list_price")).select(
        "product_id",
        F.col(START).alias("changed_at"),
        "price_before",
        F.col("list_price").alias("price_after"),
        (F.col("list_price") - F.col("price_before")).alias("change"),
    )


# --- windows, sorts, sets, scalars -------------------------------------------------------


@query(
    "win_intervals_abut",
    """SELECT product_id, "__START_AT" AS valid_from, "__END_AT" AS valid_to,
              lead("__START_AT") OVER w IS NOT DISTINCT FROM "__END_AT" AS abuts
       FROM m_dim_product WINDOW w AS (PARTITION BY product_id ORDER BY "__START_AT")""",
)
def win_intervals_abut(spark: SparkSession, sf: str) -> DataFrame:
    return S.interval_check(star(spark, sf).dim_product, "product_id").select(
        "product_id", F.col(START).alias("valid_from"), F.col(END).alias("valid_to"), "abuts"
    )


@query(
    "sort_history",
    """SELECT customer_id, "__START_AT" AS valid_from, email_domain FROM m_dim_customer
       ORDER BY customer_id, valid_from""",
)
def sort_history(spark: SparkSession, sf: str) -> DataFrame:
    return (
        star(spark, sf)
        .dim_customer.select("customer_id", F.col(START).alias("valid_from"), "email_domain")
        .orderBy("customer_id", "valid_from")
    )


@query(
    "union_unknown_member",
    f"""SELECT product_key, {PRODUCT_VERSION} FROM m_dim_product UNION ALL
        SELECT -1, -1, 'Unknown', 'Unknown', 0.0, TIMESTAMP '1900-01-01 00:00:00',
               TIMESTAMP '1900-01-01 00:00:00', NULL""",
)
def union_unknown_member(spark: SparkSession, sf: str) -> DataFrame:
    return S.with_unknown(star(spark, sf).dim_product)


@query(
    "set_key_difference",
    """SELECT customer_id FROM m_customer EXCEPT
       SELECT customer_id FROM m_order WHERE status = 'shipped'""",
)
def set_key_difference(spark: SparkSession, sf: str) -> DataFrame:
    shipped = M.order(spark, sf).filter("status = 'shipped'").select("customer_id")
    return M.customer(spark, sf).select("customer_id").subtract(shipped)


@query(
    "set_key_intersection",
    """SELECT customer_id FROM m_order WHERE status = 'shipped' INTERSECT
       SELECT customer_id FROM m_order WHERE status = 'placed'""",
)
def set_key_intersection(spark: SparkSession, sf: str) -> DataFrame:
    orders = M.order(spark, sf)
    return (
        orders.filter("status = 'shipped'").select("customer_id")
        .intersect(orders.filter("status = 'placed'").select("customer_id"))
    )


@query(
    "scalar_canonical_hash",
    """SELECT event_id, sha256('{"event_type":"' || event_type || '","machine":"m' || (user_id % 4) ||
              '","user_id":' || user_id || '}') AS digest FROM events""",
)
def scalar_canonical_hash(spark: SparkSession, sf: str) -> DataFrame:
    text = scalars.canonical_json(
        user_id=F.col("user_id"),
        machine=F.concat(F.lit("m"), F.col("user_id") % 4),
        event_type=F.col("event_type"),
    )
    return table(spark, sf, "events").select("event_id", F.sha2(text, 256).alias("digest"))


@query(
    "scalar_canonical_nested",
    """SELECT event_id, sha256('{"at":[{"id":' || event_id || ',"kind":"' || event_type || '"},null],"machine":{"name":"m' ||
              (user_id % 4) || '","user":' || user_id || '}}') AS digest FROM events""",
)
def scalar_canonical_nested(spark: SparkSession, sf: str) -> DataFrame:
    """One object, written with its names in another order and other spaces by each machine: one digest."""
    one = '{"machine":{"user":%d,"name":"m%d"},"at":[{"kind":"%s","id":%d},null]}'
    two = '{ "at" : [ {"id": %4$d, "kind": "%3$s"}, null ],\n "machine": {"name": "m%2$d", "user": %1$d} }'
    values = ["user_id", F.col("user_id") % 4, "event_type", "event_id"]
    text = F.when(F.col("event_id") % 2 == 0, F.format_string(one, *values)).otherwise(F.format_string(two, *values))
    return table(spark, sf, "events").select("event_id", F.sha2(scalars.canonical_object(text), 256).alias("digest"))


@query(
    "scalar_to_timestamp",
    """SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END AS ordered_at
       FROM orders""",
)
def scalar_to_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    """Text read as a time; what is no time becomes null instead of stopping the query."""
    text = F.when(F.col("o_orderkey") % 5 == 0, "no date").otherwise(F.col("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), text.try_cast("timestamp_ntz").alias("ordered_at")
    )


@query(
    "scalar_line_number",
    """SELECT doc_id, length(substr(text, 1, p - 1)) - length(replace(substr(text, 1, p - 1), chr(10), '')) + 1 AS line
       FROM (SELECT doc_id, text, instr(text, '@') AS p FROM documents) WHERE p > 0""",
)
def scalar_line_number(spark: SparkSession, sf: str) -> DataFrame:
    at = F.instr("text", "@")
    return (
        table(spark, sf, "documents")
        .filter(F.contains("text", F.lit("@")))
        .select("doc_id", scalars.line_number(F.col("text"), at).cast("long").alias("line"))
    )


@query("scalar_nonblank", "SELECT conv_id, turn, length(trim(text)) > 0 AS filled FROM conversations")
def scalar_nonblank(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", scalars.nonblank("text").alias("filled")
    )


@query("dim_date", "SELECT * FROM m_dim_date")
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return S.calendar_of(M.order(spark, sf), "ordered_at")
