"""Sources, sinks and streams over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterline.contracts import (
    FLOW_RULES, OLAP, OLTP, SEQUENCE, Contract, Field, Rule, generated_keys,
)
from asterline.operators import personal, scd2
from asterline.operators.quality import keep
from asterline.plans import model as M
from asterline.plans import star as S
from asterline.plans.catalog import query
from asterline.plans.queries_star import FACT, MEASURES, USER_VERSIONS
from asterline.plans.warehouse import star
from asterline.session import scratch, table
from asterline.sources import sinks, tables
from asterline.streaming import flows


def _stream(spark: SparkSession, sf: str, name: str, files: int | None = None) -> DataFrame:
    return tables.stream(spark, f"{sf}/{name}.parquet", table(spark, sf, name).schema, files)


# --- sources -----------------------------------------------------------------------


@query("src_stream_events", "SELECT event_id, ts, user_id, event_type, value FROM events")
def src_stream_events(spark: SparkSession, sf: str) -> DataFrame:
    events = _stream(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return flows.append_stream(events, scratch(spark, "events"))


@query(
    "src_snapshot_orders",
    "SELECT o_orderkey, o_custkey, o_orderdate FROM orders",
)
def src_snapshot_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = tables.snapshot(spark, f"{sf}/orders.parquet")
    return orders.select("o_orderkey", "o_custkey", "o_orderdate")


@query("src_landing_zone", "SELECT event_id, ts, user_id, event_type FROM events")
def src_landing_zone(spark: SparkSession, sf: str) -> DataFrame:
    """Extracts land as raw JSON files and are read as a stream with a declared schema."""
    extract = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    zone, fmt = scratch(spark, "landing"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    extract.write.option("timestampNTZFormat", fmt).json(zone)
    arriving = spark.readStream.schema(extract.schema).option("timestampNTZFormat", fmt).json(zone)
    return flows.append_stream(arriving, scratch(spark, "landed"))


@query(
    "src_columnar_document",
    """SELECT p_partkey AS product_id, p_retailprice AS list_price, TIMESTAMP '2026-01-01 00:00:00' AS seen_at FROM part
       UNION ALL SELECT p_partkey, p_retailprice * 2, NULL FROM part""",
)
def src_columnar_document(spark: SparkSession, sf: str) -> DataFrame:
    """One document per part with an array per column; the second time is no time."""
    document = F.to_json(
        F.struct(
            F.array("p_partkey", "p_partkey").alias("product_id"),
            F.array(F.col("p_retailprice"), F.col("p_retailprice") * 2).alias("list_price"),
            F.array(F.lit("2026-01-01"), F.lit("soon")).alias("seen_at"),
        )
    )
    contract = Contract(
        "quote",
        (Field("product_id", "int64"), Field("list_price", "float64"), Field("seen_at", "datetime64[ns]")),
    )
    documents = table(spark, sf, "part").select(document.alias("document"))
    return tables.columnar_document(documents, "document", contract, ("seen_at",))


@query(
    "src_text_corpus",
    """SELECT page_id, path, n_chars FROM (
         SELECT page_id, length(html) AS n_chars, regexp_replace(url, '[?#].*$', '') AS path FROM pages)
       WHERE NOT regexp_matches(lower(path), '(\\.(png|jpe?g|gif|ico|woff2?)|/(uv|flake)\\.lock)$')""",
)
def src_text_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Pages by the path of their address, without those whose name says that they are no text."""
    files = table(spark, sf, "pages").select(
        "page_id",
        F.regexp_replace("url", "[?#].*$", "").alias("path"),
        F.length("html").cast("long").alias("n_chars"),
    )
    return personal.scannable(files)


@query(
    "sql_named_parameters",
    """SELECT order_id, line_number, quantity, unit_price FROM m_order_line
       WHERE quantity >= 40 AND unit_price < 1000""",
)
def sql_named_parameters(spark: SparkSession, sf: str) -> DataFrame:
    return tables.sql(
        spark,
        """SELECT order_id, line_number, quantity, unit_price FROM IDENTIFIER(:lines)
           WHERE quantity >= :least AND unit_price < :below""",
        {"lines": M.order_line(spark, sf)},
        least=40,
        below=1000,
    )


# --- sinks -------------------------------------------------------------------------


@query(
    "sink_append_sequenced",
    "SELECT customer_id, full_name, TIMESTAMP '2026-01-01 00:00:00' AS updated_at FROM m_customer",
)
def sink_append_sequenced(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, "customer")
    sinks.append_sequenced(
        M.customer(spark, sf).select("customer_id", "full_name"), path, sinks.INITIAL_AT
    )
    return spark.read.parquet(path)


@query(
    "load_initial_then_change",
    """WITH log AS (
         SELECT product_id, list_price, TIMESTAMP '2026-01-01 00:00:00' AS updated_at FROM m_product
         UNION ALL SELECT product_id, list_price * 2, TIMESTAMP '2026-03-01 00:00:00' FROM m_product WHERE list_price > 1000)
       SELECT product_id, list_price, updated_at AS "__START_AT",
              lead(updated_at) OVER (PARTITION BY product_id ORDER BY updated_at) AS "__END_AT" FROM log""",
)
def load_initial_then_change(spark: SparkSession, sf: str) -> DataFrame:
    """Two ordered loads, each written twice: only what changed is in the second."""
    products, log = M.product(spark, sf).select("product_id", "list_price"), scratch(spark, "log")
    changed = products.filter("list_price > 1000").withColumn("list_price", F.col("list_price") * 2)
    for _ in range(2):
        sinks.load_batch(products, log, 0, sinks.INITIAL_AT)
        sinks.load_batch(changed, log, 1, sinks.CHANGE_AT)
    feed = spark.read.parquet(log).drop("batch")
    return scd2.versions(feed, ["product_id"]).drop(SEQUENCE)


@query(
    "load_validated",
    """SELECT product_id, product_name, category_id, list_price, TIMESTAMP '2026-01-01 00:00:00' AS updated_at
       FROM m_product WHERE product_id > 0""",
)
def load_validated(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that break the contract are set aside; the rest must pass as a whole."""
    path, contract = scratch(spark, "product"), OLTP["product"]
    sinks.load_validated(
        keep(M.product(spark, sf), contract.row_rules()), contract, path, sinks.INITIAL_AT
    )
    return spark.read.parquet(path)


def _described(df: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, data_type, n_rows, n_nulls) of one table, one pass."""
    counted = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(df.schema.fields)],
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f"n{i}").alias("n_nulls"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    return counted.select(F.lit(name).alias("table_name"), "n_rows", F.inline(cells))


SQL_TYPE = {"long": "bigint", "integer": "int"}


def _described_sql(sources: dict[str, tuple[str, list[tuple[str, str]]]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, "
        f'count(*) - count("{c}") AS n_nulls FROM ({source})'
        for name, (source, columns) in sources.items()
        for c, t in columns
    )


def _stored(contract: Contract) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in contract.stored_schema().fields]


@query(
    "ddl_oltp_tables",
    _described_sql(
        {
            name: (
                f"SELECT *, TIMESTAMP '2026-01-01 00:00:00' AS updated_at FROM m_{name}",
                _stored(contract),
            )
            for name, contract in OLTP.items()
        }
    ),
)
def ddl_oltp_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The tables are made from their contracts, twice, loaded and described."""
    database = f"asterline_{uuid.uuid4().hex}"
    where = scratch(spark, "oltp")
    sinks.create_tables(spark, database, where)
    targets = sinks.create_tables(spark, database, where)
    result = None
    for name, target in targets.items():
        rows = getattr(M, name)(spark, sf).withColumn(SEQUENCE, sinks.at(sinks.INITIAL_AT))
        rows.select(*[c for c, _ in _stored(OLTP[name])]).write.insertInto(target)
        part = _described(spark.table(target), name)
        result = part if result is None else result.unionByName(part)
    return result


VERSIONED = {name: contract for name, contract in OLAP.items() if contract.versioned}


@query(
    "ddl_versioned_dims",
    _described_sql(
        {name: (f"SELECT * FROM m_{name}", _stored(contract)) for name, contract in VERSIONED.items()}
    ),
)
def ddl_versioned_dims(spark: SparkSession, sf: str) -> DataFrame:
    """The dimensions as stored: generated key, sequence and interval by contract."""
    s, result = star(spark, sf), None
    for name, contract in VERSIONED.items():
        stored = getattr(s, name)
        columns = [c for c, _ in _stored(contract)]
        assert generated_keys(contract) == columns[:1]
        part = _described(stored.select(*columns), name)
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "sink_streaming_dim",
    """SELECT customer_id, email_domain, updated_at AS "__START_AT",
              lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at) AS "__END_AT" FROM m_customer_feed""",
)
def sink_streaming_dim(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension target with a declared schema and row rules, filled by a stream."""
    changes = M.domain_changes(_stream(spark, sf, "orders"))
    flow = flows.DimensionFlow(
        spark, scratch(spark, "dim"), ["customer_id"], "customer_key", changes.schema,
        FLOW_RULES["dim_customer"], prefer=M.CUSTOMER_PREFER,
    )
    flow.run(changes)
    return flow.versions().drop(SEQUENCE, "customer_key")


@query(
    "sink_partitioned_fact",
    "SELECT date_key, count(*) AS lines, round(sum(line_revenue), 2) AS revenue FROM m_fact GROUP BY date_key",
)
def sink_partitioned_fact(spark: SparkSession, sf: str) -> DataFrame:
    """The fact written partitioned by day, read back by its partition column."""
    path = scratch(spark, "fact")
    S.write_fact(star(spark, sf).fact_order_line, path)
    return (
        spark.read.parquet(path)
        .groupBy("date_key")
        .agg(F.count("*").alias("lines"), F.round(F.sum("line_revenue"), 2).alias("revenue"))
    )


# --- streams -----------------------------------------------------------------------


@query(
    "stream_triggered",
    "SELECT event_type, count(*) AS events, 0 AS added_by_rerun FROM events GROUP BY event_type",
)
def stream_triggered(spark: SparkSession, sf: str) -> DataFrame:
    """A triggered run takes what is there; a second one finds nothing new."""
    target = scratch(spark, "triggered")
    changes = _stream(spark, sf, "events").select("event_id", "event_type")
    first = flows.append_stream(changes, target).groupBy("event_type").agg(F.count("*").alias("events"))
    before = flows.append_stream(changes, target).count()
    rerun = flows.run_available(changes, target)
    after = spark.read.schema(changes.schema).parquet(f"{target}/data").count()
    assert rerun.exception() is None
    return first.withColumn("added_by_rerun", F.lit(after - before))


@query(
    "stream_lookup",
    """SELECT l.l_partkey AS product_id, p.product_name, COALESCE(c.category_name, 'Unknown') AS category_name,
              l.l_extendedprice / l.l_quantity AS list_price, l.l_shipdate AS updated_at
       FROM lineitem l LEFT JOIN m_product p ON p.product_id = l.l_partkey
       LEFT JOIN m_category c USING (category_id)""",
)
def stream_lookup(spark: SparkSession, sf: str) -> DataFrame:
    changes = M.price_changes(_stream(spark, sf, "lineitem"))
    return flows.append_stream(M.product_source(spark, sf, changes), scratch(spark, "lookup"))


@query("stream_scd2", USER_VERSIONS)
def stream_scd2(spark: SparkSession, sf: str) -> DataFrame:
    """Changes arrive late, out of order and some twice, over several micro-batches."""
    feed, zone = M.user_feed(spark, sf), scratch(spark, "changes")
    scattered = feed.repartition(3, F.xxhash64("value"))
    scattered.write.parquet(zone)
    feed.filter(F.pmod(F.xxhash64(SEQUENCE), F.lit(10)) == 0).repartition(1).write.mode("append").parquet(zone)
    flow = flows.DimensionFlow(spark, scratch(spark, "users"), ["user_id"], "user_key", feed.schema)
    flow.run(spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 2).parquet(zone))
    return flow.versions().drop("user_key")


@query(
    "stream_conflicts",
    """SELECT product_id, list_price, updated_at, updated_at AS "__START_AT",
              lead(updated_at) OVER (PARTITION BY product_id ORDER BY updated_at) AS "__END_AT" FROM m_price_feed""",
)
def stream_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Several prices per product and day, in different micro-batches: the greatest wins in any order of arrival."""
    feed, zone = M.raw_price_feed(spark, sf), scratch(spark, "prices")
    feed.repartition(4, F.xxhash64("list_price")).write.parquet(zone)
    flow = flows.DimensionFlow(spark, scratch(spark, "products"), ["product_id"], "product_key", feed.schema)
    flow.run(spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(zone))
    return flow.materialize().drop("product_key")


@query("stream_fact", f"SELECT {FACT} FROM m_fact")
def stream_fact(spark: SparkSession, sf: str) -> DataFrame:
    s = star(spark, sf)
    lines = M.lines_of(_stream(spark, sf, "lineitem"))
    flow = flows.FactFlow(
        spark, scratch(spark, "fact"), M.order(spark, sf), s.dim_product, s.dim_customer
    )
    flow.run(lines)
    return flow.fact()


@query("stream_fact_late_orders", f"SELECT {FACT} FROM m_fact")
def stream_fact_late_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Lines arrive first, their orders in two later loads: no line is lost, each is resolved when its order is there."""
    s, home = star(spark, sf), scratch(spark, "late")
    orders = M.order(spark, sf).select("order_id", "customer_id", "ordered_at")
    half = F.pmod(F.xxhash64("order_id"), F.lit(2))
    orders.filter("false").write.parquet(f"{home}/orders")
    arriving = spark.readStream.schema(orders.schema).parquet(f"{home}/orders")
    flow = flows.FactFlow(spark, f"{home}/fact", orders.filter("false"), s.dim_product, s.dim_customer)
    lines = M.lines_of(_stream(spark, sf, "lineitem"))
    for part in (None, 0, 1):
        if part is not None:
            orders.filter(half == part).write.mode("append").parquet(f"{home}/orders")
        flow.run(lines, arriving)
    return flow.fact()


PRICE_RULES = (
    Rule("product_id_present", "product_id IS NOT NULL"),
    Rule("price_bounded", "list_price < 1800"),
    Rule("before_1998", "updated_at < TIMESTAMP_NTZ'1998-01-01 00:00:00'"),
)
_BROKEN = "list_price >= 1800 OR updated_at >= TIMESTAMP '1998-01-01 00:00:00'"


@query(
    "flow_rule_counts",
    f"""WITH c AS (SELECT l_extendedprice / l_quantity AS list_price, l_shipdate AS updated_at FROM lineitem)
        SELECT 'product_id_present' AS rule_id, count(*) AS n_rows, 0 AS failures,
               count(*) FILTER (WHERE {_BROKEN}) AS quarantined FROM c
        UNION ALL SELECT 'price_bounded', count(*), count(*) FILTER (WHERE list_price >= 1800), count(*) FILTER (WHERE {_BROKEN}) FROM c
        UNION ALL SELECT 'before_1998', count(*), count(*) FILTER (WHERE updated_at >= TIMESTAMP '1998-01-01 00:00:00'),
               count(*) FILTER (WHERE {_BROKEN}) FROM c""",
)
def flow_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What a dimension's flow dropped at its boundary, and why, over all its batches."""
    changes = M.price_changes(_stream(spark, sf, "lineitem"))
    flow = flows.DimensionFlow(
        spark, scratch(spark, "bounded"), ["product_id"], "product_key", changes.schema, PRICE_RULES
    )
    flow.run(changes)
    return flows.rule_counts(spark, flow.target)


EVENT_RULES = (
    Rule("no_error", "event_type <> 'error'"),
    Rule("value_counts", "value >= 10"),
    Rule("user_known", "user_id IS NOT NULL"),
)


@query(
    "stream_expectations",
    """SELECT 'no_error' AS rule_id, count(*) AS n_rows, count(*) FILTER (WHERE event_type = 'error') AS failures,
              count(*) FILTER (WHERE event_type <> 'error' AND value >= 10) AS kept FROM events
       UNION ALL SELECT 'value_counts', count(*), count(*) FILTER (WHERE value < 10),
              count(*) FILTER (WHERE event_type <> 'error' AND value >= 10) FROM events
       UNION ALL SELECT 'user_known', count(*), 0,
              count(*) FILTER (WHERE event_type <> 'error' AND value >= 10) FROM events""",
)
def stream_expectations(spark: SparkSession, sf: str) -> DataFrame:
    """Rule counts are kept as data, beside the rows they were counted on."""
    target = scratch(spark, "judged")
    flows.judged_stream(_stream(spark, sf, "events"), target, EVENT_RULES)
    kept = spark.read.parquet(f"{target}/rows").filter("kept = 'true'").agg(F.count("*").alias("kept"))
    return (
        spark.read.parquet(f"{target}/metrics")
        .groupBy("rule_id")
        .agg(F.sum("n_rows").alias("n_rows"), F.sum("failures").alias("failures"))
        .join(kept)
    )


@query(
    "star_end_to_end",
    f"SELECT category_name, email_domain, year, {MEASURES} FROM m_star GROUP BY category_name, email_domain, year",
)
def star_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Everything as triggered streams: both dimensions first, then the fact, then a read."""
    home = scratch(spark, "endtoend")
    prices = M.price_changes(_stream(spark, sf, "lineitem"))
    product_changes = M.product_source(spark, sf, prices)
    products = flows.DimensionFlow(
        spark, f"{home}/product", ["product_id"], "product_key", product_changes.schema,
        FLOW_RULES["dim_product"],
    )
    products.run(product_changes)
    customer_changes = M.customer_source(spark, sf, M.domain_changes(_stream(spark, sf, "orders")))
    customers = flows.DimensionFlow(
        spark, f"{home}/customer", ["customer_id"], "customer_key", customer_changes.schema,
        FLOW_RULES["dim_customer"], prefer=M.CUSTOMER_PREFER,
    )
    customers.run(customer_changes)
    p, c = products.materialize(), customers.materialize()
    orders = M.order(spark, sf)
    fact = flows.FactFlow(spark, f"{home}/fact", orders, p, c)
    fact.run(M.lines_of(_stream(spark, sf, "lineitem")))
    dates = S.calendar_of(orders, "ordered_at")
    return (
        S.star_join(fact.fact(), p, c, dates)
        .groupBy("category_name", "email_domain", "year")
        .agg(
            F.count("*").alias("lines"),
            F.sum("quantity").alias("quantity"),
            F.round(F.sum("line_revenue"), 2).alias("revenue"),
        )
    )
