"""The given tables read as the operational model.

Each function is a narrow projection or one pre-aggregated group-by, so filters
and column pruning reach the scans below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterline.contracts import SEQUENCE
from asterline.functions.scalars import known_name
from asterline.operators.lookup import lookup
from asterline.session import table

REGISTERED = "1995-01-01 00:00:00"


def brand_id(column: str = "p_brand"):
    return F.regexp_extract(column, "([0-9]+)", 1).cast("long")


def category(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "part")
        .select(brand_id().alias("category_id"), F.col("p_brand").alias("category_name"))
        .distinct()
    )


def product(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        brand_id().alias("category_id"),
        F.col("p_retailprice").alias("list_price"),
    )


def labelled(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Documents, and the labels that only some of them have."""
    labels = table(spark, sf, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor").alias("category_name"),
        F.col("quality").cast("int").alias("category_key"),
    )
    return table(spark, sf, "documents").select("doc_id", "source"), labels


def customer(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower("c_mktsegment"), F.lit(".test")).alias("email_domain"),
        F.expr(f"TIMESTAMP_NTZ'{REGISTERED}'").alias("registered_at"),
    )


def order(spark: SparkSession, sf: str) -> DataFrame:
    status = (
        F.when(F.col("o_orderstatus") == "O", "placed")
        .when(F.col("o_orderstatus") == "P", "shipped")
        .when(F.col("o_orderstatus") == "F", "delivered")
        .otherwise(F.col("o_orderstatus"))
    )
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("ordered_at"),
        status.alias("status"),
    )


def lines_of(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("long").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("long").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )


def order_line(spark: SparkSession, sf: str) -> DataFrame:
    return lines_of(table(spark, sf, "lineitem"))


def price_feed(spark: SparkSession, sf: str) -> DataFrame:
    """(product_id, updated_at, list_price): the greatest price per product and day."""
    return (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_partkey").alias("product_id"), F.col("l_shipdate").alias(SEQUENCE))
        .agg(F.max(F.col("l_extendedprice") / F.col("l_quantity")).alias("list_price"))
    )


def price_changes(lines: DataFrame) -> DataFrame:
    """The same feed with its duplicates, as it arrives; also from a stream."""
    return lines.select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").alias(SEQUENCE),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("list_price"),
    )


def raw_price_feed(spark: SparkSession, sf: str) -> DataFrame:
    return price_changes(table(spark, sf, "lineitem"))


def product_rows(feed: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """The feed with the product's name and its category's, folded in once.

    The feed's own clock is kept; a renamed category is no change of a product.
    """
    described = lookup(
        products.select("product_id", "product_name", "category_id"), categories, "category_id", ["category_name"]
    )
    return lookup(feed, described, "product_id", ["product_name", "category_name"]).select(
        "product_id",
        "product_name",
        known_name("category_name").alias("category_name"),
        "list_price",
        SEQUENCE,
    )


def product_source(spark: SparkSession, sf: str, feed: DataFrame | None = None) -> DataFrame:
    feed = raw_price_feed(spark, sf) if feed is None else feed
    return product_rows(feed, product(spark, sf), category(spark, sf))


def domain_changes(orders: DataFrame) -> DataFrame:
    """(customer_id, updated_at, order_id, email_domain): a domain with every order.

    Of a customer's orders on one day the last number counts.
    """
    slug = F.replace(F.lower(F.substring("o_orderpriority", 3, 100)), F.lit(" "), F.lit("-"))
    return orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias(SEQUENCE),
        F.col("o_orderkey").alias("order_id"),
        F.concat(slug, F.lit(".test")).alias("email_domain"),
    )


def customer_feed(spark: SparkSession, sf: str) -> DataFrame:
    """(customer_id, updated_at, email_domain): one row per customer and day."""
    return (
        domain_changes(table(spark, sf, "orders"))
        .groupBy("customer_id", SEQUENCE)
        .agg(F.max_by("email_domain", "order_id").alias("email_domain"))
    )


def customer_rows(feed: DataFrame, customers: DataFrame) -> DataFrame:
    """The feed with the customer's name; columns that order its messages stay."""
    names = customers.select("customer_id", "full_name")
    extra = [c for c in feed.columns if c not in {"customer_id", "email_domain", SEQUENCE}]
    return lookup(feed, names, "customer_id", ["full_name"]).select(
        "customer_id", *extra, "full_name", "email_domain", SEQUENCE
    )


def customer_source(spark: SparkSession, sf: str, feed: DataFrame | None = None) -> DataFrame:
    feed = domain_changes(table(spark, sf, "orders")) if feed is None else feed
    return customer_rows(feed, customer(spark, sf))


# What decides between two changes of a customer on one day.
CUSTOMER_PREFER = ("order_id",)


def user_feed(spark: SparkSession, sf: str) -> DataFrame:
    """(user_id, updated_at, state, value): the state changes in the event log."""
    return table(spark, sf, "events").select(
        "user_id", F.col("ts").alias(SEQUENCE), F.col("event_type").alias("state"), "value"
    )


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """(document, source, text): documents and raw pages, whole texts."""
    documents = table(spark, sf, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id")).alias("document"), "source", "text"
    )
    pages = table(spark, sf, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id")).alias("document"),
        F.lit("pages").alias("source"),
        F.col("html").alias("text"),
    )
    return documents.unionByName(pages)


# Fixed value: the first published address of its kind; with another last letter
# its checksum fails.
WALLET = "1A1zP1eP5QGefi2DMPTfTL5SLmv7DivfNa"


def record_cards(spark: SparkSession, sf: str) -> DataFrame:
    """One text per customer with identifiers the documents lack, valid and not.

    Made from the customer key: every third card has no context words, every
    second account number a wrong check, every fourth licence a wrong digit, and
    four of five wallets a wrong last letter.
    """
    k = F.col("c_custkey")

    def digits(value, width: int):
        return F.lpad(value.cast("string"), width, "0")

    word = lambda text: F.when(k % 3 != 0, F.lit(text)).otherwise(F.lit("ref"))
    d = [F.floor(k / 10**i) % 10 for i in range(6)]
    check = (d[5] + d[3] + d[1] + 2 * (d[4] + d[2] + d[0]) + F.when(k % 4 == 0, 1).otherwise(0)) % 10
    # 131400 is "DE00" in digits; 1000000 mod 97 is 27.
    rest = 98 - ((k % 97) * 27 + 131400) % 97
    control = F.when(k % 2 == 0, rest).otherwise(F.when(rest < 97, rest + 1).otherwise(rest - 1))
    return table(spark, sf, "customer").select(
        F.concat(F.lit("card-"), k).alias("document"),
        F.lit("cards").alias("source"),
        F.concat_ws(
            "\n",
            F.col("c_name"),
            F.concat(word("SSN"), F.lit(" "), digits(k % 1000, 3), F.lit("-"), digits(k % 100, 2), F.lit("-"), digits(k, 4)),
            F.concat(word("passport"), F.lit(" no "), F.lit("C"), digits(k, 8)),
            F.concat(word("driver license"), F.lit(" D"), digits(k, 10)),
            F.concat(F.lit("dea AB"), digits(k, 6), check.cast("string")),
            F.concat(F.lit("account DE"), digits(control, 2), digits(k, 18)),
            F.concat(word("phone"), F.lit(" +1 (555) 010-"), digits(k, 4)),
            F.concat(F.lit("wallet "), F.lit(WALLET[:-1]), F.when(k % 5 == 0, "a").otherwise("b")),
        ).alias("text"),
    )


# Edges of the star itself, and of the tables read on top of it.
STAR_EDGES = (
    ("oltp.product", "olap.dim_product"),
    ("oltp.category", "olap.dim_product"),
    ("oltp.customer", "olap.dim_customer"),
    ("oltp.order_line", "olap.fact_order_line"),
    ("oltp.order", "olap.fact_order_line"),
    ("olap.dim_product", "olap.fact_order_line"),
    ("olap.dim_customer", "olap.fact_order_line"),
)


def lineage_log(spark: SparkSession, sf: str) -> DataFrame:
    """(source, target, at): one read or write per event.

    A click is a run of the star that touched one of its edges; a view is a
    report of one user over the fact; a purchase is a report built on another
    user's; a signup is a write without a source; an error is an edge from a
    foreign namespace or, for every seventh event, one back into a source.
    """
    run = F.col("event_id") % len(STAR_EDGES)
    source = F.lit(None).cast("string")
    target = F.lit(None).cast("string")
    for i, (s, t) in enumerate(STAR_EDGES):
        source = F.when(run == i, s).otherwise(source)
        target = F.when(run == i, t).otherwise(target)
    kind, user = F.col("event_type"), F.col("user_id")
    report = F.concat(F.lit("mart.user_"), user)
    back = F.col("event_id") % 7 == 0
    return table(spark, sf, "events").select(
        F.when(kind == "click", source)
        .when(kind == "view", "olap.fact_order_line")
        .when(kind == "purchase", report)
        .when(kind == "error", F.when(back, "olap.fact_order_line").otherwise(F.concat(F.lit("stage.batch_"), user)))
        .alias("source"),
        F.when(kind == "click", target)
        .when(kind == "view", report)
        .when(kind == "purchase", F.concat(F.lit("mart.user_"), F.floor(user / 2)))
        .when(kind == "error", F.when(back, F.element_at(F.array(*map(F.lit, SOURCES)), (user % 5 + 1).cast("int"))).otherwise(F.lit("olap.dim_product")))
        .otherwise(report)
        .alias("target"),
        F.col("ts").alias("at"),
    )


SOURCES = ("oltp.category", "oltp.customer", "oltp.order", "oltp.order_line", "oltp.product")
