"""The star over the given tables, built once per application and folder, then read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from asterline.plans import model
from asterline.plans.star import Star, build_star, calendar_of, dim_customer, dim_product, fact_order_line, star_join, write_fact
from asterline.plans.steps import Step, run
from asterline.session import scratch, table

_BUILT: dict[tuple[str, str], Star] = {}


def dimensions(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    products = dim_product(model.product_source(spark, sf))
    customers = dim_customer(model.customer_source(spark, sf), model.CUSTOMER_PREFER)
    return products, customers


def build(spark: SparkSession, sf: str) -> Star:
    return build_star(
        spark,
        scratch(spark, "star"),
        *dimensions(spark, sf),
        model.order(spark, sf),
        model.order_line(spark, sf),
    )


def star(spark: SparkSession, sf: str) -> Star:
    key = (spark.sparkContext.applicationId, sf)
    if key not in _BUILT:
        _BUILT[key] = build(spark, sf)
    return _BUILT[key]


def joined(spark: SparkSession, sf: str) -> DataFrame:
    s = star(spark, sf)
    return star_join(s.fact_order_line, s.dim_product, s.dim_customer, s.dim_date)


#: The star as steps: each table with what it reads and how it is made.
STEPS = (
    Step(
        "olap.fact_order_line",
        ("oltp.order_line", "oltp.order", "olap.dim_product", "olap.dim_customer"),
        lambda t: fact_order_line(t["oltp.order_line"], t["oltp.order"], t["olap.dim_product"], t["olap.dim_customer"]),
        write_fact,
    ),
    Step(
        "olap.dim_product",
        ("oltp.product_price", "oltp.product", "oltp.category"),
        lambda t: dim_product(model.product_rows(t["oltp.product_price"], t["oltp.product"], t["oltp.category"])),
    ),
    Step(
        "olap.dim_customer",
        ("oltp.customer_domain", "oltp.customer"),
        lambda t: dim_customer(model.customer_rows(t["oltp.customer_domain"], t["oltp.customer"]), model.CUSTOMER_PREFER),
    ),
    Step("olap.dim_date", ("oltp.order",), lambda t: calendar_of(t["oltp.order"], "ordered_at")),
)


def operational(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The operational tables by name."""
    return {
        "oltp.category": model.category(spark, sf),
        "oltp.product": model.product(spark, sf),
        "oltp.product_price": model.raw_price_feed(spark, sf),
        "oltp.customer": model.customer(spark, sf),
        "oltp.customer_domain": model.domain_changes(table(spark, sf, "orders")),
        "oltp.order": model.order(spark, sf),
        "oltp.order_line": model.order_line(spark, sf),
    }


def build_recorded(spark: SparkSession, sf: str, log: str) -> dict[str, DataFrame]:
    """The star built by its steps, in the order that follows from what they read; what each took is appended to the log."""
    return run(spark, STEPS, operational(spark, sf), scratch(spark, "star-steps"), log)
