"""Building the star: versioned dimensions, calendar, fact, Unknown members."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from asterline.contracts import (
    END,
    FLOW_RULES,
    SEQUENCE,
    START,
    UNKNOWN_KEY,
    UNKNOWN_NAME,
)
from asterline.functions.scalars import date_key, known_key, line_revenue
from asterline.operators.asof import asof_join
from asterline.operators.quality import keep
from asterline.operators.scd2 import versions
from asterline.operators.surrogate import assign_keys
from asterline.operators.timeline import with_neighbour
from asterline.session import moved, passing, passing_path, removed, stored

UNKNOWN_SINCE = "1900-01-01 00:00:00"

#: Large tables are made in slices by a hash, one after the other, so that the shuffles of one slice are all that lies on disk at once.
#: Rows that make a slice of their own, and the most slices: beyond, slices grow.
SLICE_ROWS = 1 << 20
MOST_SLICES = 16
SLICE = "_slice"


def dimension(
    source: DataFrame, name: str, key: str, surrogate: str, prefer: Sequence[str] = ()
) -> DataFrame:
    """Row rules, then versions, then one surrogate key per version.

    The source is the feed as it arrives: its duplicates are dropped in the
    window that finds the versions, without an aggregate of their own.
    """
    kept = keep(source, FLOW_RULES[name])
    return assign_keys(versions(kept, [key], prefer=prefer), [key], SEQUENCE, surrogate)


def dim_product(source: DataFrame, prefer: Sequence[str] = ()) -> DataFrame:
    return dimension(source, "dim_product", "product_id", "product_key", prefer)


def dim_customer(source: DataFrame, prefer: Sequence[str] = ()) -> DataFrame:
    return dimension(source, "dim_customer", "customer_id", "customer_key", prefer)


def with_unknown(dim: DataFrame) -> DataFrame:
    """Add the Unknown member: keys -1, names Unknown, price 0, always valid."""
    values = []
    for f in dim.schema.fields:
        kind = f.dataType.simpleString()
        if f.name in {END, "valid_to"}:
            value = F.lit(None)
        elif kind == "timestamp_ntz":
            value = F.expr(f"TIMESTAMP_NTZ'{UNKNOWN_SINCE}'")
        elif kind == "string":
            value = F.lit(UNKNOWN_NAME)
        elif kind == "boolean":
            value = F.lit(True)
        elif kind == "double":
            value = F.lit(0.0)
        else:
            value = F.lit(UNKNOWN_KEY)
        values.append(value.cast(f.dataType).alias(f.name))
    member = dim.sparkSession.range(0, 1, 1, 1).select(*values)
    return dim.unionByName(member)


def calendar(spark: SparkSession, bounds: DataFrame) -> DataFrame:
    """One row per day between `first` and `last` of a one-row frame."""
    day = bounds.select(
        F.explode(F.sequence(F.to_date("first"), F.to_date("last"), F.expr("INTERVAL 1 DAY"))).alias("d")
    )
    return day.select(
        date_key("d").cast("long").alias("date_key"),
        F.col("d").cast("timestamp_ntz").alias("calendar_date"),
        F.year("d").cast("long").alias("year"),
        F.quarter("d").cast("long").alias("quarter"),
        F.month("d").cast("long").alias("month"),
        F.dayofmonth("d").cast("long").alias("day_of_month"),
        F.dayofweek("d").isin(1, 7).alias("is_weekend"),
    )


def calendar_of(df: DataFrame, at: str) -> DataFrame:
    return calendar(df.sparkSession, df.agg(F.min(at).alias("first"), F.max(at).alias("last")))


def resolved_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their customer's version.

    The order alone decides it, so it is resolved before the lines are joined:
    on fewer rows, and without a second shuffle of the lines.
    """
    return asof_join(
        orders.select("order_id", "customer_id", "ordered_at"),
        customers,
        "customer_id",
        "ordered_at",
        ["customer_key"],
    )


def fact_columns(resolved: DataFrame) -> DataFrame:
    """Keys and additive measures, Unknown where nothing was found."""
    return resolved.select(
        "order_id",
        "line_number",
        known_key("customer_key").alias("customer_key"),
        known_key("product_key").alias("product_key"),
        date_key("ordered_at").alias("date_key"),
        "quantity",
        "unit_price",
        line_revenue().alias("line_revenue"),
    )


def fact_rows(resolved: DataFrame) -> DataFrame:
    return keep(fact_columns(resolved), FLOW_RULES["fact_order_line"])


def fact_order_line(
    lines: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame
) -> DataFrame:
    """Lines resolved to the versions true when the order was placed.

    Lines and orders grow together, so neither is ever a small side: they are
    merged, also where a compressed file would look small enough to broadcast. Orders that have a customer_key are resolved already.
    """
    known = orders if "customer_key" in orders.columns else resolved_orders(orders, customers)
    placed = lines.join(known.hint("merge"), "order_id")
    return fact_rows(asof_join(placed, products, "product_id", "ordered_at", ["product_key"]))


def write_fact(fact: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Partitioned by day; rebalanced at run time so that a busy day is split
    over several tasks and quiet days do not leave one small file per task."""
    fact.hint("rebalance", "date_key").write.mode(mode).partitionBy("date_key").parquet(path)


def slices_for(rows: int) -> int:
    return max(1, min(MOST_SLICES, -(-rows // SLICE_ROWS)))


def slice_of(key: str, slices: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")


def in_slice(df: DataFrame, key: str, slices: int, i: int) -> DataFrame:
    return df if slices == 1 else df.where(slice_of(key, slices) == i)


def versions_in_slice(versions: DataFrame, rows: DataFrame, key: str, slices: int, i: int) -> DataFrame:
    """The versions that rows of a slice can have: all, where equal keys of the two may have different hashes."""
    kinds = {df.schema[key].dataType.simpleString() for df in (versions, rows)}
    return in_slice(versions, key, slices, i) if len(kinds) == 1 and kinds <= {"bigint", "int", "string"} else versions


def write_part(rows: DataFrame, parts: str, slices: int) -> None:
    """Add the fact rows of one slice of products, laid apart by slices of days."""
    rows.withColumn(SLICE, slice_of("date_key", slices)).write.mode("append").partitionBy(SLICE).parquet(parts)


def write_days(rows: DataFrame, parts: str, path: str, slices: int) -> None:
    """Write the fact from its parts, one slice of days after the other; each day lies in one slice, and a slice goes once written.

    The days of all slices come into place together.
    """
    spark, (folder, name) = rows.sparkSession, path.rsplit("/", 1)
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    try:
        for i in range(slices):
            write_fact(rows.where(F.col(SLICE) == i).drop(SLICE), hidden, "append")
            removed(spark, f"{parts}/{SLICE}={i}")
        moved(spark, hidden, path)
    finally:
        removed(spark, hidden)


def build_fact(
    spark: SparkSession, lines: DataFrame, orders: DataFrame, products: DataFrame, customers: DataFrame, path: str
) -> None:
    """The fact, written by day: lines and versions in slices of products, then the days."""
    with passing(spark):
        known = stored(resolved_orders(orders, customers), "star-orders")
        slices, parts = slices_for(lines.count()), passing_path(spark, "star-parts")
        for i in range(slices):
            with passing(spark):
                own = in_slice(lines, "product_id", slices, i)
                fact = fact_order_line(own, known, versions_in_slice(products, own, "product_id", slices, i), customers)
                if slices == 1:
                    write_fact(fact, path)
                    return
                write_part(fact, parts, slices)
        laid = StructType([*fact.schema.fields, StructField(SLICE, IntegerType())])
        write_days(spark.read.schema(laid).parquet(parts), parts, path, slices)


@dataclass
class Star:
    dim_product: DataFrame
    dim_customer: DataFrame
    dim_date: DataFrame
    fact_order_line: DataFrame


def with_stored_keys(dim: DataFrame, key: str, surrogate: str, before: DataFrame) -> DataFrame:
    """A dimension whose versions keep the numbers they had before; only new ones are numbered."""
    return assign_keys(dim.drop(surrogate), [key], SEQUENCE, surrogate, stored=before)


def build_star(
    spark: SparkSession, target: str, products: DataFrame, customers: DataFrame, orders: DataFrame, lines: DataFrame,
    before: Star | None = None,
) -> Star:
    """Dimensions before the fact; each table is written once and read back.

    With the star built `before`, in another folder, every version that it holds keeps its key, so facts written with it still join.

    The dimensions are read twice by the fact (to measure and to join), and a
    written table also survives a lost executor.
    """

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{target}/{name}")
        return spark.read.parquet(f"{target}/{name}")

    if before is not None:
        products = with_stored_keys(products, "product_id", "product_key", before.dim_product)
        customers = with_stored_keys(customers, "customer_id", "customer_key", before.dim_customer)
    with passing(spark):
        products, customers = written(products, "dim_product"), written(customers, "dim_customer")
        dates = written(calendar_of(orders, "ordered_at"), "dim_date")
        build_fact(spark, lines, orders, products, customers, f"{target}/fact_order_line")
    fact = spark.read.parquet(f"{target}/fact_order_line")
    return Star(products, customers, dates, fact)


def star_join(fact: DataFrame, products: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact to every dimension on surrogate keys; inner, because Unknown is a member."""
    p = with_unknown(products.select("product_key", "product_name", "category_name"))
    c = with_unknown(customers.select("customer_key", "email_domain"))
    d = dates.select("date_key", "year", "quarter", "month")
    return fact.join(p, "product_key").join(c, "customer_key").join(d, "date_key")


def interval_check(dim: DataFrame, key: str) -> DataFrame:
    """Each version with its successor's start and whether the two abut."""
    marked = with_neighbour(dim, [key], START, START, "next_start")
    return marked.withColumn("abuts", F.col("next_start").eqNullSafe(F.col(END)))
