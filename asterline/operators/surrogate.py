"""Surrogate keys: one per version, unique, reproducible, without a global sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asterline.operators.timeline import attach, ordinal

# Far more buckets than tasks, so buckets stay small however large the table is.
BUCKETS = 1 << 16


def bucket_of(df: DataFrame, keys: Sequence[str], sequence: str) -> Column:
    """A digest bucket over (key, sequence).

    The pair is unique per version, so a key with a third of all versions is
    spread over all buckets like any other row.
    """
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], ordinal(df, sequence))
    return F.conv(F.substring(F.md5(text), 1, 4), 16, 10).cast("long")


def assign_keys(
    versions: DataFrame,
    keys: Sequence[str],
    sequence: str,
    name: str,
    after: int = 0,
    most: int | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Number the versions above `after`; the n-th row of bucket b gets n * BUCKETS + b.

    Interleaving the buckets makes the numbers unique without counting any
    bucket first. Like an identity column, the keys differ but carry no order.

    With `stored` (keys, sequence, name) a version that has a number keeps it, and new ones are numbered above the greatest stored
    one: a rebuild never renumbers. `most` is the room for numbers; a version beyond it is an error.
    """
    if stored is not None:
        had = stored.select(*keys, sequence, name)
        greatest = had.agg(F.max(name)).first()[0] or 0
        known = attach(versions, had, [*keys, sequence], "inner")
        fresh = attach(versions, had, [*keys, sequence], "left_anti")
        numbered = assign_keys(fresh, keys, sequence, name, max(after, greatest), most)
        return known.select(name, *versions.columns).unionByName(numbered)
    bucketed = versions.withColumn("_bucket", bucket_of(versions, keys, sequence))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys, sequence))
    number = (rank.cast("long") - 1) * BUCKETS + F.col("_bucket") + 1
    if most is not None:
        number = F.when(number <= most, number).otherwise(F.raise_error(F.lit(f"more than {most} numbers needed")))
    return bucketed.select((number + F.lit(after)).alias(name), *versions.columns)
