"""Lookups and referential checks between tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(left: DataFrame, table: DataFrame, on: str, take: Sequence[str]) -> DataFrame:
    """Left lookup on an equal key; also with a streaming left side.

    No hint: Spark broadcasts the table while it is below its own threshold and
    otherwise merges, with hot keys split by the adaptive skew join.
    """
    return left.join(table.select(on, *take), on, "left")


def dangling(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose reference points nowhere."""
    parents = parent.select(F.col(parent_key).alias("_parent"))
    return child.join(parents, F.col(child_key) == F.col("_parent"), "left_anti")


def unused(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str) -> DataFrame:
    """Parents no child refers to."""
    return dangling(parent, child, parent_key, child_key)


def integrity(references: dict[str, tuple[DataFrame, DataFrame, str, str]]) -> DataFrame:
    """(reference, n_rows, dangling) for each named child-to-parent reference.

    Child keys are counted before the join, so a hot key is one row in it.
    """
    result = None
    for name, (child, parent, child_key, parent_key) in references.items():
        counted = child.groupBy(F.col(child_key).alias("_child")).agg(F.count("*").alias("_n"))
        parents = parent.select(F.col(parent_key).alias("_parent")).distinct()
        row = (
            counted.join(parents, F.col("_child") == F.col("_parent"), "left")
            .agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
                F.coalesce(F.sum(F.when(F.col("_parent").isNull(), F.col("_n"))), F.lit(0)).alias(
                    "dangling"
                ),
            )
            .select(F.lit(name).alias("reference"), "n_rows", "dangling")
        )
        result = row if result is None else result.unionByName(row)
    return result
