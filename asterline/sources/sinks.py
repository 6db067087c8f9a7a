"""Writing: sequenced appends, ordered batches, validated loads, tables from contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asterline.contracts import OLTP, SEQUENCE, Contract, create_statement
from asterline.operators.quality import validated

# The sequences of the initial and the change load.
INITIAL_AT = "2026-01-01 00:00:00"
CHANGE_AT = "2026-03-01 00:00:00"


def at(instant: str) -> Column:
    return F.lit(instant).cast("timestamp_ntz")


def append_sequenced(df: DataFrame, path: str, instant: str) -> None:
    """Append rows stamped with the load's sequence."""
    df.withColumn(SEQUENCE, at(instant)).write.mode("append").parquet(path)


def load_batch(df: DataFrame, log: str, batch: int, instant: str) -> None:
    """Write one batch of a change log into its own folder; a retry replaces it."""
    df.withColumn(SEQUENCE, at(instant)).write.mode("overwrite").parquet(f"{log}/batch={batch}")


def load_validated(df: DataFrame, contract: Contract, path: str, instant: str) -> None:
    """Refuse the whole load if any rule fails; nothing is written then."""
    append_sequenced(validated(df, contract), path, instant)


def create_tables(spark: SparkSession, database: str, location: str | None = None) -> dict[str, str]:
    """The operational tables, from their contracts. Safe to repeat; drops nothing."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")
    targets = {name: f"{database}.`{name}`" for name in OLTP}
    for name, target in targets.items():
        spark.sql(create_statement(OLTP[name], target))
    return targets
