"""Hash-chained audit records as a table, many chains at a time.

An entry's hash covers the hash before it, so a chain is one chain at every length and a new load continues the
stored one from its tail. Building streams each chain through one task without holding it; that order is the
nature of a hash chain, and a load costs only its new entries. Verifying has no order: every
entry is checked against the entry one place before it, joined by (chain, place), so a long chain spreads.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterline.functions.scalars import (
    GENESIS,
    entry_hash,
    entry_prefix,
    entry_suffix,
)
from asterline.operators.timeline import with_position
# The fold travels with its task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ENTRY = "chain_id string, sequence long, previous_hash string, entry_hash string, machine string, payload string"


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Carry the last hash through rows sorted by chain and sequence; a chain starts from its `_tail`."""
    chain, last = None, GENESIS
    for batch in batches:
        previous, hashes = [], []
        for c, tail, prefix, suffix in zip(batch["chain_id"], batch["_tail"], batch["_prefix"], batch["_suffix"]):
            if c != chain:
                chain, last = c, tail
            previous.append(last)
            last = hashlib.sha256((prefix + last + suffix).encode()).hexdigest()
            hashes.append(last)
        out = batch[["chain_id", "sequence", "machine", "payload"]].copy()
        out.insert(2, "previous_hash", previous)
        out.insert(3, "entry_hash", hashes)
        yield out


def build(entries: DataFrame, order: str, stored: DataFrame | None = None) -> DataFrame:
    """Chain (chain_id, machine, payload) rows in `order`; after the stored entries of their chain, else from zero.

    Returns the new entries only: they are appended to the stored ones.
    """
    named = entries.withColumn("chain_id", F.col("chain_id").cast("string"))
    numbered = with_position(named, ["chain_id"], order, "sequence")
    if stored is None:
        numbered = numbered.withColumn("_tail", F.lit(GENESIS))
    else:
        tails = stored.groupBy("chain_id").agg(
            F.max_by("entry_hash", "sequence").alias("_last"), (F.max("sequence") + 1).alias("_length")
        )
        numbered = numbered.join(tails, "chain_id", "left").withColumns(
            {"sequence": F.col("sequence") + F.coalesce("_length", F.lit(0)), "_tail": F.coalesce("_last", F.lit(GENESIS))}
        )
    prepared = numbered.select(
        "chain_id",
        F.col("sequence").cast("long").alias("sequence"),
        "machine",
        "payload",
        "_tail",
        entry_prefix("machine", "payload").alias("_prefix"),
        entry_suffix("sequence").alias("_suffix"),
    )
    return (
        prepared.repartition("chain_id").sortWithinPartitions("chain_id", "sequence").mapInPandas(_fold, _ENTRY)
    )


def forks(log: DataFrame) -> DataFrame:
    """(chain_id, sequence, writers): places that more than one entry claims, as two loads do that continue the same tail."""
    return log.groupBy("chain_id", "sequence").agg(F.count("*").alias("writers")).where("writers > 1")


def appended(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The stored entries with new ones after them.

    A place that is taken, a gap, and an entry that does not continue the stored tail stop the query: the load was built on a tail
    that another one has moved, and has to be built again.
    """
    tails = stored.groupBy("chain_id").agg(F.max_by("entry_hash", "sequence").alias("_last"), F.max("sequence").alias("_at"))
    first = new.groupBy("chain_id").agg(F.min_by("previous_hash", "sequence").alias("_previous"), F.min("sequence").alias("_start"))
    met = first.join(tails, "chain_id", "left").select(
        F.col("chain_id").alias("_chain"),
        ((F.col("_start") == F.coalesce(F.col("_at") + 1, F.lit(0))) & (F.col("_previous") == F.coalesce("_last", F.lit(GENESIS)))).alias("_fits"),
    )
    held = new.join(met, F.col("chain_id") == F.col("_chain"))
    checked = F.when(F.col("_fits"), F.col("entry_hash")).otherwise(
        F.raise_error(F.concat(F.lit("not built on the tail of chain "), F.col("chain_id")))
    )
    return stored.unionByName(held.withColumn("entry_hash", checked).select(*new.columns))


def verify(log: DataFrame, line: str, chains: DataFrame | None = None) -> DataFrame:
    """Walk each chain in log order and report its first break.

    (chain_id, entries, intact, broken_at, detail); broken_at is -1 when intact. A missing value is a break like a wrong
    one. Chains listed in `chains` but without entries are intact and empty.
    """
    fields = ("sequence", "previous_hash", "entry_hash", "machine", "payload")
    log = log.select("chain_id", F.col(line).alias("_line"), *fields)
    placed = with_position(log, ["chain_id"], "_line", "position")
    before = placed.select("chain_id", (F.col("position") + 1).alias("position"), F.col("entry_hash").alias("_last"))
    linked = placed.join(before, ["chain_id", "position"], "left").withColumn(
        "_before", F.when(F.col("position") == 0, GENESIS).otherwise(F.col("_last"))
    )
    own = entry_hash("machine", "payload", F.col("previous_hash"), "sequence")
    # Fixed texts of the three breaks.
    detail = (
        F.when(
            ~F.col("sequence").eqNullSafe(F.col("position")),
            F.concat_ws(" ", F.lit("sequence"), F.coalesce(F.col("sequence").cast("string"), F.lit("none")),
                        F.lit("found at position"), "position"),
        )
        .when(
            F.col("_before").isNotNull() & ~F.col("previous_hash").eqNullSafe(F.col("_before")) | F.col("previous_hash").isNull(),
            "previous_hash does not match the preceding record",
        )
        .when(
            own.isNull() | ~own.eqNullSafe(F.col("entry_hash")), "the record's contents do not match its hash"
        )
    )
    walked = linked.select("chain_id", "position", detail.alias("_detail"))
    at = F.when(F.col("_detail").isNotNull(), F.col("position"))
    result = walked.groupBy("chain_id").agg(
        F.count("*").alias("entries"),
        F.min(at).alias("_at"),
        F.min_by("_detail", at).alias("_why"),
    )
    if chains is not None:
        result = chains.select(F.col("chain_id").cast("string").alias("chain_id")).distinct().join(
            result, "chain_id", "left"
        )
    return result.select(
        "chain_id",
        F.coalesce("entries", F.lit(0)).alias("entries"),
        F.col("_at").isNull().alias("intact"),
        F.coalesce("_at", F.lit(-1)).alias("broken_at"),
        F.coalesce(
            "_why", F.when(F.col("entries").isNull(), "empty ledger").otherwise("chain verifies")
        ).alias("detail"),
    )
