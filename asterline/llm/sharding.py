"""Sharding: contiguous shards of least largest size over ordered atomic groups.

Rows with equal texts are one atomic group; groups are ordered by the hash of their text. The smallest
feasible capacity is found by binary search, each candidate checked by filling shards greedily in that order,
and the order is cut there. Cuts are hash values, so a row finds its shard from its own text: no join, no
shuffle of texts.

The search never holds all groups. It starts from 2**14 hash ranges and their sizes; ranges in which a cut can fall for
any capacity still possible are split into finer ranges until those hold one group each, the others stay whole.
What one row holds is bounded by the number of shards, not by the rows, and the answer is that of a
search over all single groups.

Null text: a group of its own, 0 bytes. Empty table: no cuts, no rows. Null ids, repeated rows
and extra columns are kept as they are; every row gets one shard and one slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asterline.session import stored

OVERHEAD = 8
FIRST_BITS = 14
MORE_BITS = 10

# Greedy filling of `atoms` (ordered sizes) with capacity `c`: the number of shards.
_FILLED = """aggregate(atoms, named_struct('n', 1, 'load', 0L), (s, a) ->
    if(s.load + a.size > {c}, named_struct('n', s.n + 1, 'load', a.size),
       named_struct('n', s.n, 'load', s.load + a.size)), s -> s.n)"""

# Halving [lo, hi] until one capacity is left; no atom is larger than lo.
_SMALLEST = f"""aggregate(sequence(1, 63), named_struct('lo', floor_, 'hi', total), (r, i) ->
    if(r.lo >= r.hi, r, if({_FILLED.format(c="(r.lo + (r.hi - r.lo) div 2)")} <= {{shards}},
       named_struct('lo', r.lo, 'hi', r.lo + (r.hi - r.lo) div 2),
       named_struct('lo', r.lo + (r.hi - r.lo) div 2 + 1, 'hi', r.hi))), r -> r.lo)"""

# Where each cut can lie, in bytes before it: the least over all capacities >= least, the most over all <= capacity.
_EARLIEST = """aggregate(atoms, named_struct('at', 0L, 'from', 0L, 'cuts', array(0L)), (s, a) ->
    if(s.at + a.size > s.from + least, named_struct('at', s.at + a.size, 'from', s.at, 'cuts', s.cuts || array(s.at)),
       named_struct('at', s.at + a.size, 'from', s.from, 'cuts', s.cuts)), s -> s.cuts)"""
_LATEST = """aggregate(atoms, named_struct('at', 0L, 'from', 0L, 'cuts', array(0L)), (s, a) ->
    if(s.at + a.size >= s.from + capacity,
       named_struct('at', s.at + a.size, 'from', s.at + a.size, 'cuts', s.cuts || array(s.at + a.size)),
       named_struct('at', s.at + a.size, 'from', s.from, 'cuts', s.cuts)), s -> s.cuts)"""

# From the end: rests[k] is the least number of bytes before a rest that k shards can hold.
_RESTS = """aggregate(reverse(atoms), named_struct('at', total, 'to', total, 'cuts', array(total)), (s, a) ->
    if(s.to - (s.at - a.size) > capacity, named_struct('at', s.at - a.size, 'to', s.at, 'cuts', s.cuts || array(s.at)),
       named_struct('at', s.at - a.size, 'to', s.to, 'cuts', s.cuts)), s -> s.cuts || array(0L))"""

# Cut before an atom that would burst the capacity, or at the atom nearest an even share of what is left.
_CUT = """aggregate(atoms, named_struct('at', 0L, 'from', 0L, 'edge', CAST(NULL AS BIGINT), 'cuts', array_remove(array(0L), 0L)),
    (s, a) -> if(s.edge IS NOT NULL AND size(s.cuts) < {shards} - 1 AND (s.at + a.size - s.from > capacity OR (
        s.at > s.from AND s.at >= get(rests, least({shards} - 1 - size(s.cuts), size(rests) - 1)) AND
        2 * s.at + a.size > 2 * (s.from + (total - s.from) / ({shards} - size(s.cuts))))),
      named_struct('at', s.at + a.size, 'from', s.at, 'edge', a.edge, 'cuts', s.cuts || array(s.edge)),
      named_struct('at', s.at + a.size, 'from', s.from, 'edge', a.edge, 'cuts', s.cuts)), s -> s.cuts)"""


def text_bytes(text):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def measured(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """A narrow row for each row: id, size, checksum, hash of the text, and a number of its own."""
    return docs.select(
        F.col(ident),
        (text_bytes(F.col(text)) + OVERHEAD).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(text)).alias("atom"),
        F.monotonically_increasing_id().alias("row"),
    )


def _ranges(groups: DataFrame, bits: int) -> DataFrame:
    return groups.groupBy(F.shiftright("atom", 64 - bits).alias("block")).agg(
        F.max("atom").alias("edge"),
        F.sum("size").alias("size"),
        F.count("*").alias("members"),
        F.max("size").alias("biggest"),
    )


def _searched(atoms: DataFrame, shards: int) -> DataFrame:
    """One row: ordered atoms, bounds, the smallest capacity for these atoms."""
    row = atoms.agg(
        F.sort_array(F.collect_list(F.struct("edge", "size", "members", "block", "bits"))).alias("atoms"),
        F.sum("size").alias("total"),
        F.max("biggest").alias("biggest"),
        F.max("size").alias("floor_"),
    ).where("total IS NOT NULL")
    row = row.withColumn("least", F.expr(f"greatest(biggest, CAST(ceil(total / {shards}) AS BIGINT))"))
    row = row.withColumn("floor_", F.greatest("floor_", "least"))
    return row.withColumn("capacity", F.expr(_SMALLEST.format(shards=shards)))


def capacity_and_cuts(groups: DataFrame, shards: int) -> DataFrame:
    """One row (capacity, cuts): the smallest capacity and the last hash of each shard but the last.

    groups: (atom, size), one row for each atomic group.
    """
    groups = groups.select("atom", "size")
    bits = FIRST_BITS
    atoms = stored(_ranges(groups, bits).withColumn("bits", F.lit(bits)), "shard-ranges")
    while True:
        found = stored(_searched(atoms, shards), "shard-search")
        placed = (
            found.withColumn("early", F.expr(_EARLIEST))
            .withColumn("late", F.expr(_LATEST))
            .selectExpr("early", "late", "inline(atoms)")
            .withColumn("to", F.sum("size").over(Window.orderBy("edge")))
            .withColumn("split", F.expr("""members > 1 AND exists(zip_with(early, late, (e, l) -> struct(e, l)), w ->
                coalesce(w.e, 0) <= to AND coalesce(w.l, to) >= to - size)"""))
        )
        finer = stored(placed.where("split").select("block", "bits"), "shard-finer")
        if bits >= 64 or finer.isEmpty():
            break
        wide, bits = bits, min(64, bits + MORE_BITS)
        inside = finer.where(F.col("bits") == wide).select("block")
        parts = _ranges(
            groups.withColumn("block", F.shiftright("atom", 64 - wide)).join(inside, "block", "left_semi").drop("block"), bits
        ).withColumn("bits", F.lit(bits))
        atoms = stored(atoms.join(finer, ["block", "bits"], "left_anti").unionByName(parts), "shard-ranges")
    return (
        found.withColumn("rests", F.expr(_RESTS)).withColumn("cuts", F.expr(_CUT.format(shards=shards))).select("capacity", "cuts")
    )


def with_shard(rows: DataFrame, cuts: list[int]) -> DataFrame:
    """The shard of each row, from the hash of its text alone (column atom)."""
    if not cuts:
        return rows.withColumn("shard", F.lit(0))
    return rows.withColumn("shard", sum((F.col("atom") > F.lit(c)).cast("int") for c in cuts))


def with_slot(rows: DataFrame) -> DataFrame:
    """Numbers from 0 without a gap inside each shard.

    A shard is numbered in pieces, one for each part of the input: the rows of a piece by a window of their own,
    the pieces one after another by their counts.
    """
    rows = rows.withColumn("piece", F.shiftright("row", 33))
    counts = rows.groupBy("shard", "piece").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "piece", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "piece").orderBy("row")
    return (
        rows.withColumn("n", F.row_number().over(inside) - 1)
        .join(starts, ["shard", "piece"])
        .withColumn("slot", F.col("start") + F.col("n"))
        .drop("piece", "start", "n")
    )


def cuts_of(docs: DataFrame, shards: int, text: str = "text") -> list[int]:
    """The cuts for all rows of docs; with `with_shard` they also place rows whose columns are still whole."""
    rows = docs.select(F.xxhash64(text).alias("atom"), (text_bytes(F.col(text)) + OVERHEAD).alias("size"))
    return _cuts(rows, shards)


def _cuts(rows: DataFrame, shards: int) -> list[int]:
    groups = stored(rows.groupBy("atom").agg(F.sum("size").alias("size")), "shard-groups")
    found = capacity_and_cuts(groups, shards).first()
    return list(found.cuts) if found else []


def sharded(docs: DataFrame, shards: int = 24, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's shard and slot: id, size, text_crc32, shard, slot."""
    rows = stored(measured(docs, ident, text), "shard-rows")
    placed = with_slot(with_shard(rows, _cuts(rows, shards)))
    return placed.select(ident, "size", "text_crc32", "shard", F.col("slot").cast("long"))
