"""Neighbours and positions along a key's timeline, in one plan at every size.

A window over (key ORDER BY sequence) would send a whole key to one task. So every timeline is read in pieces: a key with more
rows than a piece should hold is cut at quantiles of its own sequence, taken from a mergeable sketch over all its rows, and every
other key is one piece. Windows run over (key, piece), and what lies across a cut is carried by one row for each piece
of such a key, put among the rows at the piece's edge. One job before finds the cut points; without any the
planner drops the branches that carry, and the window is the plain one.

Cut points follow ranks, not widths, so a burst inside a long timeline is cut as finely as the rest. Rows of one (key, sequence) are
never parted; collapse copies before.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that one task may well sort.
ROWS_PER_PIECE = 2_000_000
#: Pieces of all cut keys together: beyond ROWS_PER_PIECE times this, pieces grow instead. Keys are cut if they have more rows than a
#: piece, so this bounds both the keys and the cut points that the driver collects and broadcasts, to about a megabyte, however many rows there are.
MOST_PIECES = 1 << 16
#: Pieces of one key, and size of its sketch: ranks are right to about 0.0005.
CUTS = 1 << 10
SKETCH = 1 << 12

PIECE, _KIND, _HASH, _POINTS = "_piece", "_kind", "_cut_key", "_cut_points"


def ordinal(df: DataFrame, column: str) -> Column:
    """A sequence column as a long; timestamps as microseconds."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{column}`)")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    if isinstance(kind, T.IntegralType):
        return F.col(column).cast("long")
    raise TypeError(f"{column}: {kind.simpleString()} is no sequence type")


def cut_points(df: DataFrame, keys: Sequence[str], sequence: str, rows: int | None = None) -> DataFrame | None:
    """(hash of the key, ascending cut points) of the keys with more rows than a piece holds; at most MOST_PIECES points.

    One job over the keys, combined before the shuffle, finds how many rows there are and the most of any key. None: every
    timeline is one piece, and nothing needs to be carried. Else only the rows of long timelines are sketched. Keys are told by a
    hash: two that share one are cut at the same points, which changes no result.
    """
    places = df.select(F.xxhash64(*keys).alias(_HASH), ordinal(df, sequence).alias("_at"))
    counts = places.groupBy(_HASH).agg(F.count("*").alias("_n"))
    seen = counts.agg(F.sum("_n").alias("rows"), F.max("_n").alias("most")).first()
    size = max(ROWS_PER_PIECE if rows is None else rows, -(-(seen.rows or 0) // MOST_PIECES))
    if (seen.most or 0) <= size:
        return None
    heavy = counts.where(F.col("_n") > size).select(
        _HASH, F.least(F.lit(CUTS), F.ceil(F.col("_n") / size)).cast("int").alias("_pieces")
    )
    sketches = places.join(F.broadcast(heavy), _HASH).groupBy(_HASH, "_pieces").agg(
        F.kll_sketch_agg_bigint("_at", F.lit(SKETCH)).alias("_sketch")
    )
    ranks = ", ".join(f"{i / CUTS}D" for i in range(CUTS))
    marks = sketches.selectExpr(_HASH, "_pieces", f"kll_sketch_get_quantile_bigint(_sketch, array({ranks})) AS _marks")
    points = f"array_distinct(transform(sequence(1, _pieces - 1), i -> _marks[CAST(i * {CUTS} DIV _pieces AS INT)])) AS {_POINTS}"
    return df.sparkSession.createDataFrame(marks.selectExpr(_HASH, points).collect(), f"{_HASH} long, {_POINTS} array<long>")


def in_pieces(df: DataFrame, keys: Sequence[str], sequence: str, points: DataFrame | None, cut_only: bool = False) -> DataFrame:
    """df with the number of its key's cut points at or before each row; with `cut_only` just the rows of keys that are cut."""
    if points is None:
        return df.withColumn(PIECE, F.lit(0)).where(F.lit(not cut_only))
    steps = ", ".join(str(CUTS >> i) for i in range(CUTS.bit_length()))
    # A binary search: the largest steps first, as long as the point they lead to is not beyond the row.
    found = f"""CASE WHEN {_POINTS} IS NULL THEN 0 ELSE aggregate(array({steps}), 0, (n, step) ->
        CASE WHEN n + step <= size({_POINTS}) AND get({_POINTS}, n + step - 1) <= _row_at THEN n + step ELSE n END) END AS {PIECE}"""
    keyed = df.select("*", F.xxhash64(*keys).alias("_row_key"), ordinal(df, sequence).alias("_row_at"))
    joined = keyed.join(F.broadcast(points), F.col("_row_key") == F.col(_HASH), "inner" if cut_only else "left")
    return joined.select(*df.columns, F.expr(found))


def attach(left: DataFrame, right: DataFrame, columns: Sequence[str], how: str = "left") -> DataFrame:
    """Join on null-safe equality of same-named columns, keeping them once.

    Null-safe equality still plans as a hash or merge join key. The right side
    is renamed first, so both sides may descend from the same DataFrame.
    """
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}" if c in columns else c) for c in right.columns]
    )
    on = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns))
    joined = left.join(renamed, on, how)
    return joined if how in {"left_anti", "left_semi"} else joined.drop(*[f"_r_{c}" for c in columns])


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    sequence: str,
    value: Column | str,
    name: str,
    step: str = "next",
    ties: Sequence[str] = (),
    rows: int | None = None,
) -> DataFrame:
    """Add `value` of the next or previous row of the same key; `rows` is what a piece may hold."""
    following = step == "next"
    shift = F.lead if following else F.lag
    order = [sequence, *ties]
    # The value is wrapped, so that "no neighbour" differs from "neighbour is null".
    valued = df.select("*", F.struct((F.col(value) if isinstance(value, str) else value).alias("v")).alias("_v"))
    points = cut_points(df, keys, sequence, rows)
    parts = [*keys, PIECE]
    edge = (F.min_by if following else F.max_by)("_v", F.struct(*order))
    edges = in_pieces(valued, keys, sequence, points, cut_only=True).groupBy(*parts).agg(edge.alias("_edge"))
    markers = edges.select(
        *parts,
        F.lit(1 if following else -1).alias(_KIND),
        shift("_edge").over(Window.partitionBy(*keys).orderBy(PIECE)).alias("_v"),
    )
    inside = Window.partitionBy(*parts).orderBy(_KIND, *order)
    return (
        in_pieces(valued, keys, sequence, points)
        .withColumn(_KIND, F.lit(0))
        .unionByName(markers, allowMissingColumns=True)
        .withColumn("_found", shift("_v").over(inside))
        .filter(F.col(_KIND) == 0)
        .select(*df.columns, F.col("_found.v").alias(name))
    )


def with_position(df: DataFrame, keys: Sequence[str], sequence: str, name: str, rows: int | None = None) -> DataFrame:
    """Add the row's position within its key, from zero."""
    points = cut_points(df, keys, sequence, rows)
    parts = [*keys, PIECE]
    before = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    markers = (
        in_pieces(df, keys, sequence, points, cut_only=True)
        .groupBy(*parts)
        .count()
        .select(*parts, F.lit(-1).alias(_KIND), (F.coalesce(F.sum("count").over(before), F.lit(0)) - 1).alias("_offset"))
    )
    inside = Window.partitionBy(*parts).orderBy(_KIND, sequence)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Where there is a marker it comes first and is row 1 itself.
    place = F.row_number().over(inside) - 1 + F.coalesce(F.max("_offset").over(running), F.lit(0))
    return (
        in_pieces(df, keys, sequence, points)
        .withColumn(_KIND, F.lit(0))
        .unionByName(markers, allowMissingColumns=True)
        .withColumn(name, place.cast("long"))
        .filter(F.col(_KIND) == 0)
        .select(*df.columns, name)
    )


def last_known(
    df: DataFrame, keys: Sequence[str], sequence: str, value: str, name: str, ties: Sequence[str] = (), rows: int | None = None
) -> DataFrame:
    """Add the last `value` that is not null up to each row of the same key, the row's own included."""
    points = cut_points(df, keys, sequence, rows)
    parts, order = [*keys, PIECE], [sequence, *ties]
    before = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    known = F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order)))
    tails = in_pieces(df, keys, sequence, points, cut_only=True).groupBy(*parts).agg(known.alias("_tail"))
    markers = tails.select(*parts, F.lit(-1).alias(_KIND), F.last("_tail", ignorenulls=True).over(before).alias(value))
    frame = (
        Window.partitionBy(*parts).orderBy(_KIND, *order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        in_pieces(df, keys, sequence, points)
        .withColumn(_KIND, F.lit(0))
        .unionByName(markers, allowMissingColumns=True)
        .withColumn(name, F.last(value, ignorenulls=True).over(frame))
        .filter(F.col(_KIND) == 0)
        .select(*df.columns, name)
    )
