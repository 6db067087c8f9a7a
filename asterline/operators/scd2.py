"""Slowly changing dimension type 2 from an append-only change feed.

Versions are derived, never updated in place: a version starts at its own
sequence and ends where the next one of the same key starts. Arrival order,
duplicates, replays and late rows therefore cannot change the outcome.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterline.contracts import END, SEQUENCE, START
from asterline.operators.timeline import attach, with_neighbour


def _values(df: DataFrame, keys: Sequence[str], sequence: str, prefer: Sequence[str]) -> list[str]:
    """The columns that decide between rows of one (key, sequence), in order."""
    rest = [c for c in df.columns if c not in {*keys, sequence, *prefer}]
    return [*prefer, *rest]


def collapse(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str = SEQUENCE,
    prefer: Sequence[str] = (),
) -> DataFrame:
    """One row per (key, sequence); on a conflict the greatest values win.

    Combined on the map side, so a hot group of copies never travels.
    """
    values = _values(changes, keys, sequence, prefer)
    if not values:
        return changes.dropDuplicates([*keys, sequence])
    best = changes.groupBy(*keys, sequence).agg(F.max(F.struct(*values)).alias("_best"))
    return best.select(
        *[F.col(f"_best.{c}").alias(c) if c in values else F.col(c) for c in changes.columns]
    )


def versions(
    changes: DataFrame,
    keys: Sequence[str],
    sequence: str = SEQUENCE,
    rows_per_piece: int | None = None,
    unique: bool = False,
    prefer: Sequence[str] = (),
) -> DataFrame:
    """Every version of every key, with its half-open validity interval.

    `unique` says the feed already holds one row per (key, sequence), e.g.
    because it comes out of an aggregate on exactly these columns. Otherwise the
    row with the greatest values wins, on the map side first; `prefer` names columns to compare first,
    such as the number of the message, which are not part of the version.
    """
    feed = changes if unique else collapse(changes, keys, sequence, prefer)
    following = with_neighbour(feed, keys, sequence, sequence, END, rows=rows_per_piece)
    kept = [c for c in changes.columns if c not in prefer]
    return following.select(*kept, F.col(sequence).alias(START), END)


def current(dimension: DataFrame) -> DataFrame:
    return dimension.filter(F.col(END).isNull())


def as_of(dimension: DataFrame, instant: Column) -> DataFrame:
    """The versions true at one instant."""
    return dimension.filter(
        (F.col(START) <= instant) & (F.col(END).isNull() | (F.col(END) > instant))
    )


def reader_view(dimension: DataFrame) -> DataFrame:
    """The stored interval under the names a reader of the dimension knows."""
    plain = [c for c in dimension.columns if c not in {SEQUENCE, START, END}]
    return dimension.select(
        *plain,
        F.col(START).alias("valid_from"),
        F.col(END).alias("valid_to"),
        F.col(END).isNull().alias("is_current"),
    )


def changed_only(
    feed: DataFrame, keys: Sequence[str], tracked: Sequence[str], sequence: str = SEQUENCE
) -> DataFrame:
    """Drop rows whose tracked values equal those of the row before."""
    now = F.struct(*tracked)
    # "is not the first row" is kept beside the values: a null value is a value.
    marked = with_neighbour(feed, keys, sequence, F.struct(now.alias("t")), "_before", "previous")
    return marked.filter(
        F.col("_before").isNull() | ~F.col("_before.t").eqNullSafe(F.struct(*tracked))
    ).select(*feed.columns)


def changed_against(
    batch: DataFrame, state: DataFrame, keys: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Rows of a batch that are new or differ from the stored state."""
    b, s = batch.alias("b"), state.select(*keys, *tracked).alias("s")
    different = F.lit(False)
    for column in tracked:
        different = different | ~F.col(f"b.{column}").eqNullSafe(F.col(f"s.{column}"))
    absent = F.col(f"s.{keys[0]}").isNull()
    on = [F.col(f"b.{k}") == F.col(f"s.{k}") for k in keys]
    return b.join(s, on, "left").filter(absent | different).select("b.*")


def unseen(batch: DataFrame, log: DataFrame, keys: Sequence[str], sequence: str = SEQUENCE) -> DataFrame:
    """Rows whose (key, sequence) the log does not hold yet."""
    columns = [*keys, sequence]
    return attach(batch, log.select(*columns), columns, "left_anti")
