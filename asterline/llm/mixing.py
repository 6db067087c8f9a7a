"""Mixing sources to target weights: subset-sum budget fitting.

Every source gets a target number of tokens. Whole passes over a source come first; the rest of its
budget is a subset-sum problem over its documents, solved on counts of documents by exact token length:
each length first gives its share of most of the budget in whole documents, and a bounded-knapsack dynamic
program over lengths and their remaining counts fits what is left; what it cannot fill exactly it tries again with more left to it,
up to the whole budget, so the sum is the best there is. Which documents of a length are taken is
decided by a seeded hash, so a rerun takes the same ones.

What one task holds is a source's counts by length (its number of distinct lengths), never its documents.
Of one (source, length) only the hash slice in which the cut falls is ranked, one of 256, without texts; then every document
decides from its own hash. Only rows equal in id and text share a hash.

Null text: length 0. Null source: a source of its own, last in order. Rows with equal ids are separate documents.
An empty table gives an empty mix. A source of no tokens has target 0. Texts of any length are counted whole, where they are
read. Other columns travel in one of their own and may have any names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asterline.session import stored

WORDS = r"[^\x20\x09-\x0D]+"
SLICES = 256
#: Tokens first left to the dynamic program, in multiples of the longest document.
ROOM = 4
#: Sources and lengths up to which their cuts are broadcast: some 64 bytes each.
BROADCAST = 1_000_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def cyclic_weights(cycle: tuple[float, ...] = (3.0, 1.0, 2.0)) -> Callable[[DataFrame], DataFrame]:
    """Weights by the rank of the source: by code point, null last, the cycle repeating."""

    def weigh(sources: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
        table = F.array(*[F.lit(float(w)) for w in cycle])
        return sources.withColumn("weight", F.get(table, F.pmod(rank, F.lit(len(cycle)))))

    return weigh


def targets(sources: DataFrame, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, weight) to targets: share of all sizes by weight, none above `most` times its size.

    What exceeds a cap goes to the others by weight until no target is above its cap. Sources reach their caps in
    the order of cap / weight, so one running sum in that order finds the level. One row for each source.
    """
    w = Window.orderBy(F.col("ratio"), F.col("source").asc_nulls_first())
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    rows = (
        sources.withColumn("cap", most * F.col("source_size"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
        .withColumn("budget", share * F.sum("source_size").over(everything))
        .withColumn("used", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("budget") - F.col("used")) / F.col("left"))
    )
    # The level of the first source, in that order, that stays under its cap; later levels only rise with the caps.
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"]
    return rows.withColumn("target", F.least(F.col("cap"), F.coalesce(level * F.col("weight"), F.col("cap")))).select(
        "source", "source_size", "weight", "target"
    )


def reach(lengths, counts, goal: int, seed: int = 0):
    """(the greatest sum up to goal, how many documents of each length give it): bounded knapsack over all of them.

    Counts are split into powers of two. The set of reachable sums is one bit string, which each part shifts; the part
    that first reached a sum is kept, and leads back from the greatest. The seed orders the lengths, and so decides between
    equally good sums.
    """
    import numpy as np

    first = np.full(goal + 1, -1, np.int32)
    parts: list[tuple[int, int]] = []
    sums, all_ = 1, (1 << (goal + 1)) - 1
    for i in np.random.default_rng(seed).permutation(len(lengths)):
        n, size, step = int(counts[i]), int(lengths[i]), 1
        while n > 0 and 0 < step * size <= goal and not sums >> goal & 1:
            step = min(step, n)
            n -= step
            new = (sums << step * size) & all_ & ~sums
            if new:
                sums |= new
                row = np.frombuffer(new.to_bytes(goal // 8 + 1, "little"), np.uint8)
                held = np.flatnonzero(row)
                bits = np.unpackbits(row[held, None], axis=1, bitorder="little")
                at, bit = np.nonzero(bits)
                first[held[at] * 8 + bit] = len(parts)
            parts.append((int(i), step))
            step *= 2
    taken = np.zeros(len(counts), np.int64)
    best = at = sums.bit_length() - 1
    while at > 0:
        i, step = parts[first[at]]
        taken[i] += step
        at -= step * int(lengths[i])
    return best, taken


def fit(lengths, counts, budget: int, seed: int = 0):
    """How many documents of each length to take so that their tokens come nearest the budget from below: the best there is.

    Each length first gives its share of the budget but for a room, in whole documents, which leaves some of every length;
    the knapsack fits the room from all that are left. If it does not fill it, the room grows, up to the whole budget, where
    the knapsack alone decides.
    """
    import numpy as np

    lengths, counts = np.asarray(lengths, np.int64), np.asarray(counts, np.int64)
    total = int((lengths * counts).sum())
    if total == 0 or budget <= 0:
        return np.zeros(len(counts), np.int64)
    if budget >= total:
        return counts.copy()
    unit = int(np.gcd.reduce(lengths[counts > 0]))
    lengths, total, budget = lengths // unit, total // unit, budget // unit
    room = ROOM * int(lengths[counts > 0].max())
    while True:
        share = max(0, budget - room)
        taken = np.array([int(c) * share // total for c in counts.tolist()], np.int64)
        left = budget - int((lengths * taken).sum())
        best, more = reach(lengths, counts - taken, left, seed)
        if best == left or not share:
            return taken + more
        room *= 8


def _mixed(docs: DataFrame, weigh, share, most, seed, ident, text, source, keep: tuple[str, ...]) -> DataFrame:
    """mix_row with the columns of keep, whatever their names, and mix_id, mix_size, mix_source_size, mix_target, mix_copies."""
    rows = docs.select(
        F.struct(*keep).alias("mix_row") if keep else F.lit(None).alias("mix_row"),
        F.col(ident).alias("mix_id"),
        F.col(source).alias("mix_source"),
        n_words(F.col(text)).alias("mix_size"),
        F.xxhash64(F.lit(seed), F.col(ident), F.col(text)).alias("mix_hash"),
    ).withColumn("mix_slice", F.pmod("mix_hash", F.lit(SLICES)))
    narrow = stored(rows.drop("mix_row"), "mix-rows")
    rows = rows if keep else narrow.withColumn("mix_row", F.lit(None))
    slices = stored(
        narrow.groupBy(F.col("mix_source").alias("source"), F.col("mix_size").alias("size"), F.col("mix_slice").alias("slice"))
        .agg(F.count("*").alias("rows")), "mix-slices")
    lengths = slices.groupBy("source", "size").agg(F.sum("rows").alias("rows"))
    sources = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    goals = stored(targets(weigh(sources), share, most), "mix-targets")

    def choose(pdf):
        import numpy as np

        pdf = pdf.sort_values("size")
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        passes = int(target // size) if size else 0
        pdf["passes"] = passes
        pdf["extra"] = fit(pdf["size"].to_numpy(), pdf["rows"].to_numpy(), int(np.floor(target)) - passes * size, seed)
        return pdf[["source", "size", "source_size", "target", "passes", "extra"]]

    same = F.col("l.source").eqNullSafe(F.col("r.source"))
    chosen = stored(
        lengths.alias("l").join(goals.alias("r"), same).select("l.source", "l.size", "l.rows", "source_size", "target")
        .groupBy("source").applyInPandas(choose, "source string, size long, source_size long, target double, passes long, extra long"),
        "mix-lengths",
    )
    # Slices before the cut are taken whole, later ones are not; only rows of the cut's slice are ranked, and the last one
    # taken gives the cut's hash.
    before = Window.partitionBy("source", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.col("extra") - F.col("before")
    cut = (
        slices.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).alias("l")
        .join(chosen.where("extra > 0").alias("r"), same & (F.col("l.size") == F.col("r.size")))
        .where((inside > 0) & (inside <= F.col("rows")))
        .select(F.col("l.source").alias("source"), F.col("l.size").alias("size"), F.col("slice").alias("cut_slice"), inside.alias("inside"))
    )
    on = F.col("mix_source").eqNullSafe(F.col("source")) & (F.col("mix_size") == F.col("size")) & (F.col("mix_slice") == F.col("cut_slice"))
    length = Window.partitionBy("mix_source", "mix_size")
    ranked = narrow.join(cut, on).withColumn("rank", F.row_number().over(length.orderBy("mix_hash")))
    ranked = ranked.withColumn("cut_hash", F.max(F.when(F.col("rank") == F.col("inside"), F.col("mix_hash"))).over(length))
    # Rows of one hash are one id and text, told apart by nothing: so many of them are taken.
    ends = ranked.where("mix_hash = cut_hash").groupBy("source", "size", "cut_slice", "cut_hash").agg(
        F.count_if(F.col("rank") <= F.col("inside")).alias("cut_ties"), F.count("*").alias("cut_rows")
    )
    cuts = stored(
        chosen.alias("l").join(ends.alias("r"), same & (F.col("l.size") == F.col("r.size")), "left").select(
            F.col("l.source").alias("cut_source"), F.col("l.size").alias("cut_size"), F.col("source_size").alias("mix_source_size"),
            F.col("target").alias("mix_target"), F.col("passes").alias("mix_passes"), "cut_slice", "cut_hash", "cut_ties", "cut_rows"),
        "mix-cuts",
    )
    seen = cuts.agg(F.count("*").alias("rows"), F.count_if(F.col("cut_ties") < F.col("cut_rows")).alias("split")).first()
    if seen.rows <= BROADCAST:
        # One row for each source and length: no text needs to travel to it.
        cuts = F.broadcast(cuts)
    known = rows.join(cuts, F.col("mix_source").eqNullSafe(F.col("cut_source")) & (F.col("mix_size") == F.col("cut_size")))
    order = F.struct("mix_slice", "mix_hash")
    end = F.struct(F.col("cut_slice").alias("mix_slice"), F.col("cut_hash").alias("mix_hash"))

    def copies(frame: DataFrame, more) -> DataFrame:
        once = F.col("cut_hash").isNotNull() & more
        return frame.select("mix_row", "mix_id", "mix_size", "mix_source_size", "mix_target",
                            (F.col("mix_passes") + once.cast("long")).alias("mix_copies"))

    if not seen.split:
        return copies(known, order <= end)
    parted = F.coalesce((order == end) & (F.col("cut_ties") < F.col("cut_rows")), F.lit(False))
    among = F.row_number().over(length.orderBy("mix_hash"))
    return copies(known.where(~parted), order <= end).unionByName(copies(known.where(parted), among <= F.col("cut_ties")))


def mixed(docs: DataFrame, weigh: Callable[[DataFrame], DataFrame] | None = None, share: float = 1.5, most: float = 2.0,
          seed: int = 17, ident: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row for each row of docs: id, size, source_size, target, and taken (tokens that the mix takes of it)."""
    rows = _mixed(docs, weigh or cyclic_weights(), share, most, seed, ident, text, source, ())
    return rows.select(F.col("mix_id").alias(ident), F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                       F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"))


def taken(docs: DataFrame, weigh: Callable[[DataFrame], DataFrame] | None = None, share: float = 1.5, most: float = 2.0,
          seed: int = 17, ident: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: the rows of docs with all their columns, each as often as it is taken."""
    rows = _mixed(docs, weigh or cyclic_weights(), share, most, seed, ident, text, source, tuple(docs.columns))
    rows = rows.where("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))))
    return rows.select("mix_row.*")
