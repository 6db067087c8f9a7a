"""Connected components of a link table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterline.session import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable from each node that has a link.

    Each round every node of what is left takes its least neighbour, chains of such choices are shortened, and links are
    redrawn between the nodes chosen; rounds end when no link is left. Sums before shuffles keep a node of many links small.
    """
    left = stored(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct(), "links")
    found: DataFrame | None = None
    while not left.isEmpty():
        both = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        chosen = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        chosen = stored(chosen.select("node", F.least("node", "b").alias("to")), "chosen")
        for _ in range(2):
            onward = chosen.select(F.col("node").alias("to"), F.col("to").alias("next"))
            chosen = stored(chosen.join(onward, "to", "left").select("node", F.coalesce("next", "to").alias("to")), "chosen")
        ends = chosen.select("node", "to")
        if found is None:
            found = ends
        else:
            moved = ends.select(F.col("node").alias("to"), F.col("to").alias("next"))
            found = found.join(moved, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
        found = stored(found, "found")
        left = stored(
            left.join(ends.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
            .join(ends.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).where("a < b").distinct(),
            "links",
        )
    if found is None:
        return left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.select("node", F.col("to").alias("component"))
