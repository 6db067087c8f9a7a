"""Lineage from an event log: one row per read or write, edges are its distinct pairs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterline.session import cut

#: What a build appends for each table that a write took; a null source for a write that took none.
LOG = "source string, target string, at timestamp_ntz"


def edges(log: DataFrame) -> DataFrame:
    """Distinct (source, target); a write without a source is no edge."""
    return log.filter(F.col("source").isNotNull()).select("source", "target").distinct()


def upstream_of(log: DataFrame, target: str) -> DataFrame:
    """What fed one table. The filter reaches the scan before the distinct."""
    return edges(log.filter(F.col("target") == target)).select("source")


def untraced(tables: DataFrame, log: DataFrame) -> DataFrame:
    """Published tables nothing was seen to feed."""
    return tables.join(edges(log).select(F.col("target").alias("name")), "name", "left_anti")


def missing_edges(required: DataFrame, log: DataFrame) -> DataFrame:
    return required.join(edges(log), ["source", "target"], "left_anti")


def foreign_edges(log: DataFrame, targets: str, namespaces: Sequence[str]) -> DataFrame:
    """Edges into our tables from a namespace that is not ours."""
    ours = F.lit(False)
    for namespace in namespaces:
        ours = ours | F.col("source").startswith(f"{namespace}.")
    return edges(log.filter(F.col("target").startswith(f"{targets}.") & ~ours))


def into_sources(log: DataFrame, sources: DataFrame, published: str) -> DataFrame:
    """Edges from a published table back into a source: a cycle."""
    back = edges(log.filter(F.col("source").startswith(f"{published}.")))
    return back.join(sources.select(F.col("name").alias("target")), "target", "left_semi").select(
        "source", "target"
    )


def followers(graph: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, hub, steps) of each node that one edge leads to and that is no root: the nearest node above it that is not such a node.

    Every path to a follower passes through its hub, so its depth is the hub's and `steps` more. Pointers are
    doubled, so rounds follow the logarithm of the longest stretch. Followers below a cycle of followers have no hub
    and no root above them, and are left out.
    """
    one = graph.groupBy(F.col("target").alias("node")).agg(F.count("*").alias("n"), F.min("source").alias("hub"))
    one = one.where("n = 1").join(roots.select(F.col("root").alias("node")), "node", "left_anti")
    found = cut(one.select("node", "hub", F.lit(1).cast("long").alias("steps"), F.lit(True).alias("moved")))
    for _ in range(found.count().bit_length() + 1):
        above = found.select(F.col("node").alias("hub"), F.col("hub").alias("over"), F.col("steps").alias("more"))
        found = cut(found.join(above, "hub", "left").select(
            "node", F.coalesce("over", "hub").alias("hub"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.col("over").isNotNull().alias("moved")))
        if found.where("moved").isEmpty():
            break
    return found.where("NOT moved").drop("moved")


def impact(log: DataFrame, roots: DataFrame) -> DataFrame:
    """(root, affected, depth): everything downstream of the given tables, depth by the shortest way.

    Nodes that one edge leads to follow from the nodes above them (see followers), so only the others are searched, from the
    roots only, never all pairs: each round joins what the last one shortened with the edges between them, whose length is
    the steps they stand for. Rounds therefore follow the meeting points on a way, not its length: a chain of any length takes
    one. What is reached is one written table, so the plan does not grow with the rounds.
    """
    names = roots.select(F.col("name").alias("root")).where("root IS NOT NULL").distinct()
    graph = cut(edges(log).where("target IS NOT NULL"))
    follow = followers(graph, names)
    at = follow.select(F.col("node").alias("source"), "hub", "steps")
    between = (
        graph.join(follow.select(F.col("node").alias("target")), "target", "left_anti").join(at, "source", "left")
        .groupBy(F.coalesce("hub", "source").alias("node"), "target").agg((F.min(F.coalesce("steps", F.lit(0))) + 1).alias("length"))
    )
    between = cut(between)
    last = reached = cut(names.select("root", F.col("root").alias("node"), F.lit(0).cast("long").alias("depth")))
    pair = ["root", "node"]
    while True:
        step = last.join(between, "node").groupBy("root", F.col("target").alias("node")).agg(F.min(F.col("depth") + F.col("length")).alias("depth"))
        known = reached.select(*pair, F.col("depth").alias("known"))
        last = cut(step.join(known, pair, "left").where("known IS NULL OR depth < known").drop("known"))
        if last.isEmpty():
            break
        reached = cut(reached.join(last.select(*pair), pair, "left_anti").unionByName(last))
    below = reached.withColumnRenamed("node", "hub").join(follow, "hub").select("root", "node", (F.col("depth") + F.col("steps")).alias("depth"))
    found = reached.where("depth > 0").unionByName(below)
    return found.select("root", F.col("node").alias("affected"), F.col("depth").cast("int").alias("depth"))
