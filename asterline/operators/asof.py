"""As-of joins: attach the version that was true at a row's own time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterline.contracts import END, START
from asterline.operators.timeline import last_known
from asterline.session import passing, stored


def resolve(
    probes: DataFrame, versions: DataFrame, key: str, at: str, take: Sequence[str], rows: int | None = None
) -> DataFrame:
    """(_k, _at, the columns of take) for each distinct key and instant at which a version is true.

    Instants and starts are read along each key's timeline together, in pieces, and the last version is carried forward:
    linear in both, however many versions a key has. The version that starts last up to the instant counts, of equal
    starts the one that ends last, then the greatest values; where it has ended, none is true, even if an earlier one were still open.
    """
    asked = probes.select(F.col(key).alias("_k"), F.col(at).alias("_at")).where("_k IS NOT NULL AND _at IS NOT NULL")
    # Written once: the search for long timelines and the scan itself read pairs, not the plan they come from.
    asked = stored(asked.distinct(), "asof-probes")
    marks = versions.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_k"),
        F.col(START).alias("_at"),
        F.struct(F.col(END).isNull().alias("_open"), F.col(END).alias("_until"), *take).alias("_version"),
    )
    both = asked.withColumn("_asked", F.lit(True)).unionByName(marks.withColumn("_asked", F.lit(False)), allowMissingColumns=True)
    filled = last_known(both, ["_k"], "_at", "_version", "_hit", ties=["_asked", "_version"], rows=rows).where("_asked")
    true = filled.where(F.col("_hit").isNotNull() & (F.col("_hit._open") | (F.col("_at") < F.col("_hit._until"))))
    return true.select("_k", "_at", *[F.col(f"_hit.{c}").alias(c) for c in take])


def asof_join(
    left: DataFrame, versions: DataFrame, key: str, at: str, take: Sequence[str], rows: int | None = None
) -> DataFrame:
    """Left as-of join; every left row comes out exactly once.

    Only distinct (key, instant) pairs travel to the versions, so a busy instant is one row there; what they resolve to comes
    back by equality, a join whose hot pairs the adaptive planner splits. What they resolve to is written in their place, so
    the shuffles of the timeline are gone when the join runs.
    """
    with passing(left.sparkSession, versions.sparkSession):
        known = stored(resolve(left, versions, key, at, take, rows), "asof-known", outlives=True)
    return left.join(known, (left[key] == known["_k"]) & (left[at] == known["_at"]), "left").select(*[left[c] for c in left.columns], *[known[c] for c in take])
