"""Centroid clustering: Lloyd's rounds whose assignment is a tournament over bisecting planes.

Vectors become integers, floor(1024 * x), and all that follows is exact. For each pair of centroids i < j the plane between them
has an integer normal 2 (c_j - c_i) and threshold |c_j|^2 - |c_i|^2. A vector starts with centroid 0 and meets 1, 2, ... in turn: one
sign of normal * x - threshold a meeting, k - 1 in all, eliminates the farther of two, and zero keeps the smaller number. The
distance is computed once, to the winner. Doubles hold every product while components stay below a bound; where they do not, the
same steps run on Python's integers.

A round reads the vectors as they are stored; a task sends one row for each cluster and component, so that what is shuffled and
what the driver holds (k times the components) does not follow the rows, nor how often a vector repeats.

Vectors with another number of components, a null or a non-finite one, and null vectors, are left out. The first centroids are those
of the k smallest seeded hashes of ids; of equal ids the smaller components come first, null ids hash as no digits. With fewer vectors
than k there are as many centroids as vectors. A centroid without vectors stays where it is. A squared distance or inertia that no
long holds is null. An empty table gives no rows; only the id and the vector are read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterline.session import stored

SCALE = 1024
#: Sums travel as signed limbs of so many bits, all but a few of them one.
LIMB = 60
_LONG = 1 << 63


def quantised(x: float) -> int:
    """floor(SCALE * x), exact for every finite double."""
    return math.floor(x * SCALE) if math.isfinite(x * SCALE) else int(x) * SCALE


def _vectors(column, size: int):
    """(which rows count, their vectors as a matrix of doubles) of an Arrow list column."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    right = pc.fill_null(pc.equal(pc.list_value_length(column), size), False)
    flat = column.filter(right).flatten().cast(pa.float64())
    x = flat.fill_null(math.nan).to_numpy(zero_copy_only=False).reshape(-1, size)
    fine = np.isfinite(x).all(axis=1)
    rows = np.flatnonzero(right.to_numpy(zero_copy_only=False))
    return rows[fine], x[fine]


class Tournament:
    """The planes between all pairs of centroids (tuples of ints)."""

    def __init__(self, centroids: list[tuple[int, ...]]):
        import numpy as np

        self.centroids = centroids
        self.size = len(centroids[0])
        #: Below it every sum of products stays under 2**53: |normal| <= 4 b, so 4 b * b * size, and (2 b)^2 * size.
        self.bound = math.isqrt((1 << 53) // (4 * self.size)) - 1
        self.small = max(abs(x) for c in centroids for x in c) <= self.bound
        pairs = [(i, j) for j in range(len(centroids)) for i in range(j)]
        self.planes = {
            (i, j): ([2 * (b - a) for a, b in zip(centroids[i], centroids[j], strict=True)],
                     sum(b * b for b in centroids[j]) - sum(a * a for a in centroids[i]))
            for i, j in pairs
        }
        if self.small:
            k = len(centroids)
            self.normal, self.threshold = np.zeros((k, k, self.size)), np.zeros((k, k))
            for (i, j), (n, t) in self.planes.items():
                self.normal[i, j], self.threshold[i, j] = n, t
            self.points = np.array(centroids, np.float64)

    def nearest(self, x):
        """(number, squared distance) of the nearest centroid of each row of doubles `x`; distances as ints or int64."""
        import numpy as np

        with np.errstate(over="ignore"):
            whole = np.floor(x * SCALE)
        usual = self.small & (np.abs(whole) <= self.bound).all(axis=1) if len(x) else np.zeros(0, bool)
        winner, distance = np.zeros(len(x), np.int64), np.zeros(len(x), object)
        q = whole[usual]
        w = np.zeros(len(q), np.int64)
        for j in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", q, self.normal[w, j]) - self.threshold[w, j] if self.small else 0
            w = np.where(side > 0, j, w)
        winner[usual] = w
        if len(q):
            distance[usual] = ((q - self.points[w]) ** 2).sum(axis=1).astype(np.int64)
        for i in np.flatnonzero(~usual):
            row = [quantised(float(v)) for v in x[i]]
            at = 0
            for j in range(1, len(self.centroids)):
                normal, threshold = self.planes[at, j]
                if sum(a * b for a, b in zip(normal, row, strict=True)) > threshold:
                    at = j
            winner[i] = at
            distance[i] = sum((a - b) ** 2 for a, b in zip(row, self.centroids[at], strict=True))
        return winner, distance, whole, usual


def _sums(vectors: DataFrame, tournament: Tournament, size: int) -> dict[int, tuple[int, list[int]]]:
    """Cluster to its number of vectors and the sum of their components."""

    def add(batches):
        import numpy as np
        import pyarrow as pa

        k = len(tournament.centroids)
        total, counts = np.zeros((k, size), object), [0] * k
        for batch in batches:
            _, x = _vectors(batch.column("vector"), size)
            winner, _, whole, usual = tournament.nearest(x)
            for c in range(k):
                mine = winner == c
                counts[c] += int(mine.sum())
                # Doubles are exact here: rows of a batch times the bound.
                total[c] += whole[mine & usual].sum(axis=0).astype(np.int64)
                for i in np.flatnonzero(mine & ~usual):
                    total[c] += np.array([quantised(float(v)) for v in x[i]], object)
        out: list[tuple[int, int, int, int]] = []
        for c in range(k):
            if not counts[c]:
                continue
            out.append((c, -1, 0, counts[c]))
            for d, v in enumerate(total[c]):
                v, limb = int(v), 0
                while not -_LONG <= v < _LONG:
                    out.append((c, d, limb, v & ((1 << LIMB) - 1)))
                    v, limb = v >> LIMB, limb + 1
                out.append((c, d, limb, v))
        names = ["cluster", "part", "limb", "value"]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names)

    partial = vectors.select("vector").mapInArrow(add, "cluster int, part int, limb int, value long")
    rows = partial.groupBy("cluster", "part", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    found: dict[int, tuple[int, list[int]]] = {}
    for cluster in {r.cluster for r in rows}:
        sums, count = [0] * size, 0
        for r in rows:
            if r.cluster == cluster and r.part < 0:
                count = int(r.value)
            elif r.cluster == cluster:
                sums[r.part] += int(r.value) << (LIMB * r.limb)
        found[cluster] = (count, sums)
    return found


def first_centroids(vectors: DataFrame, k: int, size: int, seed: int) -> list[tuple[int, ...]]:
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    kept = vectors.where((F.size("vector") == size) & finite)
    rows = kept.select(digest.alias("digest"), "vector").orderBy("digest", "vector").limit(k).collect()
    return [tuple(quantised(float(x)) for x in r.vector) for r in rows]


def clustered(embeddings: DataFrame, k: int = 8, rounds: int = 10, size: int = 64, seed: int = 3,
              ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each vector that counts: its id, cluster, distance, cluster_inertia, inertia, and centroid (decimal integers)."""
    rows = embeddings.select(F.col(ident).alias("id"), F.col(vector).alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()
    centroids = first_centroids(rows, k, size, seed)
    if not centroids:
        empty = "CAST(NULL AS INT) AS cluster, CAST(NULL AS BIGINT) AS distance, CAST(NULL AS BIGINT) AS cluster_inertia"
        none = rows.where("false").selectExpr("id", *empty.split(", "), "CAST(NULL AS BIGINT) AS inertia", "CAST(NULL AS ARRAY<STRING>) AS centroid")
        return none.withColumnRenamed("id", ident)
    for _ in range(rounds):
        sums = _sums(rows, Tournament(centroids), size)
        # Python's // is a floor, also below zero.
        centroids = [tuple(s // sums[c][0] for s in sums[c][1]) if c in sums else old for c, old in enumerate(centroids)]
    last = Tournament(centroids)

    def assign(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            which, x = _vectors(batch.column("vector"), size)
            winner, distance, _, _ = last.nearest(x)
            far = [int(d) if int(d) < _LONG else None for d in distance]
            columns = [batch.column("id").take(pa.array(which)), pa.array(winner.astype(np.int32)), pa.array(far, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "cluster", "distance"])

    found = stored(rows.mapInArrow(assign, f"id {kind}, cluster int, distance long"), "bisector-assigned")
    per = found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d"), F.count_if(F.col("distance").isNull()).alias("lost")
    )
    inertia = {r.cluster: None if r.lost else int(r.d) for r in per.collect()}
    total = None if None in inertia.values() else sum(inertia.values())

    def number(value: int | None):
        return F.lit(value if value is not None and value < _LONG else None).cast("long")

    # One branch for each of k clusters: nothing to join.
    def of_cluster(values):
        return reduce(lambda rest, c: F.when(F.col("cluster") == c, values[c]).otherwise(rest), sorted(inertia), F.lit(None))

    return found.select(
        F.col("id").alias(ident), "cluster", "distance",
        of_cluster({c: number(v) for c, v in inertia.items()}).alias("cluster_inertia"),
        number(total).alias("inertia"),
        of_cluster({c: F.split(F.lit(",".join(map(str, centroids[c]))), ",") for c in inertia}).alias("centroid"),
    )
