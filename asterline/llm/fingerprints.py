"""Document fingerprints: bottom-k sketches of word shingles.

A sketch holds the k smallest 48-bit shingle hashes of a text. Sketches of parts merge into the sketch of their union,
and two sketches estimate resemblance, containment and the number of distinct shingles. A text with fewer than k
shingles has all of them in its sketch, and the estimates are exact.

Null text counts as empty; an empty text has an empty sketch, is like another empty text (1) and unlike any other (0). Rows
with equal ids follow each other in the order of their texts' hashes; null ids come first. One row alone is its
own next. An empty table gives no rows.
"""

from __future__ import annotations

import base64

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asterline.llm.textparts import SHINGLE, shingles

K = 256
BITS = 48


def sketch(text: bytes, k: int = K, size: int = SHINGLE):
    """The k smallest shingle hashes, ascending."""
    import numpy as np

    x = shingles(text, size) >> np.uint64(64 - BITS)  # still ascending
    return x[:k] if len(x) < 2 or (x[1:] > x[:-1]).all() else np.unique(x)[:k]


def merged(a, b, k: int = K):
    import numpy as np

    return np.union1d(a, b)[:k]


def resemblance(a, b, k: int = K) -> float:
    """Estimated |A and B| / |A or B|."""
    import numpy as np

    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)
    if len(a) >= k or len(b) >= k:
        union = union[:k]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.searchsorted(both, union[-1], side="right") / len(union))


def distinct(a, k: int = K) -> float:
    """Estimated number of distinct shingles."""
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**BITS / float(a[k - 1])


def containment(a, b, k: int = K) -> float:
    """Estimated share of A's shingles that B has."""
    if not len(a):
        return 1.0
    both = resemblance(a, b, k) * distinct(merged(a, b, k), k)
    return min(1.0, both / distinct(a, k))


def as_text(a) -> str:
    """6 bytes for each hash, big-endian, in base64."""
    import numpy as np

    return base64.b64encode(np.asarray(a, ">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_text(text: str):
    import numpy as np

    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").ravel().astype(np.uint64)


def merged_by(sketches: DataFrame, key: str, column: str = "fingerprint") -> DataFrame:
    """One sketch for each key from the sketches of its parts: each task merges its own rows before the shuffle."""

    def partial(frames):
        held: dict = {}
        for pdf in frames:
            for name, text in zip(pdf[key], pdf[column]):
                x = from_text(text)
                held[name] = merged(held[name], x) if name in held else x
        import pandas as pd

        yield pd.DataFrame({key: list(held), column: [as_text(x) for x in held.values()]})

    rows = sketches.select(key, column).where(F.col(column).isNotNull())
    parts = rows.mapInPandas(partial, rows.schema).repartition(key)
    return parts.mapInPandas(partial, rows.schema)


def _in_order(docs: DataFrame, ident: str, text: str) -> DataFrame:
    """Rows in ranges of the order (doc_id, tie), each range followed by the first row of the next range (guest).

    The ranges' bounds are quantiles of the ids, their number that of the shuffle partitions: what is broadcast is one row
    for each range. After the last row of all comes the first of all.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(ident).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = [i / ranges for i in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, at)), F.lit(100 * ranges))).first()[0] or []
    bounds = F.array(*[F.lit(x).cast("long") for x in sorted(set(bounds))]) if bounds else F.array().cast("array<long>")
    rows = rows.withColumn("range", F.when(F.col("doc_id").isNull(), 0).otherwise(
        F.aggregate(bounds, F.lit(0), lambda n, x: n + (x < F.col("doc_id")).cast("int"))))
    firsts = rows.groupBy("range").agg(F.min(F.struct("doc_id", "tie")).alias("first"))
    w = Window.orderBy("range")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = firsts.select("range", F.coalesce(F.lead("first").over(w), F.first("first").over(whole)).alias("first"))
    guests = (
        rows.drop("range").join(
            F.broadcast(follows.select("range", F.col("first.doc_id").alias("i"), F.col("first.tie").alias("t"))),
            F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("tie") == F.col("t")))
        .select("doc_id", "text", "tie", "range")
    )
    both = rows.withColumn("guest", F.lit(0)).unionByName(guests.withColumn("guest", F.lit(1)))
    return both.repartition("range").sortWithinPartitions("range", "guest", "doc_id", "tie")


def with_edits(docs: DataFrame, ident: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and its likeness to the edited and to the next text.

    The edited text ends in the first characters of the next one, a quarter of the text's length.
    """

    def compare(batches):
        import hashlib

        import pyarrow as pa

        schema = pa.schema([
            ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
        held, out, size = None, [], 0
        for batch in batches:
            for doc_id, words, where, guest in zip(*(batch.column(i).to_pylist() for i in range(4))):
                own = sketch(words.encode(), k)
                if held is not None and held[2] == where:
                    last_id, last, _, mine = held
                    quarter = len(last) // 4
                    edited = (last[: len(last) - quarter] + words[:quarter]).encode()
                    other = sketch(edited, k)
                    out.append((last_id, len(last), hashlib.sha256(edited).hexdigest(), as_text(mine), as_text(other),
                                resemblance(mine, other, k), resemblance(mine, own, k)))
                    size += 16 * k
                held = None if guest else (doc_id, words, where, own)
                if size >= 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                    out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    return _in_order(docs, ident, text).select("doc_id", "text", "range", "guest").mapInArrow(
        compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")  # fmt: skip
