"""Bitmaps of a fixed size over a column of hashes: they may let too many through, never too few."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits, as a power of two: 16 MB.
BITS = 27


def bitmap(hashes: DataFrame, column: str, bits: int = BITS):
    """A broadcast array of 2**bits bits, set at the low bits of each hash. Its size does not follow the rows.

    The driver and each executor that reads it keep a file of that size: destroy() it once what it was read for is stored.
    """
    import numpy as np

    low = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = hashes.groupBy(F.shiftright(low, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), low.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")
    )
    found = words.toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return hashes.sparkSession.sparkContext.broadcast(out)


def marked(table, hashes):
    """Which of the hashes (numpy, 64-bit) may be in the bitmap."""
    import numpy as np

    low = hashes.view(np.uint64) & np.uint64(len(table) * 64 - 1)
    return (table[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1
