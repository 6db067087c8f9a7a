"""Words and word shingles of a text as 64-bit hashes, with numpy over its bytes.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r, with A-Z lower-cased. Null and empty texts have no words. Long
texts are taken in pieces that end between words, so memory follows the piece, not the text.
"""

from __future__ import annotations

import re

SHINGLE = 5
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0x165667B19E3779F9)


def mix(x):
    """Spread the bits of unsigned 64-bit numbers; wraps around."""
    import numpy as np

    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(_ODD[2])
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(_ODD[3])
    return x ^ (x >> np.uint64(32))


def word_hashes(data: bytes):
    """A hash for each word of UTF-8 bytes, in order."""
    import numpy as np

    data, at, out = data.lower(), 0, []
    while at < len(data):
        end = len(data)
        if end - at > PIECE:
            found = _SPACE.search(data, at + PIECE)
            end = found.start() if found else end
        a = np.frombuffer(data, np.uint8, end - at, at)
        at = end
        inside = (a != 32) & ((a < 9) | (a > 13))
        where = np.flatnonzero(inside)
        if not len(where):
            continue
        # Word bytes stand in runs; a run begins where the place jumps.
        first = np.flatnonzero(np.diff(where, prepend=-2) > 1)
        offset = where - np.repeat(where[first], np.diff(first, append=len(where)))
        x = (a[where].astype(np.uint64) + np.uint64(1)) * np.uint64(_ODD[0]) + offset.astype(np.uint64) * np.uint64(_ODD[1])
        out.append(mix(np.add.reduceat(mix(x), first)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingles(data: bytes, size: int = SHINGLE):
    """The distinct shingles of `size` words, sorted; of fewer words the whole sequence is one."""
    import numpy as np

    w = word_hashes(data)
    if not len(w):
        return w
    size = min(size, len(w))
    n = len(w) - size + 1
    x = np.zeros(n, np.uint64)
    for i in range(size):
        x = mix(x * np.uint64(_ODD[4]) + w[i : i + n])
    return np.unique(x)
