"""Suffix arrays of many strings at once by induced sorting, and their permuted common prefixes, with numpy.

Strings are the rows (lanes) of a matrix; each scan of the induced sort moves over all lanes together, one place at a time, so
the work is linear in the length of the lanes and numpy works on whole columns.
"""

from __future__ import annotations


def classified(T, n):
    """Which suffixes are smaller than the next one (S), and which of those begin a fall's end (leftmost, LMS).

    T: characters, the last of each lane (at n - 1) is 0 and smaller than all others; places from n on are not used.
    """
    import numpy as np

    G, N = T.shape
    place = np.arange(N)
    inside = place[None, :] < n[:, None]
    step = np.zeros((G, N), np.int8)
    step[:, :-1] = np.sign(T[:, 1:].astype(np.int64) - T[:, :-1])
    step[np.arange(G), n - 1] = 1
    # Equal neighbours follow the next step that is not level.
    known = np.where(step != 0, place[None, :], N)
    known = np.minimum.accumulate(known[:, ::-1], axis=1)[:, ::-1].clip(max=N - 1)
    smaller = (np.take_along_axis(step, known, 1) > 0) & inside
    leftmost = np.zeros((G, N), bool)
    leftmost[:, 1:] = smaller[:, 1:] & ~smaller[:, :-1]
    return smaller, leftmost & inside


def buckets(T, n, K):
    """First and last-plus-one place of each character's bucket in each lane."""
    import numpy as np

    G, N = T.shape
    lane, at = np.nonzero(np.arange(N)[None, :] < n[:, None])
    counts = np.bincount(lane * K + T[lane, at], minlength=G * K).reshape(G, K)
    ends = np.cumsum(counts, axis=1)
    return ends - counts, ends


def induced(T, n, K, smaller, lane, at):
    """All suffixes from LMS suffixes in order (lane, at; lane by lane): first the larger ones, then the smaller ones."""
    import numpy as np

    G, N = T.shape
    heads, ends = buckets(T, n, K)
    SA = np.full((G, N), -1, np.int32)
    key = lane * K + T[lane, at]
    by = np.argsort(key, kind="stable")
    k = key[by]
    # The LMS suffixes of a bucket stand at its end, in order.
    last = np.searchsorted(k, k, side="right")
    SA[lane[by], ends[lane[by], T[lane[by], at[by]]] - (last - np.arange(len(k)))] = at[by]
    flat, sa, width = T.ravel(), SA.ravel(), N
    larger = ~smaller.ravel()
    rows = np.arange(G)
    head = heads.ravel()
    small = smaller.ravel()
    tail = ends.ravel().copy()
    for scan, kind, edge, step in ((range(N), larger, head, 1), (range(N - 1, -1, -1), small, tail, -1)):
        for i in scan:
            j = SA[:, i] - 1
            good = np.flatnonzero(j >= 0)
            if not len(good):
                continue
            where = good * width + j[good]
            take = kind[where]
            where = where[take]
            if not len(where):
                continue
            r = rows[good[take]]
            slot = r * K + flat[where]
            if step > 0:
                to = edge[slot]
                edge[slot] = to + 1
            else:
                to = edge[slot] - 1
                edge[slot] = to
            sa[r * width + to] = j[r]
    return SA


def named(T, n, leftmost, lane, at):
    """A number for each LMS substring in the order given (lane by lane, sorted), equal for equal ones."""
    import numpy as np

    N = T.shape[1]
    # Length of an LMS substring: up to and with the next LMS place.
    where = np.where(leftmost, np.arange(N)[None, :], N)
    onward = np.full(T.shape, N, np.int64)
    onward[:, :-1] = np.minimum.accumulate(where[:, ::-1], axis=1)[:, ::-1][:, 1:]
    length = np.minimum(onward[lane, at], n[lane] - 1) - at
    new = np.ones(len(lane), bool)
    i = np.flatnonzero((lane[1:] == lane[:-1]) & (length[1:] == length[:-1])) + 1
    k = 0
    while len(i):
        a, b = at[i] + k, at[i - 1] + k
        i = i[T[lane[i], a] == T[lane[i], b]]
        done = length[i] <= k
        new[i[done]] = False
        i = i[~done]
        k += 1
    number = np.cumsum(new)
    first = np.searchsorted(lane, lane)  # lanes are in order
    return number - number[first]


def suffix_arrays(T, n, K):
    """SA of each lane (places from n on are -1): classify, sort LMS substrings recursively, induce."""
    import numpy as np

    G, N = T.shape
    smaller, leftmost = classified(T, n)
    lane, at = np.nonzero(leftmost)
    rough = induced(T, n, K, smaller, lane, at)
    # LMS suffixes in the order of their substrings.
    ok = rough >= 0
    ok &= leftmost[np.arange(G)[:, None], np.where(ok, rough, 0)]
    sl, place = np.nonzero(ok)
    sorted_at = rough[sl, place].astype(np.int64)
    name = named(T, n, leftmost, sl, sorted_at)
    counts = np.bincount(sl, minlength=G)
    most = np.zeros(G, np.int64)
    np.maximum.at(most, sl, name + 1)
    again = most < counts
    if again.any():
        # The reduced string: names in text order; its own suffix array orders the LMS suffixes.
        grid = np.full((G, N), -1, np.int64)
        grid[sl, sorted_at] = name
        lanes = np.flatnonzero(again)
        M = int(counts[lanes].max())
        reduced, back = np.zeros((len(lanes), M), np.int64), np.zeros((len(lanes), M), np.int64)
        tl, ta = np.nonzero(leftmost[lanes])
        col = np.arange(len(tl)) - np.searchsorted(tl, tl)
        reduced[tl, col] = grid[lanes[tl], ta]
        back[tl, col] = ta
        order = suffix_arrays(reduced, counts[lanes], int(most[lanes].max()))
        ol, oc = np.nonzero(order >= 0)
        replace = again[sl]
        sorted_at[replace] = back[ol, order[ol, oc]]
    SA = induced(T, n, K, smaller, sl, sorted_at)
    SA[n == 1, 0] = 0  # nothing falls or rises in a lane of one character
    return SA


def permuted_prefixes(text, order, first, limit):
    """For each place, in text order, how long its suffix agrees with the one before it in its lane's order, up to `limit`;
    and the place of that one, or -1.

    text: bytes of all lanes one after another, each with its end of 0; order: their suffix arrays as places in text;
    first: where each lane begins. Eight bytes are compared at a time.
    """
    import numpy as np

    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    before[order[first]] = -1
    padded = np.concatenate([text, np.zeros(limit + 16, np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view("<u8").ravel()
    common = np.zeros(n, np.int32)
    i = np.flatnonzero(before >= 0)
    for k in range(0, limit, 8):
        differ = words[i + k] ^ words[before[i] + k]
        apart = differ != 0
        low = differ[apart]
        equal = np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)) // 8
        common[i[apart]] = np.minimum(limit, k + equal)
        i = i[~apart]
        if not len(i):
            break
    common[i] = limit
    return common, before
