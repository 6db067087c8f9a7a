"""Periodic runs of words, found on a grammar: Re-Pair, boundaries of nonterminals, positions of their derivations.

A run is a maximal stretch of consecutive words with smallest period q, of at least `least` words and `exponent` periods. The
words after a run's first period are copies; `collapsed` gives the text without them.

No run holds a pair of neighbouring words met once in its document (the pair comes again q words away), and no rule of Re-Pair
ever spans one. So documents fall into stretches between such places, and those shorter than a run are done. For the others:

1. Re-Pair replaces the most frequent pair of symbols by a new one until none is met twice. Ties go to the pair met first,
   so that rules grow level by level.
2. For each rule X -> Y Z the runs that cross the boundary of Y and Z inside X are found once, and so are those that cross a
   boundary of the sequence that is left. At least half of a run lies on one side of the boundary, so the four words there
   come again one period away: places of the same four words are the only candidates, and words are compared from them on.
3. They are translated to all positions that derive X. The least symbol that derives a run whole has it in full; what other
   symbols see of it are parts. Intervals of one period that share a period are merged, and of equal intervals the smallest
   period counts.

Words are compared as ids of their exact text, never by hashes. Null and empty texts have no words and no runs; texts of any
length are taken whole, with memory in proportion to the longest. Repeated rows and null or equal ids are separate rows. An empty
table gives no rows. Only the id and the text are read; other columns do not matter, whatever their names.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST = 24
EXPONENT = 3
#: Bytes of text whose words are numbered together.
CHUNK = 8 << 20
#: Words that a run of at least 3 periods and 24 words repeats beside any boundary: g <= max(12, 1.5 q) - q for all q.
GRAM = 4
#: Single words of half a period that are compared for all candidates at once.
PROBES = 12


def re_pair(ids: list[int]) -> tuple[list[tuple[int, int]], list[int], int]:
    """(rules, sequence, first): symbol first + k derives rules[k]; no pair is twice in the sequence that is left."""
    n, first = len(ids), max(ids, default=-1) + 1
    symbols, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))
    places: dict[tuple[int, int], dict[int, None]] = defaultdict(dict)
    for i in range(n - 1):
        places[symbols[i], symbols[i + 1]][i] = None
    queue = [(-len(p), k, pair) for k, (pair, p) in enumerate(places.items()) if len(p) > 1]
    heapq.heapify(queue)
    serial, rules = len(places), []
    while queue:
        count, age, pair = heapq.heappop(queue)
        found = places.get(pair, ())
        if len(found) != -count:
            # Neighbours were replaced since: the pair waits for its turn among those as frequent.
            if len(found) > 1:
                heapq.heappush(queue, (-len(found), age, pair))
            continue
        a, b = pair
        chosen = sorted(found)
        if a == b:
            apart, end = [], -1
            for i in chosen:
                if i != end:
                    apart.append(i)
                    end = after[i]
            chosen = apart
        del places[pair]
        if len(chosen) < 2:
            continue
        name = first + len(rules)
        rules.append(pair)
        touched: dict[tuple[int, int], None] = {}
        for i in chosen:
            j, h = after[i], before[i]
            k = after[j]
            if h >= 0:
                left = symbols[h]
                if (left, a) in places:
                    places[left, a].pop(h, None)
                places[left, name][h] = None
                touched[left, name] = None
            if k < n:
                right = symbols[k]
                if (b, right) in places:
                    places[b, right].pop(j, None)
                places[name, right][i] = None
                touched[name, right] = None
                before[k] = i
            symbols[i], after[i] = name, k
        for pair in touched:
            if len(places[pair]) > 1:
                heapq.heappush(queue, (-len(places[pair]), serial, pair))
                serial += 1
    left, i = [], 0
    while i < n:
        left.append(symbols[i])
        i = after[i]
    return rules, left, first


def _forward(v, i: int, j: int, end: int) -> int:
    """How many words from i on equal those from j on, before end."""
    n, step = 0, 64
    while j + n < end:
        m = min(step, end - j - n)
        differ = v[i + n : i + n + m] != v[j + n : j + n + m]
        at = int(differ.argmax())
        if differ[at]:
            return n + at
        n, step = n + m, step * 4
    return n


def _backward(v, i: int, j: int, start: int) -> int:
    """How many words before i equal those before j, from start on; i < j."""
    n, step = 0, 64
    while i - n > start:
        m = min(step, i - n - start)
        differ = (v[i - n - m : i - n] != v[j - n - m : j - n])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            return n + at
        n, step = n + m, step * 4
    return n


class _Crossing:
    """Runs of a sequence of word ids that cross a place, within bounds."""

    def __init__(self, v, least: int, exponent: int):
        import numpy as np

        self.v, self.least, self.exponent = v, least, exponent
        _, pair = np.unique(v[:-1] * (int(v.max()) + 1) + v[1:], return_inverse=True)
        _, self.gram = np.unique(pair[:-2] * (int(pair.max()) + 1) + pair[2:], return_inverse=True)
        self.order = np.argsort(self.gram, kind="stable")
        self.begin = np.concatenate(([0], np.cumsum(np.bincount(self.gram))))

    def _same(self, at: int, low: int, high: int):
        """Places from low on, before high, of the four words at a place; ascending."""
        g = self.gram[at]
        all_ = self.order[self.begin[g] : self.begin[g + 1]]
        a, b = all_.searchsorted((low, high))
        return all_[a:b]

    def at(self, place: int, start: int, end: int) -> list[tuple[int, int, int]]:
        """(start, end, period) of what runs that cross `place` have inside start to end."""
        v, out, most = self.v, [], (end - start) // self.exponent
        if place + GRAM <= end:
            q = self._same(place, place + 1, min(place + most, end - GRAM) + 1) - place
            # The copy of half a period from the place on is inside the run.
            half = (q + 1) // 2 - 1
            q, half = q[place + q + half < end], half[place + q + half < end]
            for i in range(1, PROBES + 1 if len(q) > PROBES else 2):
                x = place + half - half * (i - 1) // PROBES
                same = v[x] == v[x + q]
                q, half = q[same], half[same]
            while len(q):
                p, q = int(q[0]), q[1:]
                run = (place - _backward(v, place, place + p, start), place + p + _forward(v, place, place + p, end), p)
                if run[1] - run[0] >= max(self.least, self.exponent * p):
                    out.append(run)
                    q = q[(q % p != 0) | (place + q >= run[1])]
        if place - GRAM >= start:
            q = (place - GRAM) - self._same(place - GRAM, max(start, place - GRAM - most), place - GRAM)[::-1]
            half = (q + 1) // 2
            q, half = q[place - half - q >= start], half[place - half - q >= start]
            for i in range(1, PROBES + 1 if len(q) > PROBES else 2):
                x = place - half + (half - 1) * (i - 1) // PROBES
                same = v[x] == v[x - q]
                q, half = q[same], half[same]
            while len(q):
                p, q = int(q[0]), q[1:]
                run = (place - p - _backward(v, place - p, place, start), place + _forward(v, place - p, place, end), p)
                if run[1] - run[0] >= max(self.least, self.exponent * p):
                    out.append(run)
                    q = q[(q % p != 0) | (place - q < run[0])]
        return out


def merged(found) -> list[tuple[int, int, int]]:
    """Maximal intervals of each period; of equal intervals that of the smallest period. (start, end, period), sorted."""
    least: dict[tuple[int, int], int] = {}
    last: tuple[int, int, int] | None = None

    def close() -> None:
        if last is not None:
            key = last[1:]
            least[key] = min(last[0], least.get(key, last[0]))

    for period, start, end in sorted({(q, s, e) for s, e, q in found}):
        if last is not None and last[0] == period and start + period <= last[2]:
            last = (period, last[1], max(last[2], end))
        else:
            close()
            last = (period, start, end)
    close()
    return sorted((s, e, q) for (s, e), q in least.items())


def runs(ids, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, end, period) of the runs in a sequence of word ids, by start and period."""
    import numpy as np

    if least < LEAST or exponent < EXPONENT:
        raise ValueError(f"runs are of {LEAST} words and {EXPONENT} periods at least")
    v = np.unique(np.asarray(ids, np.int64), return_inverse=True)[1].astype(np.int64)
    if len(v) < least:
        return []
    rules, left, first = re_pair(v.tolist())
    size = [1] * first
    for a, b in rules:
        size.append(size[a] + size[b])
    crossing, found = _Crossing(v, least, exponent), []
    # Positions go from each symbol to what it derives, newest rules first.
    where: list[list[int]] = [[] for _ in size]
    at = 0
    for symbol in left:
        if at:
            found += crossing.at(at, 0, len(v))
        if size[symbol] >= least:
            where[symbol].append(at)
        at += size[symbol]
    for symbol in range(len(size) - 1, first - 1, -1):
        if size[symbol] < least:
            continue
        (a, b), places = rules[symbol - first], where[symbol]
        start, cut = places[0], size[a]
        for s, e, q in crossing.at(start + cut, start, start + size[symbol]):
            found += [(s - start + p, e - start + p, q) for p in places]
        if size[a] >= least:
            where[a] += places
        if size[b] >= least:
            where[b] += [p + cut for p in places]
        where[symbol] = []
    return merged(found)


def stretches(word, doc, least: int = LEAST):
    """(first, last + 1) of the stretches that may hold a run, for words of several documents one after the other.

    Pairs met once in what is left of a document cut it; pieces of fewer than `least` words go; until nothing goes any more.
    """
    import numpy as np

    first, stop = np.zeros(1, np.int64), np.array([len(word)], np.int64)
    at = np.arange(len(word))
    piece = doc
    while len(at) >= least:
        inside = piece[1:] == piece[:-1]
        key = word[at[:-1]] * (int(word.max()) + 1) + word[at[1:]]
        key = np.where(inside, key, -1)
        # Words of one document stand together, so that a stable sort by pair leaves its documents in order.
        order = np.argsort(key, kind="stable")
        k, d = key[order], doc[at[order]]
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
        once = new & np.append(new[1:], True)
        whole = inside.copy()
        whole[order[once]] = False
        cut = np.flatnonzero(np.concatenate(([True], ~whole, [True])))
        first, stop = cut[:-1], cut[1:]
        long = stop - first >= least
        if long.all() and len(first) and whole.sum() == inside.sum():
            return [(int(at[a]), int(at[b - 1]) + 1) for a, b in zip(first, stop, strict=True)]
        mark = np.zeros(len(at) + 1, np.int64)
        mark[first[long]] += 1
        mark[stop[long]] -= 1
        kept = np.cumsum(mark[:-1]) > 0
        piece = np.cumsum(np.concatenate(([True], ~whole)))[kept]
        at = at[kept]
    return []


def _chunk(texts, least: int, exponent: int):
    """(words, runs, text left) of each of some texts, as Arrow arrays."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = split.flatten()
    offsets = split.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(real)))[offsets]
    flat = flat.filter(pa.array(real))
    count = np.diff(offsets)
    doc = np.repeat(np.arange(len(count)), count)
    word = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    drop = np.zeros(len(word) + 1, np.int64)
    for a, b in stretches(word, doc, least) if len(word) else []:
        d = int(doc[a])
        for s, e, q in runs(word[a:b], least, exponent):
            found[d].append((a + s - int(offsets[d]), e - s, q))
            drop[a + s + q] += 1
            drop[a + e] -= 1
    kept = np.cumsum(drop[:-1]) == 0
    left = np.concatenate(([0], np.cumsum(kept)))[offsets]
    words = pa.ListArray.from_arrays(pa.array(left, pa.int32()), flat.filter(pa.array(kept)))
    listed = [[dict(start=s, length=n, period=q) for s, n, q in sorted(found[d])] if d in found else [] for d in range(len(count))]
    return pa.array(count, pa.int64()), listed, pc.binary_join(words, " ")


def collapsed(docs: DataFrame, ident: str = "doc_id", text: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """One row for each row of docs: its id, n_words, runs (start, length, period; by start and period) and collapsed.

    collapsed has the words left, joined by one space, when those of each run after its first period go.
    """
    rows = docs.select(F.col(ident).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def find(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        item = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for batch in batches:
            texts = batch.column("text")
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                done = int(ends[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, done + CHUNK, side="right")))
                count, listed, left = _chunk(texts.slice(at, stop - at), least, exponent)
                columns = [batch.column("id").slice(at, stop - at), count, pa.array(listed, pa.list_(item)), left.cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])
                at = stop

    schema = f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return rows.mapInArrow(find, schema).withColumnRenamed("id", ident)
