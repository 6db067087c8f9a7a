"""Suffix-array dedup: bytes covered by a string of WINDOW bytes that also starts earlier in the corpus are removed.

Texts are UTF-8 bytes, matches stay inside documents, and all strings are judged on the input. The order is by document
id, then by start. The result is exact; Spark brings together what can be equal, suffix arrays decide.

1. Of the 36-byte grams inside each window of 100 bytes, the one of least hash (the rightmost of equals) is the window's anchor. Equal
   windows have equal anchors at equal places. Starts with one anchor follow each other: with the bytes that
   their windows cover they are a snippet, and equal windows lie in snippets of equal anchor grams.
2. Grams met once in the corpus are dropped: counted in all, kept for the tasks as a bitmap of fixed size that may let
   too many pass, never too few.
3. Equal snippets are one class with a first place; all their later places are repeats as a whole. So suffix
   arrays only see different snippets, of grams with at least two of them.
4. Classes of one gram are a lane of a shard. Induced sorting gives the shard's suffix arrays, permuted common
   prefixes of at least WINDOW mark equal windows, and the first place of each stands.
5. Windows of a gram with more than LANE classes are parted by where the gram stands in them, in PARTS ranges of places. All windows of a
   part hold a longer gram around the anchor, so each part is a snippet of that gram: steps 3 and 4 are taken again, and what
   only shares the short gram is dropped. A longer gram with many classes is cut into lanes of LANE classes. What stays first within a lane meets the other
   lanes' by the window's hash.

Null and empty texts have nothing to remove. Null ids come before all others. Rows with equal ids count as one document
with several texts: among them a string that starts at a smaller place is earlier, and exact repeats keep all. Empty tables give empty results.
Extra columns stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterline.llm.bitmaps import bitmap, marked
from asterline.llm.suffixes import permuted_prefixes, suffix_arrays
from asterline.llm.textparts import _ODD, mix
from asterline.session import stored

WINDOW = 100
GRAM = 36
#: Starts whose grams are compared: each window holds so many.
SPAN = WINDOW - GRAM + 1
#: Ranges of places of a frequent gram in its windows.
PARTS = 4
#: Classes of a lane.
LANE = 128
#: Bytes of a batch of lanes, places included.
BATCH = 3 << 20
#: Starts of a long text that are taken at a time.
PIECE = 1 << 20
NO_ID = -(1 << 63)
_RAISED = bytes(min(b + 2, 255) for b in range(256))


def _powers(count: int):
    """Powers of an odd number and of its inverse modulo 2**64."""
    import numpy as np

    out = []
    for base in (_ODD[4], pow(_ODD[4], -1, 1 << 64)):
        p = np.full(count, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out


class Anchors:
    """The snippets of texts."""

    def __init__(self):
        self.up, self.down = _powers(PIECE + 2 * WINDOW)

    def snippets(self, data: bytes):
        """(gram, content hash, start, starts, anchor) of each snippet, as arrays."""
        import numpy as np

        out = []
        for at in range(0, len(data) - WINDOW + 1, PIECE):
            a = np.frombuffer(data, np.uint8, min(PIECE + WINDOW - 1, len(data) - at), at)
            sums = np.zeros(len(a) + 1, np.uint64)
            np.cumsum((a + np.uint64(1)) * self.up[: len(a)], out=sums[1:])
            gram = mix((sums[GRAM:] - sums[:-GRAM]) * self.down[: len(a) - GRAM + 1])
            # Least hash first, then the rightmost place.
            place = np.uint64((1 << 24) - 1) - np.arange(len(gram), dtype=np.uint64)
            least = (gram & ~np.uint64((1 << 24) - 1)) | place
            span = 1
            while span * 2 <= SPAN:
                least = np.minimum(least[:-span], least[span:])
                span *= 2
            least = np.minimum(least[: len(least) - (SPAN - span)], least[SPAN - span :])
            first = np.flatnonzero(np.diff(least, prepend=~least[0]))
            end = np.append(first[1:], len(least))
            anchor = ((1 << 24) - 1) - (least[first] & np.uint64((1 << 24) - 1)).astype(np.int64)
            content = (sums[end - 1 + WINDOW] - sums[first]) * self.down[first]
            shape = ((end - first) * 128 + (anchor - first)).astype(np.uint64)
            out.append((gram[anchor], mix(mix(content) + shape * np.uint64(_ODD[1])), first + at, end - first, anchor - first))
        if not out:
            e = np.zeros(0, np.int64)
            return e.view(np.uint64), e.view(np.uint64), e, e, e
        return tuple(np.concatenate(x) for x in zip(*out))


def _met(rows: DataFrame):
    """A bitmap of all grams that occur more than once."""

    def grams(batches):
        import numpy as np
        import pyarrow as pa

        tool = Anchors()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                found = [tool.snippets(t)[0] for t in batch.column(0).slice(at, 1024).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["gram"])

    more = rows.select("data").mapInArrow(grams, "gram long").groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    return bitmap(more, "gram")


def _snippets(rows: DataFrame) -> DataFrame:
    """Snippets of grams that occur more than once, with their bytes."""
    met = _met(rows)

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        tool, table = Anchors(), met.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some, cols, contents = batch.slice(at, 256), [], []
                for doc, tie, data in zip(*(some.column(i).to_pylist() for i in range(3))):
                    gram, content, start, starts, anchor = tool.snippets(data)
                    keep = marked(table, gram)
                    s, k = start[keep], starts[keep]
                    ids = np.full(len(s), doc, np.int64), np.full(len(s), tie, np.int64)
                    cols.append((gram[keep].view(np.int64), content[keep].view(np.int64), *ids, s, k, anchor[keep]))
                    contents += [data[x : x + y] for x, y in zip(s.tolist(), (k + WINDOW - 1).tolist())]
                cols = [np.concatenate(c) for c in zip(*cols)] if cols else [np.zeros(0, np.int64)] * 7
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(contents, pa.binary())],
                                                 names=["gram", "content", "doc", "tie", "start", "starts", "anchor", "data"])

    out = stored(rows.mapInArrow(
        cut, "gram long, content long, doc long, tie long, start long, starts long, anchor long, data binary"), "repeat-snippets")
    met.destroy()
    return out


def _parted(heads: DataFrame) -> DataFrame:
    """Snippets of longer grams: the starts of each snippet by the range of places that its anchor has in their windows."""
    edges = [SPAN * i // PARTS for i in range(PARTS + 1)]
    ranges = F.array(*[F.struct(F.lit(a).alias("least"), F.lit(b - 1).alias("most")) for a, b in zip(edges, edges[1:])])
    # Starts low to high have the anchor at the places least to most; each of their windows holds the longer gram.
    rows = heads.withColumn("r", F.explode(ranges)).withColumn("low", F.expr("greatest(0L, anchor - r.most)"))
    rows = rows.withColumn("high", F.expr("least(starts - 1, anchor - r.least)")).where("low <= high")
    rows = rows.withColumn("longer", F.expr(f"substring(data, CAST(anchor - r.least + 1 AS INT), CAST({WINDOW} - r.most + r.least AS INT))"))
    rows = rows.withColumn("data", F.expr(f"substring(data, CAST(low + 1 AS INT), CAST(high - low + {WINDOW} AS INT))"))
    return rows.select(F.xxhash64("r.least", "longer").alias("gram"), F.xxhash64("data").alias("content"), "doc", "tie",
                       (F.col("start") + F.col("low")).alias("start"), (F.col("high") - F.col("low") + 1).alias("starts"), "data")


def _sorted_out(snippets: DataFrame):
    """Spans of snippets that are met earlier as a whole, the first snippet of each class of grams with several `classes`, and
    the bitmap that these are read by: to be destroyed when they are stored."""
    key = ["gram", "content"]
    classes = stored(
        snippets.groupBy(*key).agg(F.min(F.struct("doc", "start", "tie")).alias("first"), F.count("*").alias("n")), "repeat-classes"
    )
    whole = (
        snippets.drop("data").join(classes.where("n > 1").select(*key, "first"), key)
        .where("struct(first.doc, first.start) < struct(doc, start)")
        .select("doc", "tie", "start", (F.col("start") + F.col("starts") + WINDOW - 1).alias("stop"))
    )
    mixed = stored(classes.groupBy("gram").agg(F.count("*").alias("classes")).where("classes > 1"), "repeat-mixed")
    heads = classes.join(mixed, "gram").select(*key, "classes", "first.doc", "first.start")
    met = bitmap(mixed, "gram")

    def some(batches):
        import pyarrow as pa

        # Bytes of snippets that no suffix array needs do not reach the shuffle.
        for batch in batches:
            yield batch.filter(pa.array(marked(met.value, batch.column(0).to_numpy())))

    return whole, snippets.mapInArrow(some, snippets.schema).join(heads, [*key, "doc", "start"]), met


def repeated_windows(lanes, docs, starts, counts):
    """Windows of snippets that start earlier in another snippet of their lane: snippet, offset and hit of each window.

    lanes: lists of snippets' bytes; docs, starts, counts: document, first start and number of starts of each snippet, lane by
    lane. All lanes are sorted together.
    """
    import numpy as np

    # A lane: its snippets, each with an end of 1, and an end of 0 (UTF-8 has no bytes above 244).
    data = [b"".join([x for s in lane for x in (s.translate(_RAISED), b"\1")]) + b"\0" for lane in lanes]
    size = np.array([len(x) for x in data])
    text = np.frombuffer(b"".join(data), np.uint8)
    used = np.zeros(256, np.int32)
    used[np.unique(text)] = 1
    letters = np.cumsum(used) - 1
    T = np.zeros((len(lanes), int(size.max())), np.int32)
    inside = np.arange(T.shape[1])[None, :] < size[:, None]
    T[inside] = letters[text]
    first = np.cumsum(size) - size
    order = (suffix_arrays(T, size, int(used.sum())) + first[:, None])[inside]
    common, _ = permuted_prefixes(text, order, first, WINDOW)

    length = np.array([len(s) + 1 for lane in lanes for s in lane])
    lane = np.repeat(np.arange(len(lanes)), [len(x) for x in lanes])
    place = np.cumsum(length) - length + lane
    snippet = np.repeat(np.arange(len(length)), counts)
    offset = np.arange(len(snippet)) - np.repeat(np.cumsum(counts) - counts, counts)
    # Suffixes that agree in WINDOW bytes stand together in their order; the number of such a group for each place.
    group = np.empty(len(text), np.int64)
    group[order] = np.cumsum(common[order] < WINDOW)
    group = group[place[snippet] + offset]
    doc, start = docs[snippet], starts[snippet] + offset
    by = np.lexsort((start, doc, group))
    head = np.flatnonzero(np.diff(group[by], prepend=-1))
    lead = by[np.repeat(head, np.diff(np.append(head, len(by))))]
    hit = np.zeros(len(by), bool)
    hit[by] = (doc[by] != doc[lead]) | (start[by] != start[lead])
    return snippet, offset, hit


def _matches(classes: DataFrame) -> DataFrame:
    """(doc, start, stop): bytes that windows of class heads cover although they start earlier in another class."""

    def search(batches):
        import numpy as np
        import pyarrow as pa

        names = ["doc", "tie", "start", "stop", "one", "two"]
        up = _powers(WINDOW + 1)[0]

        def solved(lanes, many):
            rows = [s for lane in lanes for s in lane]
            doc, start, count, tie = (np.array([r[i] for r in rows], np.int64) for i in (0, 1, 2, 4))
            wide = np.repeat(many, [len(x) for x in lanes])
            snippet, offset, hit = repeated_windows([[s[3] for s in lane] for lane in lanes], doc, start, count)
            h = np.flatnonzero(hit)
            # Neighbouring starts of one snippet are one run.
            new = np.flatnonzero((np.diff(h, prepend=-2) > 1) | (np.diff(snippet[h], prepend=-1) != 0))
            last = np.append(new[1:], len(h))[: len(new)] - 1
            a, b = h[new], h[last]
            none = pa.nulls(len(a), pa.int64())
            found = [[doc[snippet[a]], tie[snippet[a]], start[snippet[a]] + offset[a], start[snippet[b]] + offset[b] + WINDOW]]
            yield pa.RecordBatch.from_arrays([*[pa.array(x, pa.int64()) for x in found[0]], none, none], names=names)
            # What stays first in a lane of a gram with several lanes meets the others by its hash.
            f = np.flatnonzero(~hit & wide[snippet])
            data = [np.frombuffer(r[3], np.uint8) for r in rows]
            for i in range(0, len(f), 8192):
                some = f[i : i + 8192]
                s, o = snippet[some], offset[some]
                bytes_ = np.stack([data[x][y : y + WINDOW] for x, y in zip(s.tolist(), o.tolist())]).astype(np.uint64) + np.uint64(1)
                one = mix((bytes_ * up[:WINDOW]).sum(1, dtype=np.uint64))
                two = mix(bytes_ * np.uint64(_ODD[0]) + np.arange(WINDOW, dtype=np.uint64) * np.uint64(_ODD[1])).sum(1, dtype=np.uint64)
                at = start[s] + o
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (doc[s], tie[s], at, at + WINDOW, one.view(np.int64), two.view(np.int64))], names=names)

        def batches_of(groups):
            """Lanes of like length together, so that little of a batch is empty."""
            groups.sort(key=lambda g: sum(len(s[3]) for s in g[0]))
            lanes, many, widest = [], [], 0
            for lane, wide in groups:
                size = sum(len(s[3]) + 1 for s in lane) + 1
                if lanes and (len(lanes) + 1) * size > BATCH:
                    yield from solved(lanes, many)
                    lanes, many = [], []
                lanes.append(lane), many.append(wide)
            if lanes:
                yield from solved(lanes, many)

        key, lane, wide, groups, held = None, [], False, [], 0
        for batch in batches:
            for gram, block, blocks, doc, tie, start, starts, data in zip(*(c.to_pylist() for c in batch.columns)):
                if (gram, block) != key:
                    if len(lane) > 1 or lane and wide:
                        groups.append((lane, wide))
                    if held > 8 * BATCH:
                        yield from batches_of(groups)
                        groups, held = [], 0
                    key, lane, wide = (gram, block), [], blocks > 1
                lane.append((doc, start, starts, data, tie))
                held += len(data)
        if len(lane) > 1 or lane and wide:
            groups.append((lane, wide))
        yield from batches_of(groups)

    laned = classes.withColumn("blocks", F.ceil(F.col("classes") / LANE)).withColumn("block", F.pmod("content", F.col("blocks")))
    laned = laned.repartition("gram", "block").sortWithinPartitions("gram", "block")
    found = stored(
        laned.select("gram", "block", "blocks", "doc", "tie", "start", "starts", "data").mapInArrow(
            search, "doc long, tie long, start long, stop long, one long, two long"), "repeat-matches")
    heads = found.where("one IS NOT NULL")
    first = heads.groupBy("one", "two").agg(F.min(F.struct("doc", "start")).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = heads.join(first, ["one", "two"]).where("first < struct(doc, start)")
    place = ["doc", "tie", "start", "stop"]
    return found.where("one IS NULL").select(*place).unionByName(later.select(*place))


def covered(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tie, spans): for each id (null as NO_ID) and text hash the spans of bytes to remove, in order; they may overlap."""
    rows = docs.select(F.coalesce(F.col(ident).cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("tie"),
                       F.coalesce(F.col(text), F.lit("")).cast("binary").alias("data"))
    snippets = _snippets(rows.where(F.octet_length("data") >= WINDOW))
    whole, heads, met = _sorted_out(snippets)
    heads = stored(heads, "repeat-heads")
    met.destroy()
    again, parts, met = _sorted_out(_parted(heads.where(F.col("classes") > LANE)))
    columns = ["gram", "content", "classes", "doc", "tie", "start", "starts", "data"]
    parts = _matches(heads.where(F.col("classes") <= LANE).select(*columns).unionByName(parts.select(*columns)))
    met.destroy()  # the matches are stored
    spans = whole.unionByName(again).unionByName(parts)
    return spans.groupBy("doc", "tie").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def deduplicated(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of docs and: repeat_bytes, repeat_spans (start and stop of each maximal removed run), repeat_kept (binary)."""
    spans = stored(covered(docs, ident, text), "repeat-spans")
    # Overlapping and touching spans are one run.
    none = "array_remove(array(struct(0L AS start, 0L AS stop)), struct(0L AS start, 0L AS stop))"
    runs = F.expr(f"""aggregate(spans, {none}, (r, s) -> if(size(r) > 0 AND r[size(r) - 1].stop >= s.start,
        slice(r, 1, size(r) - 1) || array(struct(r[size(r) - 1].start AS start, greatest(r[size(r) - 1].stop, s.stop) AS stop)),
        r || array(struct(s.start AS start, s.stop AS stop))))""")
    merged = spans.select(F.col("doc").alias("repeat_doc"), F.col("tie").alias("repeat_tie"), runs.alias("repeat_found"))
    same = (F.coalesce(F.col(ident).cast("long"), F.lit(NO_ID)) == F.col("repeat_doc")) & (F.xxhash64(text) == F.col("repeat_tie"))
    out = (
        docs.join(merged, same, "left")
        .withColumn("repeat_spans", F.coalesce("repeat_found", F.expr(none)))
        .withColumn("repeat_data", F.coalesce(F.col(text), F.lit("")).cast("binary"))
        .withColumn("repeat_bytes", F.octet_length("repeat_data").cast("long"))
    )
    kept = F.expr("""if(size(repeat_spans) = 0, repeat_data, aggregate(
        concat(repeat_spans, array(struct(repeat_bytes AS start, repeat_bytes AS stop))), struct(0L AS at, CAST('' AS BINARY) AS data),
        (s, r) -> struct(r.stop AS at, concat(s.data, substring(repeat_data, CAST(s.at + 1 AS INT), CAST(r.start - s.at AS INT))) AS data),
        s -> s.data))""")
    return out.withColumn("repeat_kept", kept).select(*docs.columns, "repeat_bytes", "repeat_spans", "repeat_kept")
