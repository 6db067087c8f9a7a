"""N-gram Jaccard join with signature trees.

Documents are sets of distinct word shingles; two link if they share at least 3/4 of their union. The join is exact.

1. Rows with equal sets become one class. Each class keeps a bitmap of its shingles.
2. Shingles have one order for all: rare first. Classes that link share one of their first n - ceil(3n/4) + 1
   shingles, so they meet in the list of such a shingle. The order decides the work, never the result; it comes from
   counts that each task gathers from its part of the corpus, of which the most frequent are handed to all tasks.
   Long lists are of few kinds: copies of one text share many shingles, each with nearly the same members. Lists that agree in
   their first members by two hashes are merged into one, so their pairs do not come once for each shingle.
3. Each list becomes a signature tree: nodes hold the OR of their members' bitmaps, the range of their sizes and the most
   shingles that one member's bitmap hides. A dual traversal drops every pair of nodes that cannot reach the
   overlap that their least sizes need, and ends in candidate pairs of members.
4. Candidates are first bounded by the counts of their shingles in BUCKETS buckets, which also tell large sets apart; what can
   still link is verified on whole sets, and links become components. First only the best candidates of each member are
   verified; then all candidates between classes that are not yet connected. A long list is cut into blocks,
   one task for each pair of blocks.

Null or empty texts and texts without words have no shingles and link to nothing, not even to each other. With fewer than
5 words the whole sequence is one shingle. Rows with equal ids or equal texts are rows of one class each. Null ids link like others; a
component's id is its least non-null id. Empty tables give empty results; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterline.llm.bitmaps import bitmap, marked
from asterline.llm.components import components
from asterline.llm.textparts import SHINGLE, shingles
from asterline.session import stored

#: Links need 100 * shared >= 75 * union.
SHARE = 75
#: Bits of a bitmap, members of a leaf, children of a node.
BITS = 1024
LEAF = 16
FAN = 8
#: Members of a list that meet in one task come from two blocks of about this size.
BLOCK = 2048
#: Shingles known as frequent: at most so many, the most frequent, met twice in some task's part of the corpus.
FREQUENT = 1 << 17
#: Buckets of a sketch, and bits of the bitmap of shingles with long lists (LEAF members or more).
BUCKETS = 4096
LONG_BITS = 24
#: Best candidates of each member that are verified before the rest.
BEST = 1


def needed(a, b):
    """The least overlap of sets of sizes a and b that links them."""
    return -(-SHARE * (a + b) // (100 + SHARE))


def signature(hashes):
    """Bits of the hashes as 64-bit words, and how many hashes share a bit with another before them."""
    import numpy as np

    bits = np.zeros(BITS, np.uint8)
    bits[(hashes % np.uint64(BITS)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64), len(hashes) - int(bits.sum())


def sketch(hashes) -> bytes:
    """How many of the hashes fall into each bucket, compressed byte by byte of equal rank."""
    import numpy as np
    import zstandard

    counts = np.bincount((hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS).astype("<u4")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(counts.view(np.uint8).reshape(-1, 4).T).tobytes())


def reachable(one: bytes, two: bytes) -> bool:
    """Whether sets of these sketches can link: what they share is in equal buckets, at most the lesser count of each."""
    import numpy as np
    import zstandard

    whole = zstandard.ZstdDecompressor().decompress
    a, b = (np.ascontiguousarray(np.frombuffer(whole(x), np.uint8).reshape(4, -1).T).view("<u4").astype(np.int64) for x in (one, two))
    return int(np.minimum(a, b).sum()) >= needed(int(a.sum()), int(b.sum()))


class Tree:
    """A signature tree over sets given by size, hidden shingles and bitmap; members in the order given."""

    def __init__(self, sizes, hidden, bitmaps):
        import numpy as np

        n = len(sizes)
        edges = np.arange(0, n, LEAF)
        self.span = [np.stack([edges, np.minimum(edges + LEAF, n)], 1)]  # members of a leaf, then children of a node
        reduce = lambda f, x, at: f.reduceat(x, at, axis=0)
        self.bits = [reduce(np.bitwise_or, bitmaps, edges)]
        self.least = [reduce(np.minimum, sizes, edges)]
        self.most = [reduce(np.maximum, sizes, edges)]
        self.hidden = [reduce(np.maximum, hidden, edges)]
        while len(self.least[-1]) > 1:
            m = len(self.least[-1])
            edges = np.arange(0, m, FAN)
            self.span.append(np.stack([edges, np.minimum(edges + FAN, m)], 1))
            self.bits.append(reduce(np.bitwise_or, self.bits[-1], edges))
            self.least.append(reduce(np.minimum, self.least[-1], edges))
            self.most.append(reduce(np.maximum, self.most[-1], edges))
            self.hidden.append(reduce(np.maximum, self.hidden[-1], edges))

    def pairs(self):
        """Pairs of leaves (i <= j) that may hold a link; whole levels of node pairs are tested at once."""
        import numpy as np

        level = len(self.least) - 1
        i = j = np.zeros(1, np.int64)
        while True:
            keep = possible(self.least[level], self.most[level], self.hidden[level], self.bits[level], i, j)
            i, j = i[keep], j[keep]
            if level == 0 or not len(i):
                return i, j
            span = self.span[level]
            i, j = spread(span[i, 0], span[i, 1], span[j, 0], span[j, 1])
            i, j = i[i <= j], j[i <= j]
            level -= 1


def spread(a0, a1, b0, b1):
    """All (x, y) with x in a0..a1 and y in b0..b1, for each given pair of spans."""
    import numpy as np

    na, nb = a1 - a0, b1 - b0
    total = na * nb
    which = np.repeat(np.arange(len(total)), total)
    k = np.arange(int(total.sum())) - np.repeat(np.cumsum(total) - total, total)
    return a0[which] + k // nb[which], b0[which] + k % nb[which]


def possible(least, most, hidden, bits, i, j):
    """Whether members under nodes i and j can reach the overlap that their least sizes need."""
    import numpy as np

    out = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        common = np.bitwise_count(bits[a] & bits[b]).sum(1, dtype=np.int64) + np.minimum(hidden[a], hidden[b])
        reach = np.minimum(common, np.minimum(most[a], most[b]))
        out[at : at + (1 << 16)] = reach >= needed(least[a], least[b])
    return out


def candidates(nodes, sizes, hidden, bitmaps, component, best):
    """Candidate pairs of one list between different components; the `best` nearest of each member, or all."""
    import numpy as np

    order = np.lexsort((bitmaps[:, 0], sizes))
    nodes, sizes, hidden, bitmaps, component = (x[order] for x in (nodes, sizes, hidden, bitmaps, component))
    tree = Tree(sizes, hidden, bitmaps)
    i, j = tree.pairs()
    out = [], [], []
    for at in range(0, len(i), 4096):
        a, b = i[at : at + 4096], j[at : at + 4096]
        leaf = tree.span[0]
        x, y = spread(leaf[a, 0], leaf[a, 1], leaf[b, 0], leaf[b, 1])
        some = (x < y) & (component[x] != component[y])
        x, y = x[some], y[some]
        common = np.bitwise_count(bitmaps[x] & bitmaps[y]).sum(1, dtype=np.int64) + np.minimum(hidden[x], hidden[y])
        reach = np.minimum(common, np.minimum(sizes[x], sizes[y]))
        # What a set can share is also what its own bits leave after those that the other lacks.
        good = reach >= needed(sizes[x], sizes[y])
        for to, v in zip(out, (x[good], y[good], reach[good] / (sizes[x] + sizes[y])[good])):
            to.append(v)
    x, y, near = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in out)
    if best and len(x):
        who, pair = np.concatenate([x, y]), np.tile(np.arange(len(x)), 2)
        by = np.lexsort((-near[pair], who))
        rank = np.arange(len(by)) - np.searchsorted(who[by], who[by])
        pair = np.unique(pair[by[rank < best]])
        x, y = x[pair], y[pair]
    return nodes[x], nodes[y]


def _text(docs: DataFrame, ident: str, text: str) -> DataFrame:
    return docs.select(F.col(ident).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))


def frequent(docs: DataFrame, text: str = "text"):
    """The most frequent shingles as (hashes ascending, counts): at most FREQUENT, whatever the size of the corpus."""
    import numpy as np

    def count(batches):
        import pyarrow as pa

        held, size = [], 0

        def counted():
            u, n = np.unique(np.concatenate(held), return_counts=True)
            u, n = u[n > 1], n[n > 1]
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])

        for batch in batches:
            for t in batch.column(0).to_pylist():
                held.append(shingles((t or "").encode()))
                size += len(held[-1])
                if size > 4 << 20:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    found = (
        docs.select(text).mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
        .where("n > 8").orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    )
    token = found["token"].to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], found["n"].to_numpy()[order]


def sets(docs: DataFrame, known, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: size, 128-bit identity of the set, bitmap, and its first shingles in the common order."""
    token, count = known

    def measure(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                size, one, two, hidden, bits, first = [], [], [], [], [], []
                for t in some.column(2).to_pylist():
                    s = shingles((t or "").encode())
                    n = len(s)
                    b, h = signature(s)
                    if len(token) and n:
                        k = np.searchsorted(token, s).clip(max=len(token) - 1)
                        weight = np.where(token[k] == s, count[k], 0)
                        s_ordered = s[np.argsort(weight, kind="stable")] if weight.any() else s
                    else:
                        s_ordered = s
                    size.append(n)
                    one.append(int(s.sum(dtype=np.uint64).view(np.int64)) if n else 0)
                    two.append(int(np.bitwise_xor.reduce(s * np.uint64(0x9E3779B97F4A7C15) ^ (s >> np.uint64(31))).view(np.int64)) if n else 0)
                    hidden.append(h)
                    bits.append(b.tobytes())
                    first.append(s_ordered[: n - -(-SHARE * n // 100) + 1].view(np.int64) if n else s.view(np.int64))
                offsets = pa.array(np.cumsum([0, *map(len, first)]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    some.column(0), some.column(1), pa.array(size, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64()),
                    pa.array(hidden, pa.int64()), pa.array(bits, pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(first)))],
                    names=["doc_id", "tie", "size", "one", "two", "hidden", "bits", "first"])

    return _text(docs, ident, text).mapInArrow(
        measure, "doc_id long, tie long, size long, one long, two long, hidden long, bits binary, first array<long>"
    )


def lists(classes: DataFrame) -> DataFrame:
    """(list, n, node): classes that share a shingle of their prefix, each different list once, long ones merged and as pairs of blocks."""
    shared = classes.select(F.explode("first").alias("token")).groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    shared = stored(shared, "jaccard-shared")
    met, often = bitmap(shared, "token"), bitmap(shared.where(F.col("n") >= LEAF), "token", LONG_BITS)

    def members_of(long):
        def some(batches):
            import numpy as np
            import pyarrow as pa

            # Most shingles occur once; those that cannot be shared do not reach the shuffle.
            for batch in batches:
                first = batch.column(1)
                token = first.flatten().to_numpy()
                node = np.repeat(batch.column(0).to_numpy(), np.diff(first.offsets.to_numpy()))
                keep = marked(met.value, token) & (marked(often.value, token) == long)
                yield pa.RecordBatch.from_arrays([pa.array(node[keep]), pa.array(token[keep])], names=["node", "token"])

        tokens = classes.select("node", "first").mapInArrow(some, "node long, token long")
        return tokens.join(shared, "token").select("token", "node", "n")

    # The bitmap may let short lists through to the long ones.
    long = stored(members_of(True), "jaccard-long")
    firsts = long.where(F.col("n") >= LEAF).groupBy("token").agg(
        F.min(F.xxhash64("node")).alias("one"), F.min(F.xxhash64("node", F.lit(1))).alias("two"))
    merged = stored(long.join(firsts, "token").select(F.xxhash64("one", "two").alias("token"), "node").distinct(), "jaccard-merged")
    merged = merged.join(merged.groupBy("token").agg(F.count("*").alias("n")), "token")
    found = members_of(False).unionByName(long.where(F.col("n") < LEAF)).unionByName(merged)
    found = found.withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    # Block pairs (i, j) with i <= j that this member belongs to.
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
                        lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j")))
    members = found.select("token", F.explode(pairs).alias("p"), "node").groupBy("token", "p.i", "p.j").agg(
        F.sort_array(F.collect_list("node")).alias("nodes"))
    once = members.groupBy(F.xxhash64("nodes").alias("list"), F.size("nodes").alias("n")).agg(F.first("nodes").alias("nodes"))
    out = stored(once.where("n > 1").select("list", "n", F.explode("nodes").alias("node")), "jaccard-lists")
    met.destroy(), often.destroy()
    return out


def _candidates(listed: DataFrame, classes: DataFrame, best: int | None) -> DataFrame:
    """Candidate pairs (a, b) of all lists; classes carry their component so far."""

    def join(batches):
        import numpy as np
        import pyarrow as pa

        held: list = []

        def groups(table, last):
            where = table.column("list").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(where)) + 1).tolist(), len(where)]
            stop = len(edges) - 1 if last else len(edges) - 2
            cols = [table.column(c).to_numpy() for c in ("node", "size", "hidden", "component")]
            bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(-1, BITS // 64)
            a, b = [], []
            for s, e in zip(edges[:stop], edges[1 : stop + 1]):
                if e - s > 1:
                    n, z, h, c = (x[s:e] for x in cols)
                    x, y = candidates(n, z, h, bits[s:e], c, best)
                    a.append(x), b.append(y)
            out = pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for v in (a, b)], names=["a", "b"])
            return out, table.slice(edges[stop])

        rest = None
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < 20_000:
                continue
            table = pa.Table.from_batches([*(rest.to_batches() if rest is not None else []), *held])
            out, rest = groups(table, False)
            held = []
            yield out
        table = [*(rest.to_batches() if rest is not None else []), *held]
        if table:
            yield groups(pa.Table.from_batches(table), True)[0]

    rows = listed.join(classes.select("node", "size", "hidden", "bits", "component"), "node")
    rows = rows.repartition("list", "n").sortWithinPartitions("list", "n")
    pairs = rows.select("list", "node", "size", "hidden", "component", "bits").mapInArrow(join, "a long, b long")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _linked(pairs: DataFrame, classes: DataFrame, docs: DataFrame, ident: str, text: str) -> DataFrame:
    """The candidates whose whole sets overlap enough, built where a pair meets from one compressed text of each class.

    Hashes do not compress and take more bytes than the words they stand for, so texts travel, and only those that stand for a class.
    """
    ends = [classes.select(F.col("node").alias(x), F.col("doc_id").alias(f"{x}_doc"), F.col("tie").alias(f"{x}_tie")) for x in "ab"]
    pairs = stored(pairs.join(ends[0], "a").join(ends[1], "b"), "jaccard-ends")
    named = pairs.columns
    wanted = F.array(*[F.xxhash64(f"{x}_doc", f"{x}_tie") for x in "ab"])
    met = bitmap(pairs.select(F.explode(wanted).alias("key")), "key")

    def pack(batches):
        import pyarrow as pa
        import zstandard

        small = zstandard.ZstdCompressor(level=6).compress
        for batch in batches:
            batch = batch.filter(pa.array(marked(met.value, batch.column(3).to_numpy())))
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                data = [(t or "").encode() for t in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[:2], *[pa.array([f(x) for x in data], pa.binary()) for f in (small, lambda x: sketch(shingles(x)))]],
                    names=["doc_id", "tie", "packed", "sketch"])

    def bound(batches):
        import pyarrow as pa

        for batch in batches:
            keep = [reachable(x, y) for x, y in zip(*(batch.column(c).to_pylist() for c in ("sa", "sb")))]
            yield batch.filter(pa.array(keep, pa.bool_())).select(named)

    def verify(batches):
        import numpy as np
        import pyarrow as pa
        import zstandard

        whole = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                one, two = (shingles(whole(batch.column(c)[i].as_py())) for c in (2, 3))
                overlap = len(np.intersect1d(one, two, assume_unique=True))
                keep[i] = 100 * overlap >= SHARE * (len(one) + len(two) - overlap)
            yield batch.select([0, 1]).filter(pa.array(keep))

    keyed = _text(docs, ident, text).withColumn("key", F.xxhash64("doc_id", "tie"))
    # A row repeated with id and text stands for its class once.
    texts = keyed.mapInArrow(pack, "doc_id long, tie long, packed binary, sketch binary").dropDuplicates(["doc_id", "tie"])
    texts = stored(texts, "jaccard-texts")
    met.destroy()

    def brought(pairs, what):
        for x in "ab":
            side = texts.select(F.col("doc_id").alias("s_doc"), F.col("tie").alias("s_tie"), F.col(what).alias(f"s{x}"))
            on = F.col(f"{x}_doc").eqNullSafe(F.col("s_doc")) & (F.col(f"{x}_tie") == F.col("s_tie"))
            pairs = pairs.join(side, on).drop("s_doc", "s_tie")
        return pairs

    # Sketches are a small part of texts: what they rule out brings no text.
    near = stored(brought(pairs, "sketch").mapInArrow(bound, pairs.schema), "jaccard-near")
    return brought(near, "packed").select("a", "b", "sa", "sb").mapInArrow(verify, "a long, b long")


def joined(docs: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, tie, n_shingles, component_id, component) for every row; tie is the hash of its text.

    component_id is a label that components may share (null where all ids are null, or one id with several texts);
    component is the component itself, null without shingles.
    """
    rows = stored(sets(docs, frequent(docs, text), ident, text), "jaccard-rows")
    key = ["size", "one", "two"]
    classes = rows.where("size > 0").groupBy(*key).agg(
        F.min(F.struct("doc_id", "tie")).alias("rep"), F.first("hidden").alias("hidden"), F.first("bits").alias("bits"),
        F.first("first").alias("first"), F.min("doc_id").alias("least"))
    classes = stored(
        classes.select(*key, "rep.doc_id", "rep.tie", "least", "hidden", "bits", "first").withColumn(
            "node", F.monotonically_increasing_id()), "jaccard-classes")
    listed = lists(classes)
    pairs = stored(_candidates(listed, classes.withColumn("component", F.col("node")), BEST), "jaccard-pairs")
    links = stored(_linked(pairs, classes, docs, ident, text), "jaccard-links")
    found = components(links)
    named = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    more = stored(_candidates(listed, named, None).join(pairs, ["a", "b"], "left_anti"), "jaccard-pairs")
    if not more.isEmpty():
        links = links.unionByName(stored(_linked(more, classes, docs, ident, text), "jaccard-links"))
        found = components(links)
        named = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stored(named.select("node", *key, "least", "component"), "jaccard-named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = named.join(least, "component").select(*key, "component_id", "component")
    own = rows.select("doc_id", "tie", *key).join(by_class, key, "left")
    return own.select("doc_id", "tie", F.col("size").alias("n_shingles"),
                      F.coalesce("component_id", "doc_id").alias("component_id"), "component")
