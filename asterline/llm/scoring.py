"""LM scoring by cross-entropy difference.

Two n-gram models over one vocabulary: the target's, of the documents that a label marks, and the background's, of all documents.
A document's score is the mean over its tokens of target loss minus background loss: the lower, the more like the target.

Both models are interpolated bigrams with add-one unigrams. Every word and every pair of words has counts of its own, by its
64-bit hash, however many there are. The unigram's vocabulary is the corpus's distinct words, and at least 2**WORD_BITS.

1. Each task takes its documents in batches of about BATCH tokens and counts the distinct words and pairs of each. A batch's documents
   are one file in the shared folder; only its path travels with the counts.
2. Counts are dealt by ranges of hashes into buckets, whose number follows the size of the corpus. A bucket sums up each word and
   pair over all batches, and answers each batch with the sums of its own. A word or pair is in a bucket once for each batch, so
   the most frequent ones weigh no more than rare ones.
3. A batch's answers meet in one task, which reads its file and scores its documents. No model is ever in one place.

A task that runs again makes the same batches, as long as the table's partitions give their rows in the same order.

Null and empty texts have no tokens, no losses and no score (null). Null ids are scored like others. Labels without a document
count for nothing, repeated labels count once. Without any target document the target model is the uniform one.
Rows with equal ids are scored one by one. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asterline.llm.bitmaps import bitmap
from asterline.llm.bitmaps import marked as may_be_in
from asterline.llm.files import whole_file
from asterline.llm.textparts import mix, word_hashes
from asterline.session import scratch, stored

#: The unigrams' vocabulary has at least so many words, as a power of two.
WORD_BITS = 18
#: Weight of the bigram in each model; the unigram has the rest.
PAIR_WEIGHT = 0.6
#: Tokens of a batch, and bytes of text for each bucket of counts.
BATCH = 3 << 19
BUCKET = 16 << 20
#: Kinds of rows: counts of words, counts of pairs, path of the documents; sums of a bucket.
WORDS, PAIRS, DOCUMENT, SUMS = range(4)


def utf8(column):
    """The bytes of each text of an Arrow column, one at a time; null ones have none."""
    for text in column:
        data = text.as_buffer()
        yield data.to_pybytes() if data else b""


def slots(text: bytes):
    """Hashes of words, of the word before each (0 before the first), and of the pairs."""
    import numpy as np

    w = word_hashes(text)
    before = np.concatenate([np.zeros(1, np.uint64), w[:-1]]) if len(w) else w
    return w, before, mix(before * np.uint64(0x9E3779B97F4A7C15) + w)


def distinct(parts):
    """Of a batch's documents: the distinct words (with what stands before first ones) and pairs, ascending, and places in them."""
    import numpy as np

    sizes = np.array([len(p[0]) for p in parts])
    # 0 is the least hash, so what stands before first words has place 0.
    words, at = np.unique(np.concatenate([np.zeros(1, np.uint64), *[p[0] for p in parts]]), return_inverse=True)
    before_at = at[:-1].copy()
    before_at[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
    pairs, pair_at = np.unique(np.concatenate([p[2] for p in parts]), return_inverse=True)
    return words, at[1:], before_at, pairs, pair_at


def squeezed(numbers) -> bytes:
    """Whole numbers, compressed byte by byte of equal rank."""
    import numpy as np
    import pyarrow as pa

    return pa.compress(np.ascontiguousarray(np.ascontiguousarray(numbers).reshape(-1, 1).view(np.uint8).T), codec="zstd", asbytes=True)


def spread(data: bytes, height: int, n: int):
    """The `height` rows of `n` 64-bit numbers that were squeezed."""
    import numpy as np
    import pyarrow as pa

    flat = np.frombuffer(pa.decompress(data, 8 * height * n, codec="zstd", asbytes=True), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(flat.T).view(np.int64).reshape(height, n)


def counted(docs: DataFrame, buckets: int, met) -> DataFrame:
    """Documents (id, text, target, label) in batches, and each batch's counts by bucket; rows whose label may be in met stay out.

    Counts are rows of `n` numbers: of target and background, of words also as the first of a pair. A batch's documents are `n` rows of
    the file whose path stands in place of counts.
    """
    folder = scratch(docs.sparkSession, "scoring-texts")

    def count(rows):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        batch = TaskContext.get().partitionId() << 32
        bounds = np.array([i * 2**64 // buckets for i in range(buckets)], np.uint64)
        names = ["batch", "kind", "bucket", "n", "hashes", "counts"]

        def emit(slices, parts, chosen):
            path, options = f"{folder}/{batch}.arrow", pa.ipc.IpcWriteOptions(compression="zstd")
            with whole_file(path) as out, pa.ipc.new_stream(out, slices[0].schema, options=options) as to:
                for x in slices:
                    to.write_batch(x)
            yield pa.RecordBatch.from_arrays([
                pa.array([batch]), pa.array([DOCUMENT], pa.int32()), pa.array([(batch >> 32) % buckets]), pa.array([len(parts)]),
                pa.nulls(1, pa.binary()), pa.array([path.encode()], pa.binary())], names=names)
            sizes = [len(p[0]) for p in parts]
            if not sum(sizes):
                return
            words, word_at, before_at, pairs, pair_at = distinct(parts)
            own = np.repeat(chosen, sizes)
            tables = (WORDS, words, (word_at[own], word_at, before_at[own], before_at)), (PAIRS, pairs, (pair_at[own], pair_at))
            for which, keys, places in tables:
                counts = np.stack([np.bincount(p, minlength=len(keys)) for p in places]).astype(np.int64)
                edges = np.append(np.searchsorted(keys, bounds), len(keys))
                full = np.flatnonzero(np.diff(edges))
                n = len(full)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, batch)), pa.array(np.full(n, which, np.int32)), pa.array(full), pa.array(np.diff(edges)[full]),
                    pa.array([squeezed(np.diff(keys[edges[b] : edges[b + 1]], prepend=np.uint64(0))) for b in full], pa.binary()),
                    pa.array([squeezed(counts[:, edges[b] : edges[b + 1]]) for b in full], pa.binary())], names=names)

        slices, parts, chosen, size = [], [], [], 0
        for rows_of in rows:
            label = rows_of.column(3)
            named = may_be_in(met.value, label.fill_null(0).to_numpy())
            rows_of = rows_of.filter(pa.array(~named | label.is_null().to_numpy(zero_copy_only=False)))
            texts = rows_of.select([0, 1])
            start = 0
            for i, (t, own) in enumerate(zip(utf8(rows_of.column(1)), rows_of.column(2).to_pylist())):
                parts.append(slots(t))
                chosen.append(own)
                size += len(parts[-1][0])
                if size >= BATCH:
                    slices.append(texts.slice(start, i + 1 - start))
                    yield from emit(slices, parts, chosen)
                    slices, parts, chosen, size, start, batch = [], [], [], 0, i + 1, batch + 1
            if start < rows_of.num_rows:
                slices.append(texts.slice(start))
        if parts:
            yield from emit(slices, parts, chosen)

    return docs.mapInArrow(count, "batch long, kind int, bucket long, n long, hashes binary, counts binary")


def answered(counts: DataFrame, buckets: int) -> DataFrame:
    """For each batch and bucket the sums over all batches, in the order of the batch's hashes; of each bucket of words its totals.

    Paths of documents are handed on.
    """

    def add(rows):
        import numpy as np
        import pyarrow as pa

        def solved(key, group):
            kind, bucket = key
            batch, n = [g[0] for g in group], [g[1] for g in group]
            if kind == DOCUMENT:
                return told(batch, [kind] * len(group), bucket, n, [own.to_pybytes() for *_, own in group])
            height = 4 if kind == WORDS else 2
            hashes = [np.cumsum(spread(h, 1, n)[0].view(np.uint64), dtype=np.uint64) for _, n, h, _ in group]
            _, at = np.unique(np.concatenate(hashes), return_inverse=True)
            own = np.concatenate([spread(c, height, n) for _, n, _, c in group], 1)
            # Sums of doubles are exact below 2**53.
            sums = np.stack([np.bincount(at, weights=row) for row in own]).astype(np.int64)
            ends = np.cumsum([len(h) for h in hashes])
            found = [squeezed(sums[:, at[e - len(h) : e]]) for h, e in zip(hashes, ends)]
            kinds = [kind] * len(group)
            if kind == WORDS:
                batch.append(-1), kinds.append(SUMS), n.append(3)
                found.append(squeezed(np.array([np.count_nonzero(sums[1]), sums[0].sum(), sums[1].sum()], np.int64)))
            return told(batch, kinds, bucket, n, found)

        def told(batch, kinds, bucket, n, found):
            return pa.RecordBatch.from_arrays(
                [pa.array(batch, pa.int64()), pa.array(kinds, pa.int32()), pa.array([bucket] * len(batch), pa.int64()), pa.array(n, pa.int64()),
                 pa.array(found, pa.binary())],
                names=["batch", "kind", "bucket", "n", "counts"])

        key, group = None, []
        for some in rows:
            for batch, kind, bucket, n, hashes, own in zip(*(c.to_pylist() for c in some.columns[:4]), *some.columns[4:]):
                if (kind, bucket) != key:
                    if group:
                        yield solved(key, group)
                    key, group = (kind, bucket), []
                group.append((batch, n, hashes.as_buffer(), own.as_buffer()))
        if group:
            yield solved(key, group)

    dealt = counts.repartition(buckets, "kind", "bucket").sortWithinPartitions("kind", "bucket")
    return dealt.mapInArrow(add, "batch long, kind int, bucket long, n long, counts binary")


def totals(answers: DataFrame) -> tuple[int, int, int]:
    """(size of the vocabulary, tokens of the target, tokens of the background)."""

    def add(rows):
        import numpy as np
        import pyarrow as pa

        out = np.zeros(3, np.int64)
        for some in rows:
            for x in some.column(0).to_pylist():
                out += spread(x, 1, 3)[0]
        yield pa.RecordBatch.from_arrays([pa.array(out[i : i + 1]) for i in range(3)], names=["words", "target", "background"])

    parts = answers.where(F.col("kind") == SUMS).select("counts").mapInArrow(add, "words long, target long, background long")
    words, target, background = parts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "target", "background")]).first()
    return max(words, 1 << WORD_BITS), target, background


def losses(vocabulary: int, total: int, words, firsts, pairs):
    """Of each pair, from the counts of its word, of the word before it and of the pair."""
    import numpy as np

    single = (words + 1.0) / (total + vocabulary)
    # Where the first word was never seen, the unigram alone speaks.
    weight = np.where(firsts > 0, PAIR_WEIGHT, 0.0)
    return -np.log(weight * (pairs / np.maximum(firsts, 1)) + (1 - weight) * single)


def flagged(docs: DataFrame, marked: DataFrame, met, ident: str, text: str) -> DataFrame:
    """(id, text, target, label): rows that meet the labels, and all rows with the hash by which counted leaves out those that did.

    Texts that no label names go to one Python worker of a task only, and stay out of the shuffle. Those that meet the labels do so in a
    merge join, however few labels there are: else sifting and counting would be two workers of one task, which both keep their memory.
    """
    kind = docs.select(ident).schema[0].dataType.simpleString()

    def sift(rows):
        import pyarrow as pa

        for some in rows:
            yield some.select([0, 1]).filter(pa.array(may_be_in(met.value, some.column(2).to_numpy())))

    sifted = docs.select(F.col(ident).alias("id"), F.col(text).alias("text"), F.xxhash64(ident).alias("label"))
    some = sifted.mapInArrow(sift, f"id {kind}, text string").join(marked.hint("merge"), F.col("id") == F.col("label_id"), "left")
    some = some.select("id", "text", F.col("label_id").isNotNull().alias("target"), F.lit(None).cast("long").alias("label"))
    # A partition that is made again has its rows in the same order.
    some = some.sortWithinPartitions("id", "text")
    return sifted.select("id", "text", F.lit(False).alias("target"), "label").unionByName(some)


def scored(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", chosen: str = "quality = 1") -> DataFrame:
    """(id, n_tokens, target_loss, background_loss, score) of every row; losses are means over the tokens."""
    kind = docs.select(ident).schema[0].dataType.simpleString()
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = -(-size // BUCKET) or 1
    marked = labels.where(chosen).select(F.col(ident).alias("label_id")).where("label_id IS NOT NULL").distinct()
    met = bitmap(marked.select(F.xxhash64(F.col("label_id").cast(kind)).alias("label")), "label")

    rows = counted(flagged(docs, marked, met, ident, text), buckets, met)
    answers = stored(answered(rows, buckets), "scoring-answers")
    vocabulary, *sizes = totals(answers)

    def score(rows):
        import numpy as np
        import pyarrow as pa
        from pyarrow import fs

        def solved(found, path, height):
            store, at = fs.FileSystem.from_uri(path)
            with store.open_input_file(at) as file:
                slices = pa.ipc.open_stream(file).read_all().to_batches()
            parts = [slots(t) for s in slices for t in utf8(s.column(1))]
            if len(parts) != height:
                raise RuntimeError("the file of a batch does not have its documents")
            n = np.array([len(p[0]) for p in parts], np.int64)
            means = [np.zeros(len(n)), np.zeros(len(n))]
            if n.sum():
                words, word_at, before_at, pairs, pair_at = distinct(parts)
                sums = [np.concatenate([spread(c, h, m) for m, c in found[k]], 1) for k, h in ((WORDS, 4), (PAIRS, 2))]
                if (sums[0].shape[1], sums[1].shape[1]) != (len(words), len(pairs)):
                    raise RuntimeError("the answers of a batch do not match its words and pairs")
                # A pair tells its word and the word before it, so its losses are computed once.
                word, before = np.zeros((2, len(pairs)), np.int64)
                word[pair_at], before[pair_at] = word_at, before_at
                start = np.cumsum(n) - n
                for model, total in enumerate(sizes):
                    loss = losses(vocabulary, total, sums[0][model][word], sums[0][2 + model][before], sums[1][model])
                    run = np.concatenate([[0.0], np.cumsum(loss[pair_at])])
                    means[model] = (run[start + n] - run[start]) / np.maximum(n, 1)
            none, at = n == 0, 0
            for s in slices:
                own = slice(at, at + s.num_rows)
                at += s.num_rows
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), pa.array(n[own]), *[pa.array(x[own], mask=none[own]) for x in (*means, means[0] - means[1])]],
                    names=[ident, "n_tokens", "target_loss", "background_loss", "score"])

        key, found = None, {}
        for some in rows:
            for batch, kind, _, m, data in zip(*(c.to_pylist() for c in some.columns[:4]), some.column(4)):
                if batch != key:
                    key, found = batch, {WORDS: [], PAIRS: []}
                # The path of a batch's documents comes last.
                if kind == DOCUMENT:
                    yield from solved(found, data.as_py().decode(), m)
                else:
                    found[kind].append((m, data.as_buffer()))

    dealt = answers.where(F.col("kind") != SUMS).repartition(buckets, "batch")
    return dealt.sortWithinPartitions("batch", "kind", "bucket").mapInArrow(
        score, f"`{ident}` {kind}, n_tokens long, target_loss double, background_loss double, score double")
