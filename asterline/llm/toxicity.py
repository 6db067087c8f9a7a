"""Toxicity by compression distance: two zstandard dictionaries, one of toxic and one of ordinary text.

A text is cut into windows, its words in lower case. Each window is compressed with either dictionary, and the difference of the two
lengths says which text it comes from. Lengths are whole bytes, so a calibration turns each difference into a log-likelihood ratio
from its frequencies in windows of toxic and of ordinary documents; their sum over the square root of their number is the text's
distance, and a logistic curve with the labels' true shares turns the distance into a score from 0 to 1.

How the dictionaries are trained:

* Most words of a toxic text are ordinary. The toxic dictionary is trained on windows whose beginning is met at MET places or more and
  CONTRAST times as often as in ordinary ones, and is small; the other is trained on all windows of ordinary documents.
* Windows of ordinary documents that are still shorter with the toxic dictionary are added to the ordinary samples and that dictionary
  is trained anew, ROUNDS times.
* The trained bytes are used as content only, without tables of codes, so that a byte that matches nothing always costs eight
  bits. A trailer of bytes that no text holds stands in both dictionaries and behind each window: a block always has one
  match, and the next one counts.

Labels are read of rows whose fold is not held out. Fitting takes at most FIT labelled documents of a class, those with the least seeded
hashes of their ids, of at most FIT_BYTES each; a quarter of them calibrates and does not train. All documents are scored, whole.

Null and empty texts have no windows and the score of no evidence. A word longer than WINDOW bytes counts as several windows; texts of any
length are taken whole, a chunk of rows at a time. Of several labels of an id the toxic one counts, null labels do not. Repeated rows and equal
or null ids are scored alike, from the text alone. Without toxic or without ordinary labels all scores are 0. An empty table gives no rows;
only the id and the text are read, other columns do not matter whatever their names.
"""

from __future__ import annotations

import math
import random
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents of a class that are fitted on, and bytes of the longest of them.
FIT = {1: 2_000, 0: 6_000}
FIT_BYTES = 1 << 15
#: Share of them that calibrates.
CALIBRATE = 4
#: Bytes of the toxic and of the ordinary dictionary.
SIZES = {1: 2_048, 0: 112_640}
#: Places that a window of the toxic dictionary is met at, and how many times as often as in ordinary text.
MET = 4
CONTRAST = 8.0
#: Bytes, with the space, in which words of one stem agree.
BEGINNING = 6
ROUNDS = 1
WINDOW = 48
#: Shorter words are no windows; a match takes as many bytes with the space before it.
LEAST = 4
CHUNK = 8 << 20
#: Words whose difference a task remembers.
MEMORY = 1 << 19
#: Bytes that UTF-8 text never holds in this order.
TRAILER = bytes(range(0x80, 0xA0))
#: Differences beyond these are counted with them.
LOW, HIGH = -4, 8


def held_out(ident: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id does not."""
    return F.coalesce(F.pmod(F.crc32(ident.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def windows(text: str | None) -> list[bytes]:
    out = []
    for word in (text or "").lower().encode().split():
        if len(word) >= LEAST:
            out += [b" " + word[i : i + WINDOW] + b" " for i in range(0, len(word), WINDOW)]
    return out


def trained(samples: list[bytes], size: int) -> bytes:
    """At most `size` bytes that are frequent in the samples; all of them if they are few."""
    import zstandard

    if sum(map(len, samples)) <= 2 * size:
        return b"".join(dict.fromkeys(samples))[-size:]
    # The trainer likes samples longer than a word.
    joined, line = [], b""
    for s in samples:
        line += s[:-1]
        if len(line) >= 200:
            joined.append(line + b" ")
            line = b""
    return zstandard.train_dictionary(size, [*joined, line + b" "], k=16, d=6).as_bytes()


class Lengths:
    """Compressed lengths of windows with one dictionary."""

    def __init__(self, content: bytes):
        import zstandard

        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_DFAST, min_match=LEAST + 1, window_log=17, hash_log=15, chain_log=15,
            write_checksum=0, write_content_size=0, write_dict_id=0,
        )
        data = zstandard.ZstdCompressionDict(content + TRAILER, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=settings)
        self.compress = zstandard.ZstdCompressor(dict_data=data, compression_params=settings).compress

    def __call__(self, window: bytes) -> int:
        return len(self.compress(window + TRAILER))


class Model:
    """Dictionaries, ratios of differences, and the curve; plain values that travel to the tasks."""

    def __init__(self, contents: dict[int, bytes], ratios: list[float], slope: float, offset: float):
        self.contents, self.ratios, self.slope, self.offset = contents, ratios, slope, offset

    def score(self, distance):
        import numpy as np

        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * distance + self.offset, -700, 700)))


def _difference(contents: dict[int, bytes]):
    toxic, ordinary, known = Lengths(contents[1]), Lengths(contents[0]), {}

    def difference(window: bytes) -> int:
        found = known.get(window)
        if found is None:
            if len(known) >= MEMORY:
                known.clear()
            found = known[window] = min(HIGH, max(LOW, ordinary(window) - toxic(window)))
        return found

    return difference


def rising(toxic, ordinary):
    """Log-likelihood ratio of each difference, where neighbours that would fall are pooled: a greater difference is never less toxic."""
    import numpy as np

    pools: list[list[float]] = []
    for a, b in zip(toxic / toxic.sum(), ordinary / ordinary.sum(), strict=True):
        pools.append([a, b, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last, strict=True)]
    return np.repeat([math.log(a / b) for a, b, _ in pools], [int(n) for _, _, n in pools])


def curve(distances, labels, weights) -> tuple[float, float]:
    """Slope and offset of a logistic curve by weighted Newton steps; labels a little inside 0 and 1, so that it stays finite."""
    import numpy as np

    positive, negative = int((labels == 1).sum()), int((labels == 0).sum())
    goal = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    x = np.stack([distances, np.ones(len(distances))], axis=1)
    b = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weights * (goal - p)) - 1e-3 * b
        bend = (x * (weights * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(b[0]), float(b[1])


def fit(texts: dict[int, list[str]], totals: dict[int, int]) -> Model | None:
    """The model of labelled texts (by label), with how many documents have each label."""
    import numpy as np

    if not texts.get(1) or not texts.get(0):
        return None
    docs = {c: [windows(t) for t in dict.fromkeys(texts[c])] for c in (0, 1)}
    # A few labels are all used for both.
    few = min(map(len, docs.values())) < 4 * CALIBRATE
    train = {c: d if few else [w for i, w in enumerate(d) if i % CALIBRATE] for c, d in docs.items()}
    check = {c: d if few else d[::CALIBRATE] for c, d in docs.items()}
    samples = {c: [w for d in train[c] for w in sorted(set(d))] for c in (0, 1)}
    # Near copies of a text say nothing new: a window counts once between the same neighbours, words of one beginning together.
    places = {c: {t for d in train[c] for t in zip([b"", *d], d, [*d[1:], b""], strict=False)} for c in (0, 1)}
    met = {c: Counter(w[:BEGINNING] for _, w, _ in places[c]) for c in (0, 1)}
    share = CONTRAST * sum(met[1].values()) / max(1, sum(met[0].values()))
    chosen = sorted(w for _, w, _ in places[1] if met[1][w[:BEGINNING]] >= max(MET, share * (met[0][w[:BEGINNING]] + 0.5)))
    random.Random(0).shuffle(chosen)
    contents = {1: trained(chosen, SIZES[1]), 0: trained(samples[0], SIZES[0])}
    hard: list[bytes] = []
    for _ in range(ROUNDS):
        difference = _difference(contents)
        hard += [w for w in samples[0] if difference(w) >= 2]
        contents = {1: contents[1], 0: trained(hard + samples[0], SIZES[0])}
    difference = _difference(contents)
    found = {c: [np.array([difference(w) - LOW for w in d], np.int64) for d in check[c]] for c in (0, 1)}
    seen = {c: np.bincount(np.concatenate([*found[c], np.zeros(0, np.int64)]), minlength=HIGH - LOW + 1) + 0.5 for c in (0, 1)}
    ratios = rising(seen[1], seen[0])
    distance = np.array([ratios[d].sum() / math.sqrt(max(1, len(d))) for c in (0, 1) for d in found[c]])
    labels = np.array([c for c in (0, 1) for _ in found[c]])
    weights = np.array([totals[c] / len(found[c]) for c in (0, 1) for _ in found[c]])
    slope, offset = curve(distance, labels, weights / weights.mean())
    return Model(contents, ratios.tolist(), slope, offset)


def learned(docs: DataFrame, labels: DataFrame, ident: str = "doc_id", text: str = "text", label: str = "toxic", seed: int = 5) -> Model | None:
    """Fit on labelled documents that are not held out."""
    known = labels.select(F.col(ident).alias("id"), F.col(label).cast("int").alias("label")).where("id IS NOT NULL AND label IN (0, 1)")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("label").alias("label"))
    totals = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.lit(seed), "id")
    texts: dict[int, list[str]] = {}
    for c in (0, 1):
        # FIT ids at most: a bounded list, looked up while the texts are read once.
        ids = known.where(F.col("label") == c).select("id").orderBy(order, "id").limit(FIT[c])
        rows = docs.select(F.col(ident).alias("id"), F.col(text).cast("string").alias("text")).where(
            F.col("text").isNotNull() & (F.octet_length("text") <= FIT_BYTES)
        )
        rows = rows.join(F.broadcast(ids), "id", "left_semi").dropDuplicates(["id", "text"])
        found = rows.select("id", "text").orderBy(F.xxhash64(F.lit(seed), "id"), "id", "text").limit(FIT[c]).collect()
        texts[c] = [r.text for r in found]
    return fit(texts, totals)


def scored(docs: DataFrame, model: Model | None, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: its id, n_windows, and score, from 0 to 1."""
    rows = docs.select(F.col(ident).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def distances(texts, difference, ratios):
        """(number of windows, distance) of each text of a chunk; a word of the chunk is compressed once."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        split = pc.ascii_split_whitespace(pc.utf8_lower(pc.fill_null(texts, "")))
        offsets = split.offsets.to_numpy().astype(np.int64)
        named = split.flatten().cast(pa.binary()).dictionary_encode()
        code = named.indices.to_numpy(zero_copy_only=False)
        n, total = np.zeros(len(named.dictionary), np.int64), np.zeros(len(named.dictionary))
        for i, word in enumerate(named.dictionary.to_pylist()):
            if len(word) >= LEAST:
                for j in range(0, len(word), WINDOW):
                    n[i] += 1
                    total[i] += ratios[difference(b" " + word[j : j + WINDOW] + b" ") - LOW]
        doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
        count = np.bincount(doc, n[code], len(texts))
        return count.astype(np.int64), np.bincount(doc, total[code], len(texts)) / np.sqrt(np.maximum(count, 1))

    def score(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        model = shared.value
        difference = _difference(model.contents) if model else None
        for batch in batches:
            texts = batch.column("text")
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                done = int(ends[at - 1]) if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, done + CHUNK, side="right")))
                if model:
                    count, distance = distances(texts.slice(at, stop - at), difference, model.ratios)
                    value = model.score(distance)
                else:
                    count, value = np.zeros(stop - at, np.int64), np.zeros(stop - at)
                columns = [batch.column("id").slice(at, stop - at), pa.array(count), pa.array(value)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_windows", "score"])
                at = stop

    return rows.mapInArrow(score, f"id {kind}, n_windows long, score double").withColumnRenamed("id", ident)
