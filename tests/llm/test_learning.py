"""Centroid clustering and toxicity."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from asterline.llm import bisectors, toxicity
from tests.llm.conftest import SF


def lloyd(rows, k=8, rounds=10, size=64, seed=3):
    """Rounds of nearest centroids on whole numbers, as plainly as possible."""
    kept = []
    for ident, v in rows:
        if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v):
            kept.append((ident, tuple(bisectors.quantised(float(x)) for x in v)))
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds if kept else 0):
        found = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (w, _) in zip(kept, found, strict=True) if w == c]
            if mine:
                centroids[c] = tuple(sum(x) // len(mine) for x in zip(*mine, strict=True))
    found = assign() if kept else []
    inertia = {c: sum(d for w, d in found if w == c) for c in range(len(centroids))}
    total = sum(inertia.values())
    long = lambda x: x if x < 1 << 63 else None
    return [
        (i, w, long(d), long(inertia[w]) if all(long(e) is not None for x, e in found if x == w) else None,
         long(total) if all(long(e) is not None for _, e in found) else None, ",".join(map(str, centroids[w])))
        for (i, _), (w, d) in zip(kept, found, strict=True)
    ]


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def clusters(frame, **settings_):
    rows = bisectors.clustered(frame, **settings_).collect()
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, ",".join(r.centroid)) for r in rows), key=key)


def embeddings(spark, rows, extra=False):
    if extra:
        return spark.createDataFrame([(*r, 1, 2, "c") for r in rows], "vec_id long, embedding array<double>, cluster int, id int, vector string")
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)


def test_clusters_of_the_given_vectors(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    assert clusters(frame) == sorted(lloyd([(r.vec_id, r.embedding) for r in frame.collect()]), key=key)


@pytest.mark.parametrize("spread", [0.001, 1.0, 5e4, 3e12, 1e40])
def test_clusters_of_small_and_huge_components(spark, spread):
    rng = random.Random(7)
    rows = [(i, [rng.choice([-1, 0, 0.5, rng.random()]) * spread for _ in range(4)]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(40)]
    assert clusters(embeddings(spark, rows), size=4, k=5, rounds=4) == sorted(lloyd(rows, size=4, k=5, rounds=4), key=key)


def test_clusters_of_odd_vectors(spark):
    rows = [
        (1, [0.0, 1.0]), (1, [0.0, 1.0]), (1, [2.0, 1.0]), (None, [0.0, 1.0]), (None, [5.0, -0.0001]), (2, None), (3, []), (4, [1.0]),
        (5, [1.0, None]), (6, [math.nan, 1.0]), (7, [math.inf, 1.0]), (8, [1.0, 2.0, 3.0]), (9, [-0.0005, 0.0]), (10, [1e308, 1.0]),
    ]
    for extra in (False, True):
        assert clusters(embeddings(spark, rows, extra), size=2, k=3) == sorted(lloyd(rows, size=2, k=3), key=key)
    # Fewer vectors than centroids, and none.
    assert clusters(embeddings(spark, rows[:2]), size=2, k=3) == sorted(lloyd(rows[:2], size=2, k=3), key=key)
    empty = bisectors.clustered(embeddings(spark, []), size=2)
    assert empty.collect() == [] and empty.columns == bisectors.clustered(embeddings(spark, rows), size=2).columns


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=3, max_size=3), min_size=1, max_size=6), st.data())
def test_a_tournament_finds_the_nearest(centroids, data):
    x = np.array(data.draw(st.lists(st.lists(st.integers(-4, 4), min_size=3, max_size=3), min_size=1, max_size=8)), float)
    winner, distance, _, _ = bisectors.Tournament([tuple(c) for c in centroids]).nearest(x / 1024)
    for row, w, d in zip(x, winner, distance, strict=True):
        all_ = [sum((a - b) ** 2 for a, b in zip(row, c, strict=True)) for c in centroids]
        assert d == min(all_) and w == all_.index(min(all_))


# Toxicity


def toxic_corpus(n: int, seed: int):
    """(text, label): made-up words; a toxic text has a few of its own."""
    rng = random.Random(seed)
    parts = ["an", "the", "ber", "lon", "sti", "re", "ou", "ti", "men", "gar", "ve", "shi"]
    bad = ["grunzkopf", "lumpazius", "fleckwurm", "zornqualle", "mistfink"]
    out = []
    for i in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(30, 300))]
        toxic = int(i % 8 == 0)
        for _ in range(toxic * rng.randint(3, 6)):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        out.append((" ".join(words).capitalize(), toxic))
    return out


def test_toxic_texts_are_told_from_others():
    train, rest = toxic_corpus(900, 1), toxic_corpus(300, 2)
    model = toxicity.fit({c: [t for t, y in train if y == c] for c in (0, 1)}, {1: 113, 0: 787})
    difference = toxicity._difference(model.contents)
    right = wrong = 0
    for text, label in rest:
        found = [model.ratios[difference(w) - toxicity.LOW] for w in toxicity.windows(text)]
        predicted = model.score(np.array([sum(found) / math.sqrt(max(1, len(found)))]))[0] >= 0.7
        right += predicted and label
        wrong += predicted and not label
    assert right >= 0.9 * sum(y for _, y in rest) and wrong <= 3
    assert all(b >= a - 1e-12 for a, b in zip(model.ratios, model.ratios[1:], strict=False))


def test_fit_needs_both_labels():
    assert toxicity.fit({1: ["a b c d"], 0: []}, {1: 1}) is None
    model = toxicity.fit({1: ["", "bad words here"], 0: ["good words there"]}, {1: 2, 0: 1})
    assert 0 <= model.score(np.array([0.0]))[0] <= 1


def test_windows_hold_the_whole_text():
    text = "Ab abcd " + "x" * 1000 + " é" * 30 + " Élan vital"
    got = b"".join(w[1:-1] for w in toxicity.windows(text))
    assert got == b"abcd" + b"x" * 1000 + "élan vital".encode()


@pytest.fixture(scope="module")
def scores(spark):
    from asterline.llm.queries import QUERIES

    return QUERIES["op12_compression_toxicity"](spark, "/root/testdata/sf0.01").collect()


def test_scores_of_the_given_documents(spark, scores):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    assert sorted(r.doc_id for r in scores) == sorted(r.doc_id for r in docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in scores)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scores)
    same: dict = {}
    text = {r.doc_id: r.text for r in docs}
    for r in scores:
        assert same.setdefault(text[r.doc_id], r.score) == r.score
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(r.score, labels[r.doc_id]) for r in scores if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    assert np.mean([(a > b) + 0.5 * (a == b) for a in toxic for b in clean]) > 0.8
    assert np.mean([s >= 0.7 for s in clean]) < 0.05


def test_labels_that_are_held_out_are_not_learned(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(toxic_corpus(300, 3))], "doc_id long, text string")
    rows = [(i, y) for i, (_, y) in enumerate(toxic_corpus(300, 3))]
    schema = "doc_id long, toxic int"
    plain = toxicity.learned(docs, spark.createDataFrame(rows, schema))
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in rows]
    other = toxicity.learned(docs.repartition(5), spark.createDataFrame([*turned, (None, 1), (7, None), (10**9, 1)], schema).repartition(3))
    assert plain.contents == other.contents and plain.ratios == other.ratios
    only = spark.createDataFrame([(i, 0) for i, _ in rows], schema)
    assert toxicity.learned(docs, only) is None
    assert {r.score for r in toxicity.scored(docs, None).collect()} == {0.0}


def test_scores_of_odd_rows(odd, empty):
    model = toxicity.fit({c: [t for t, y in toxic_corpus(200, 4) if y == c] for c in (0, 1)}, {1: 1, 0: 9})
    clash = odd.withColumnRenamed("size", "score").withColumnRenamed("slot", "id").withColumnRenamed("kept", "n_windows")
    rows = toxicity.scored(clash, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.n_windows == 0}) == 1
    assert toxicity.scored(empty, model).collect() == []
