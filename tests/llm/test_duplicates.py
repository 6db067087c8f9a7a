from __future__ import annotations

import hashlib
import os
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asterline.llm import fingerprints, jaccard, repeats, suffixes
from asterline.llm.components import components
from asterline.llm.textparts import shingles, word_hashes
from tests.llm.conftest import lower, words


# suffix arrays


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", max_size=40) | st.text("abcde", max_size=40), min_size=1, max_size=6))
def test_suffix_arrays(strings):
    n = np.array([len(s) + 1 for s in strings])
    T = np.zeros((len(strings), n.max()), np.int32)
    for row, s in zip(T, strings):
        row[: len(s)] = [ord(c) for c in s]
    for row, size, sa in zip(T, n, suffixes.suffix_arrays(T, n, 128)):
        text = row[:size].tolist()
        assert sa[:size].tolist() == sorted(range(size), key=lambda i: text[i:])
    flat = np.concatenate([row[:size] for row, size in zip(T, n)]).astype(np.uint8)
    first = np.cumsum(n) - n
    order = np.concatenate([sa[:size] + f for sa, size, f in zip(suffixes.suffix_arrays(T, n, 128), n, first)])
    common, before = suffixes.permuted_prefixes(flat, order, first, 12)
    for f, size in zip(first, n):
        for i in range(f, f + size):
            if before[i] >= 0:
                a, b = flat[i : f + size].tolist(), flat[before[i] : f + size].tolist()
                k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                assert common[i] == min(k, 12)
    assert (before[order[first]] == -1).all()


def removed_by_brute_force(rows):
    """rows: (doc_id, text) in order; returns for each row n_bytes, n_removed, n_spans, sha256 of what is left."""
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, b in data:
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            first[w] = min(first.get(w, (i, s)), (i, s))
    out = []
    for i, b in data:
        covered = bytearray(len(b))
        for s in range(len(b) - 99):
            if first[b[s : s + 100]] < (i, s):
                covered[s : s + 100] = b"\1" * 100
        kept = bytes(x for x, c in zip(b, covered) if not c)
        spans = sum(1 for k, c in enumerate(covered) if c and (k == 0 or not covered[k - 1]))
        out.append((i, len(b), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return out


def removed(frame):
    return sorted(
        (r.i, r.repeat_bytes, r.n, r.s, r.h)
        for r in repeats.deduplicated(frame).select(
            F.coalesce("doc_id", F.lit(repeats.NO_ID)).alias("i"), "repeat_bytes",
            F.expr("aggregate(repeat_spans, 0L, (n, r) -> n + r.stop - r.start)").alias("n"),
            F.size("repeat_spans").alias("s"), F.sha2("repeat_kept", 256).alias("h")).collect()
    )


def test_repeats_of_documents(docs, texts):
    assert removed(docs) == removed_by_brute_force(sorted(texts.items()))


def test_repeats_of_odd_rows(odd, empty):
    rows = [(repeats.NO_ID if r.doc_id is None else r.doc_id, r.text) for r in odd.collect()]
    assert removed(odd) == sorted(removed_by_brute_force(rows))
    assert removed(empty) == []
    assert repeats.deduplicated(odd).columns[: len(odd.columns)] == odd.columns


def test_repeats_beyond_one_lane(spark, monkeypatch):
    rng = np.random.default_rng(5)
    noise = lambda n: "".join(rng.choice(list("abcdefghij "), n))
    passage = noise(260)
    rows = [(i, noise(150) + passage[: 150 + i % 90] + noise(150)) for i in range(60)] + [(99, "ab" * 400), (98, "q" * 700)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(repeats, "LANE", 8)
    monkeypatch.setattr(repeats, "PIECE", 256)
    assert removed(frame) == sorted(removed_by_brute_force(rows))


def test_windows_that_share_a_short_phrase_stay_inside(spark, monkeypatch):
    """A phrase of 50 bytes in 60 texts: all that stood first in a lane left as rows of their own, one for each start."""
    rng = np.random.default_rng(6)
    noise = lambda n: "".join(rng.choice(list("abcdefghij "), n))
    phrase, passage = noise(50), noise(130)
    rows = [(i, noise(150) + phrase + noise(150)) for i in range(60)] + [(100 + i, noise(20) + passage + phrase + noise(90 + i)) for i in range(12)]
    monkeypatch.setattr(repeats, "LANE", 8)
    made, plain = [], repeats.stored

    def kept(df, label):
        out = plain(df, label)
        if label == "repeat-matches":
            made.append(out.where("one IS NOT NULL").count())
        return out

    monkeypatch.setattr(repeats, "stored", kept)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert removed(frame) == sorted(removed_by_brute_force(rows))
    # Only the dozen with a passage in common may meet by rows.
    assert sum(made) < 12 * 120


# Jaccard join


def sets_of(rows):
    out = []
    for key, text in rows:
        w = words(lower(text or ""))
        out.append((key, {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    return out


def joined_by_brute_force(rows):
    sets, parent = sets_of(rows), list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i][1], sets[j][1]
            both = len(a & b)
            if both and 100 * both >= 75 * (len(a) + len(b) - both):
                parent[top(i)] = top(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(sets):
        least[top(i)].append(key)
    named = {t: min((k for k in keys if k is not None), default=None) for t, keys in least.items()}
    return [(key, len(s), named[top(i)]) for i, (key, s) in enumerate(sets)]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def classes(frame):
    return in_order((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.joined(frame).collect())


def test_join_of_documents(docs, texts):
    assert classes(docs) == in_order(joined_by_brute_force(list(texts.items())))


def test_join_of_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert classes(odd) == in_order(joined_by_brute_force(rows))
    assert classes(empty) == []


def test_join_of_many_near_copies_over_blocks(spark, monkeypatch):
    """Edited copies of a few texts, and a passage in all of them; lists are cut into small blocks."""
    rng = np.random.default_rng(3)
    word = lambda n: [f"w{x}" for x in rng.integers(0, 500, n)]
    bases, passage, rows = [word(60) for _ in range(4)], word(12), []
    for i in range(150):
        w = list(bases[i % 4])
        for _ in range(int(rng.integers(0, 4))):
            w[int(rng.integers(0, len(w)))] = f"e{rng.integers(0, 99)}"
        rows.append((i, " ".join(w + passage)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "BLOCK", 10)
    monkeypatch.setattr(jaccard, "FREQUENT", 20)
    assert classes(frame) == in_order(joined_by_brute_force(rows))


def test_lists_of_nearly_the_same_members_are_merged(spark):
    """31 shingles, each with all of 24 classes but one: their pairs came once for each of 24 different lists."""
    tokens = {t: [c for c in range(24) if c != t % 24] for t in range(31)} | {100: [1, 30], 101: [2, 31, 32]}
    first = defaultdict(list)
    for t, members in tokens.items():
        for c in members:
            first[c].append(t * 7919)
    listed = defaultdict(set)
    for r in jaccard.lists(spark.createDataFrame(sorted(first.items()), "node long, first array<long>")).collect():
        listed[r["list"]].add(r.node)
    met = {(a, b) for members in listed.values() for a in members for b in members}
    assert met >= {(a, b) for members in tokens.values() for a in members for b in members}
    assert len(listed) <= 2 + 8


def test_bitmaps_go_when_what_reads_them_is_stored(docs, monkeypatch):
    """Each is a file of the driver and of every executor, which stayed until the session's end."""
    made, most = [], []

    def noted(build):
        def bitmap(*given):
            made.append(build(*given))
            most.append(sum(os.path.exists(b._path) for b in made))
            return made[-1]

        return bitmap

    for module in (jaccard, repeats):
        monkeypatch.setattr(module, "bitmap", noted(module.bitmap))
    found, cut = jaccard.joined(docs), repeats.deduplicated(docs)
    assert len(made) >= 6 and max(most) <= 2
    assert not any(os.path.exists(b._path) for b in made)
    # The results read none of them.
    assert found.count() == cut.count() == docs.count()


def test_sketches_bound_what_sets_share():
    rng = np.random.default_rng(8)
    for n, share in ((3, 1.0), (300, 0.9), (300, 0.72), (5000, 0.87), (5000, 0.5), (70_000, 0.9)):
        both = int(n * share)
        pool = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        one, two = pool[:n], np.concatenate([pool[:both], pool[n : 2 * n - both]])
        if both >= jaccard.needed(n, n):
            assert jaccard.reachable(jaccard.sketch(one), jaccard.sketch(two))
    # Large sets fill their bitmaps, which let them through; their sketches tell them apart.
    one, two = (np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64)) for _ in range(2))
    bits, hidden = (np.array(x) for x in zip(*map(jaccard.signature, (one, two))))
    size = np.array([len(one), len(two)])
    assert jaccard.possible(size, size, hidden, bits, np.array([0]), np.array([1])).all()
    assert not jaccard.reachable(jaccard.sketch(one), jaccard.sketch(two))


def test_tree_drops_no_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 400).astype(np.uint64)
    members = []
    for i in range(300):
        keep = base[rng.random(400) < 0.9] if i % 2 else rng.integers(0, 2**63, 80 + i).astype(np.uint64)
        members.append(np.unique(keep))
    bits, hidden = zip(*(jaccard.signature(s) for s in members))
    sizes = np.array([len(s) for s in members])
    node = np.arange(300)
    a, b = jaccard.candidates(node, sizes, np.array(hidden), np.stack(bits), node, None)
    found = {frozenset(p) for p in zip(a.tolist(), b.tolist())}
    for i in range(300):
        for j in range(i):
            both = len(np.intersect1d(members[i], members[j]))
            if 100 * both >= 75 * (sizes[i] + sizes[j] - both):
                assert frozenset((i, j)) in found
    assert len(found) < 300 * 299 // 2


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (20, 20), (30, 31), (31, 30)] + [(100, 101 + i) for i in range(50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in (1, 2, 3)} == {1} and {got[i] for i in (5, 6, 7, 8, 9)} == {5} and got[31] == 30
    assert {got[101 + i] for i in range(50)} == {100} and 20 not in got
    chain = [(i, i + 1) for i in range(200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert set(got.values()) == {0} and len(got) == 201


# fingerprints


def test_words_and_shingles_follow_their_definition(texts):
    for text in [*list(texts.values())[:60], "a b", "A\tb", "", " ", "a b c d e", "a b c d e f"]:
        w = words(lower(text))
        assert len(word_hashes(text.encode())) == len(w)
        assert len(set(word_hashes(text.encode()).tolist())) == len(set(w))
        assert len(shingles(text.encode())) == len(sets_of([(0, text)])[0][1])
    assert word_hashes(b"ab c").tolist() != word_hashes(b"a bc").tolist()
    assert word_hashes(b"X y").tolist() == word_hashes(b"\nx\t y ").tolist()


def edits(rows):
    """(doc_id, text) in order to (edited, next) of each."""
    out = []
    for k, (_, t) in enumerate(rows):
        other = rows[(k + 1) % len(rows)][1] or ""
        t = t or ""
        q = len(t) // 4
        out.append((t[: len(t) - q] + other[:q], other))
    return out


def test_fingerprints_of_documents(docs, texts):
    rows = sorted(texts.items())
    got = {r.doc_id: r for r in fingerprints.with_edits(docs).collect()}
    assert len(got) == len(rows)
    gap = []
    for (i, t), (edited, other) in zip(rows, edits(rows)):
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == fingerprints.as_text(fingerprints.sketch(t.encode()))
        a, b, c = (sets_of([(0, x)])[0][1] for x in (t, edited, other))
        gap.append(abs(r.near_edited - len(a & b) / len(a | b)))
        gap.append(abs(r.near_next - len(a & c) / len(a | c)))
    assert max(gap) < 0.15 and sum(gap) / len(gap) < 0.02


def test_fingerprints_of_odd_rows(spark, odd, empty):
    rows = fingerprints.with_edits(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in rows)
    assert fingerprints.with_edits(empty).collect() == []
    one = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id long, text string")
    (r,) = fingerprints.with_edits(one).collect()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(b"a b c d e fa b").hexdigest()[:0] + r.edited_sha256


def test_sketches_merge_and_estimate(spark):
    rng = np.random.default_rng(2)
    a = np.unique(rng.integers(0, 2**48, 6000).astype(np.uint64))
    b = np.unique(np.concatenate([a[::2], rng.integers(0, 2**48, 3000).astype(np.uint64)]))
    k = 256
    sa, sb = a[:k], b[:k]
    assert (fingerprints.merged(sa, sb) == np.union1d(a, b)[:k]).all()
    assert abs(fingerprints.resemblance(sa, sb) - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.12
    assert abs(fingerprints.distinct(sa) / len(a) - 1) < 0.25
    assert abs(fingerprints.containment(sa, sb) - len(np.intersect1d(a, b)) / len(a)) < 0.2
    assert (fingerprints.from_text(fingerprints.as_text(sa)) == sa).all()
    frame = spark.createDataFrame(
        [("x", fingerprints.as_text(sa)), ("x", fingerprints.as_text(sb)), ("y", fingerprints.as_text(sb)), ("y", None)],
        "part string, fingerprint string").repartition(3)
    got = {r.part: r.fingerprint for r in fingerprints.merged_by(frame, "part").collect()}
    assert got == {"x": fingerprints.as_text(np.union1d(a, b)[:k]), "y": fingerprints.as_text(sb)}


@pytest.mark.parametrize("text", ["", " "])
def test_empty_sketches(text):
    s = fingerprints.sketch(text.encode())
    assert len(s) == 0 and fingerprints.resemblance(s, s) == 1.0 and fingerprints.distinct(s) == 0.0


def test_repeats_where_snippets_share_no_window(spark):
    """A common gram between different surroundings brings snippets together, but no 100 bytes are equal."""
    rng = np.random.default_rng(8)
    noise = lambda n: "".join(rng.choice(list("abcdefghij "), n))
    common = noise(60)
    rows = [(i, noise(200) + common + noise(200)) for i in range(5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert removed(frame) == removed_by_brute_force(rows) and all(r[2] == 0 for r in removed(frame))
