"""Periodic runs against a plain search over all periods."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asterline.llm import periodic
from tests.llm.conftest import SF, words


def plain_runs(w, least=24, exponent=3):
    out = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in out.items())


def derived(symbol, rules, first):
    if symbol < first:
        return [symbol]
    return [x for s in rules[symbol - first] for x in derived(s, rules, first)]


PIECES = st.lists(
    st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 12), st.integers(0, 4)), min_size=1, max_size=6
)


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_runs_are_those_of_a_plain_search(pieces):
    w = [x for unit, n, cut in pieces for x in (unit * n)[cut:]]
    assert periodic.runs(w) == plain_runs(w)
    rules, left, first = periodic.re_pair(w)
    assert [x for s in left for x in derived(s, rules, first)] == w
    # A pair may only be twice in what is left where its two places overlap.
    for pair in set(zip(left, left[1:], strict=False)):
        at = [i for i in range(len(left) - 1) if (left[i], left[i + 1]) == pair]
        assert len(at) == 1 or (pair[0] == pair[1] and at[-1] - at[0] == 1)


def test_runs_of_longer_texts():
    rng = random.Random(11)
    for _ in range(60):
        w, k = [], rng.choice([1, 2, 4, 40])
        while len(w) < 900:
            unit = [rng.randrange(k) for _ in range(rng.randint(1, 70))]
            w += (unit * rng.randint(1, 9))[: rng.randint(1, 400)]
            if w and rng.random() < 0.4:
                a = rng.randrange(len(w))
                w += w[a : a + rng.randint(1, 200)]
        want = plain_runs(w)
        assert periodic.runs(w) == want
        # No run is lost to the cuts, also beside other documents.
        docs = np.repeat(np.arange(3), len(w))
        pieces = periodic.stretches(np.array(w * 3), docs)
        for d in range(3):
            mine = [(a - d * len(w), b - d * len(w)) for a, b in pieces if d * len(w) <= a < (d + 1) * len(w)]
            assert sorted((a + s, a + e, q) for a, b in mine for s, e, q in periodic.runs(w[a:b])) == want


def test_hard_sequences_end_soon():
    fib, b = [0], [0, 1]
    while len(b) < 3000:
        fib, b = b, b + fib
    for w in ([0] * 3000, ([0] * 60 + [1]) * 50, b, [i % 500 for i in range(3000)], [i * i % 7 for i in range(3000)]):
        assert periodic.runs(w) == plain_runs(w)
    with pytest.raises(ValueError):
        periodic.runs([1, 2], least=4)


def expected(ident, text):
    w, n = words(text), len(words(text))
    h = zlib.crc32(str(ident).encode()) if ident is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w)
    dropped = {i for s, e, q in found for i in range(s + q, e)}
    best = min(found, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in found)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    top = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (ident, len(found), *top, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in dropped)))


def query(spark, frame, tmp_path):
    from asterline.llm.queries import QUERIES

    frame.write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op13_grammar_runs"](spark, str(tmp_path))
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted(map(tuple, rows.collect()), key=str)


def test_query_on_the_given_documents(spark, docs, tmp_path):
    short = docs.where(F.length("text") < 30_000)
    got = query(spark, short, tmp_path)
    assert got == sorted((expected(r.doc_id, r.text) for r in short.collect()), key=str)
    assert sum(r[1] for r in got) > 5


def test_query_on_odd_rows(spark, odd, empty, tmp_path):
    line = "one two\tthree x four\n"
    more = [(i, t, None, None, None, 1, "k", 1) for i in range(40, 60) for t in (line * 9, line * 9 + "end", "a " * 30, "a b c")]
    frame = odd.where("doc_id IS NULL OR doc_id <> 6").unionByName(spark.createDataFrame(more, odd.schema))
    got = query(spark, frame, tmp_path / "odd")
    assert got == sorted((expected(r.doc_id, r.text) for r in frame.collect()), key=str)
    assert query(spark, empty, tmp_path / "empty") == []


def test_collapsed_text(spark):
    frame = spark.createDataFrame([(1, "x " + "a b c\n" * 10 + "y", 5, "z"), (2, None, 5, "z")], "doc_id int, text string, runs int, id string")
    one, two = sorted(periodic.collapsed(frame).collect())
    assert one.collapsed == "x a b c y" and one.n_words == 32 and [tuple(r) for r in one.runs] == [(1, 30, 3)]
    assert (two.collapsed, two.n_words, two.runs) == ("", 0, [])
