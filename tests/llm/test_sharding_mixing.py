from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from asterline.llm import mixing, sharding
from tests.llm.conftest import SF, words


def greedy(sizes, capacity):
    shards, load = 1, 0
    for x in sizes:
        if load + x > capacity:
            shards, load = shards + 1, x
        else:
            load += x
    return shards


def smallest(sizes, shards):
    lo, hi = max(sizes), sum(sizes)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if greedy(sizes, mid) <= shards else (mid + 1, hi)
    return lo


@pytest.mark.parametrize("shards", [1, 3, 24])
def test_capacity_is_the_smallest(spark, docs, shards):
    groups = docs.selectExpr("xxhash64(text) AS atom", "octet_length(text) + 8L AS size").groupBy("atom").agg({"size": "sum"})
    groups = groups.toDF("atom", "size")
    rows = sorted((r.atom, r.size) for r in groups.collect())
    found = sharding.capacity_and_cuts(groups, shards).first()
    assert found.capacity == smallest([s for _, s in rows], shards)
    loads = Counter()
    for atom, size in rows:
        loads[sum(atom > c for c in found.cuts)] += size
    assert max(loads.values()) <= found.capacity and len(loads) == shards and list(found.cuts) == sorted(found.cuts)


def test_one_group_larger_than_the_others_together(spark):
    sizes = [3, 1, 1000, 2, 2, 5]
    groups = spark.createDataFrame([(i * 10**17, s) for i, s in enumerate(sizes)], "atom long, size long")
    found = sharding.capacity_and_cuts(groups, 3).first()
    assert found.capacity == 1000
    assert sharding._cuts(groups, 24) is not None


def check_shards(rows, frame, shards):
    assert len(rows) == frame.count()
    by_text, slots = defaultdict(set), defaultdict(list)
    texts = defaultdict(list)
    for r in frame.select("doc_id", "text").collect():
        texts[r.doc_id].append(zlib.crc32((r.text or "").encode()))
    for r in rows:
        assert 0 <= r.shard < shards and r.text_crc32 in texts[r.doc_id]
        by_text[r.text_crc32].add(r.shard)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return by_text


def test_shards_of_documents(docs):
    by_text = check_shards(sharding.sharded(docs, 24).collect(), docs, 24)
    assert all(len(s) == 1 for s in by_text.values())


def test_shards_of_odd_rows(odd, empty):
    check_shards(sharding.sharded(odd, 4).collect(), odd, 4)
    assert sharding.sharded(empty, 4).collect() == []
    assert sharding.cuts_of(empty, 4) == []


def test_native(spark, docs):
    rows = sharding.with_slot(sharding.with_shard(sharding.measured(docs), [0]))
    plan = rows._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 9)), min_size=1, max_size=25, unique_by=lambda x: x[0]), st.integers(0, 4000))
def test_fit_is_the_best_that_lengths_allow(pairs, budget):
    lengths, counts = zip(*sorted(pairs))
    taken = mixing.fit(lengths, counts, budget)
    assert all(0 <= t <= c for t, c in zip(taken, counts))
    total = int(np.dot(lengths, taken))
    assert total <= max(budget, 0)
    sums = {0}
    for length, count in pairs:
        sums = {a + n * length for a in sums for n in range(count + 1) if a + n * length <= budget} if budget > 0 else {0}
    assert total == max(sums)


def expected_targets(sizes, weights, share=1.5, most=2.0):
    left, out, open_ = share * sum(sizes.values()), {}, dict(weights)
    while open_:
        level = left / sum(open_.values())
        over = [s for s, w in open_.items() if level * w > most * sizes[s]]
        if not over:
            out.update({s: level * w for s, w in open_.items()})
            break
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            del open_[s]
    return out


def check_mix(rows, frame):
    sizes, order = Counter(), {}
    docs = Counter()
    for r in frame.select("doc_id", "source", "text").collect():
        sizes[r.source] += len(words(r.text))
        docs[(r.doc_id, len(words(r.text)))] += 1
    for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s))):
        order[s] = (3.0, 1.0, 2.0)[i % 3]
    goal = expected_targets(sizes, order)
    assert Counter((r.doc_id, r.size) for r in rows) == docs
    assert all(r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0) for r in rows)
    targets = sorted(set((r.source_size, round(r.target, 6)) for r in rows))
    assert targets == sorted(set((sizes[s], round(goal[s], 6)) for s in sizes))
    return goal, sum(r.taken for r in rows)


def test_mix_of_documents(docs):
    rows = mixing.mixed(docs).collect()
    goal, taken = check_mix(rows, docs)
    # Sources are small enough here to try all sets of documents.
    sizes, got = defaultdict(list), Counter()
    source = {r.doc_id: r.source for r in docs.collect()}
    for r in rows:
        sizes[source[r.doc_id]].append(r.size)
        got[source[r.doc_id]] += r.taken
    for s, lengths in sizes.items():
        passes = int(goal[s] // sum(lengths))
        sums = {0}
        for x in lengths:
            sums |= {a + x for a in sums}
        best = max(a for a in sums if a <= goal[s] - passes * sum(lengths))
        assert got[s] == passes * sum(lengths) + best
    again = mixing.mixed(docs.repartition(5)).collect()
    assert sorted(rows) == sorted(again)
    other = mixing.mixed(docs, seed=3).collect()
    assert sorted(other) != sorted(rows)


def test_mix_of_odd_rows(odd, empty):
    check_mix(mixing.mixed(odd).collect(), odd)
    assert mixing.mixed(empty).collect() == []
    out = mixing.taken(odd)
    assert out.columns == odd.columns and out.count() > 0
    assert mixing.taken(empty).collect() == []
    clash = odd.withColumnRenamed("size", "mix_id").withColumnRenamed("slot", "mix_row").withColumnRenamed("kept", "cut_hash")
    assert sorted(map(str, mixing.taken(clash).collect())) == sorted(map(str, out.toDF(*clash.columns).collect()))


def test_rows_equal_in_id_and_text_are_told_by_number(spark):
    rows = [(1, "a b c d e", "s")] * 6 + [(i, "a b c d e", "s") for i in range(2, 5)] + [(9, "x " * 40, "t")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.mixed(frame, share=0.7, most=1.0).collect()
    by = Counter((r.doc_id, r.taken) for r in got)
    assert sum(by.values()) == 10 and sum(r.taken for r in got if r.size == 5) == 5 * (int(next(r.target for r in got if r.size == 5)) // 5)
    assert sum(1 for _ in mixing.taken(frame, share=0.7, most=1.0).collect()) == sum(r.taken > 0 for r in got)


def test_registered_queries(spark):
    from asterline.llm.queries import QUERIES

    rows = QUERIES["op1_minimax_shards"](spark, SF).collect()
    assert len(rows) == 200 and {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    assert set(QUERIES["op2_budget_mix"](spark, SF).columns) == {"doc_id", "size", "source_size", "target", "taken"}
