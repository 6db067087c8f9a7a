from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline as pipeline
from asterline.llm import repeats
from asterline.session import stored
from tests.llm.conftest import SF, words
from tests.llm.test_duplicates import in_order, joined_by_brute_force, removed_by_brute_force
from tests.llm.test_sharding_mixing import expected_targets
from tests.llm.test_text import WORD_BPE, measures_by_brute_force, verdict_by_brute_force


def run_stage(spark, name, docs):
    return stored(dict(pipeline.STAGES)[name](spark, docs, SF), "test-pipeline")


def pairs(frame):
    return in_order([(r.doc_id, r.text) for r in frame.collect()])


def test_stages_against_brute_force(spark, docs):
    good = run_stage(spark, "quality rules", docs)
    assert good.columns == docs.columns
    assert pairs(good) == in_order([(i, t) for i, t in pairs(docs) if verdict_by_brute_force(*measures_by_brute_force(t))[1]])

    alone = run_stage(spark, "n-gram Jaccard join", good)
    rows = pairs(good)
    named = joined_by_brute_force(rows)
    assert pairs(alone) == in_order([r for r, (i, n, c) in zip(rows, named) if i == c])

    cut = run_stage(spark, "suffix-array dedup", alone)
    left = {i: n - gone for i, n, gone, _, _ in removed_by_brute_force(sorted(pairs(alone)))}
    got = {r.doc_id: r for r in cut.collect()}
    assert set(got) == {i for i, n in left.items() if n}
    before = dict(pairs(alone))
    for i, r in got.items():
        # At most the rest of a character is lost at each end of a cut.
        assert left[i] - 6 * 20 <= len(r.text.encode()) <= left[i] and r.n_chars == len(r.text)
        if left[i] == len(before[i].encode()):
            assert r.text == before[i]

    mix = run_stage(spark, "mixing sources", cut)
    assert mix.columns == docs.columns
    sizes = Counter()
    for r in cut.collect():
        sizes[r.source] += len(words(r.text))
    weights = {s: (3.0, 1.0, 2.0)[k % 3] for k, s in enumerate(sorted(sizes))}
    goal = expected_targets(sizes, weights)
    taken = Counter()
    for r in mix.collect():
        taken[r.source] += len(words(r.text))
    longest = max(len(words(r.text)) for r in cut.collect())
    assert all(abs(taken[s] - goal[s]) <= longest for s in goal)
    assert max(Counter(r.doc_id for r in mix.collect()).values()) <= 2

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    final = run_stage(spark, "BPE encoding", mix).collect()
    texts = {r.doc_id: r.text for r in mix.collect()}
    assert len(final) == mix.count()
    for r in final:
        assert r.ids == library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)


def test_stages_of_odd_rows(spark, odd, empty):
    for name, stage in pipeline.STAGES:
        out = stored(stage(spark, odd, SF), "test-odd")
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == odd.columns
        assert stage(spark, empty, SF).collect() == []


def test_near_duplicates_keep_one_of_each_group(spark, odd):
    out = [(r.doc_id, r.text) for r in run_stage(spark, "n-gram Jaccard join", odd).collect()]
    assert len(out) == len(set(out))
    empties = {t for _, t in out if not words(t)}
    assert empties == {None, "", " \t\n\x0b "}


def test_near_duplicates_keep_unlinked_texts_of_null_or_equal_ids(spark, docs):
    texts = [" ".join(f"w{i}x{k}" for k in range(60)) for i in range(8)]
    rows = [(None, t) for t in texts[:4]] + [(7, t) for t in texts[4:7]] + [(8, texts[7]), (None, texts[0] + " end"), (9, texts[7] + " end")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = run_stage(spark, "n-gram Jaccard join", frame.repartition(3)).collect()
    # Of each text or its near copy one row is left.
    assert sorted(r.text.removesuffix(" end") for r in out) == texts
    assert sorted(r.doc_id for r in out if r.doc_id is not None) == [7, 7, 7, 8]


def test_cuts_leave_whole_characters_and_genuine_replacement_characters(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh é€𝄞\ufffd") for _ in range(400))
    # The copies begin and end with characters that share their first or last bytes with what stood there before.
    rows = [(1, "x\ufffdé" + base + "éy\ufffd"), (2, "p\ufffdq" + "\u20ad" + base + "\U0001d11f\ufffd z"), (3, "\ufffdè" + base + "è\ufffd"),
            (4, "\ufffd" * 3), (5, None)]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in run_stage(spark, "suffix-array dedup", frame).collect()}
    spans = {r.doc_id: r.repeat_spans for r in repeats.deduplicated(frame).collect()}
    assert set(got) == {1, 2, 3, 4, 5} and spans[2] and spans[3]
    for i, t in rows:
        at, expected = 0, ""
        for c in t or "":
            stop = at + len(c.encode())
            expected += "" if any(a < stop and at < b for a, b in spans[i]) else c
            at = stop
        assert (got[i].text or "") == expected and (t is None or got[i].n_chars == len(expected))
    assert got[2].text.count("\ufffd") == got[3].text.count("\ufffd") == 2


def test_run_is_the_stages_in_turn(spark, docs):
    out = pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "ids", "decoded"} <= set(out.columns)
