from __future__ import annotations

import base64
import gzip
import hashlib
import io
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from asterline.llm import bpe, packing, rules, scoring, warc
from tests.llm.conftest import SF, lower, words

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(WORD_BPE)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


@pytest.fixture(scope="module")
def encoder():
    return packing.Encoder(BYTE_BPE)


# BPE


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40) | st.text("abcdeth '\n.,1Σİß<|>", max_size=60))
def test_bpe_is_the_librarys(vocabulary, library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert vocabulary.encode(text) == ids
    assert vocabulary.decode(ids) == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["<|endoftext|>a<|startoftext|> B", "x" * 5000, "ab\x1ccd 　e", "l’été ￼", "aaaa" * 50])
def test_bpe_of_odd_texts(vocabulary, library, text):
    assert vocabulary.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_every_token_encodes_to_itself_or_is_left_by_a_pair(vocabulary):
    """The pair test against merging: the boundary of two tokens stays exactly if the library keeps it."""
    rng = np.random.default_rng(4)
    plain = [i for i, n in enumerate(vocabulary.names) if n.isascii() and n.isalpha() and not n.endswith("w")]
    ended = [i for i, n in enumerate(vocabulary.names) if n.endswith("</w>") and n[:-4].isascii() and n[:-4].isalpha()]
    for a, b in zip(rng.choice(plain, 800).tolist(), rng.choice(ended, 800).tolist()):
        both = vocabulary.word(vocabulary.names[a] + vocabulary.names[b][:-4])
        assert vocabulary.compatible(a, b) == (both == [a, b])


def check_bpe(frame, library):
    rows = bpe.encoded(frame, WORD_BPE).collect()
    expected = Counter()
    for r in frame.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected[(r.doc_id, tuple(ids), library.decode(ids, skip_special_tokens=False))] += 1
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows) == expected


def test_bpe_of_tables(docs, odd, empty, library):
    check_bpe(docs, library)
    check_bpe(odd, library)
    check_bpe(empty, library)
    assert bpe.encoded(odd, WORD_BPE, keep=("size", "kept")).columns == ["size", "kept", "doc_id", "ids", "decoded"]


# packed ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30) | st.text("ab \n\t <|", max_size=30), max_size=5))
def test_encoder_is_the_librarys(encoder, texts):
    texts = [*texts, "a  b", "\n\na b \n c ", "  ", " ", "x <|endoftext|> y<|endoftext|>", "a\t b\t  c", "don't  we'll "]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 7, 8, 13, 16, 17, 20, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 9000).astype(np.uint32)
    assert (packing.unpack(packing.pack(ids, bits), len(ids), bits) == ids).all()
    out = io.BytesIO()
    starts = [0, 0, 5, 4096, 8999, 9000]
    packing.write_file(out, [3, None, 5, 6, 7], starts, ids, bits)
    file = packing.Packed(out.getvalue())
    for a, b in [(0, 9000), (4095, 4097), (8191, 8999), (17, 17), (8999, 9000)]:
        assert (file.slice(a, b) == ids[a:b]).all()
    assert file.starts.tolist() == starts and file.null.tolist() == [0, 1, 0, 0, 0]
    assert len(file.data) <= math.ceil(9000 / packing.BLOCK) * (packing.BLOCK * bits // 8)


def test_width():
    assert [packing.width(n) for n in (1, 2, 3, 256, 257, 50257, 65536, 65537)] == [1, 1, 2, 8, 9, 16, 16, 17]


def check_ids(frame, library, rows):
    source = sorted(((r.doc_id, r.text, r.tie) for r in frame.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")).collect()),
                    key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    at, expected = 0, []
    for doc_id, text, _ in source:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == expected


def test_packed_tables(docs, odd, empty, monkeypatch):
    library = Tokenizer.from_file(BYTE_BPE)
    monkeypatch.setattr(packing, "FILE_IDS", 20_000)
    check_ids(docs, library, packing.packed(docs, BYTE_BPE, 2).collect())
    check_ids(odd, library, packing.packed(odd, BYTE_BPE, 2).collect())
    assert packing.packed(empty, BYTE_BPE, 2).collect() == []


# WARC


def pages_by_brute_force(rows):
    best = {}
    for page_id, html in rows:
        if page_id is not None:
            key = (html or "").encode()
            best[key] = max(best.get(key, page_id), page_id)
    out = Counter()
    seen = set()
    for page_id, html in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (html or "").encode()
        lead = best.get(data)
        alone = sum((h or "").encode() == data for _, h in rows) == 1 or lead is None
        revisit = not alone and (page_id != lead or data in seen)
        if page_id == lead and page_id is not None:
            seen.add(data)
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out[(page_id, len(data), sha, "revisit" if revisit else "response", lead if revisit else None)] += 1
    return out


def test_archives_of_pages(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 20_000)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [(r.page_id, r.html) for r in pages.collect()]
    found = warc.archived(pages)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found.collect()) == pages_by_brute_force(rows)
    urls = {r.page_id: r.url for r in pages.collect()}
    assert {r.page_id: r.url for r in found.collect()} == urls


def test_archives_of_odd_pages(spark):
    rows = [(1, "u", "x"), (2, None, "x"), (3, "u v\n", None), (4, "u", ""), (None, "u", "x"), (None, None, "only"), (None, None, "only"),
            (5, "u", "é" * 9), (5, "u", "é" * 9), (6, "u", "a\r\n\r\nb" * 70_000), (7, "u", "a\r\n\r\nb" * 70_000)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, sha string").repartition(2)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.archived(pages).collect())
    assert got == pages_by_brute_force([(p, h) for p, _, h in rows])
    assert warc.archived(pages.where("false")).collect() == []
    kept = warc.archived(pages, least=5).where("record_type = 'revisit'").collect()
    assert {r.payload_bytes for r in kept} == {18, 420_000}


def test_records_are_members_and_verified():
    one, two = warc.encoded(1, "http://a/", b"abc", None, False), warc.encoded(2, "http://b/", b"abc", 1, True)
    assert gzip.decompress(one).startswith(b"WARC/1.1\r\n")
    assert [warc.parsed(m)[0] for m in warc.members(one + two)] == [1, 2]
    member = next(warc.members(one))
    for bad in (member.replace(b"abc", b"abd"), member[:-1], member.replace(b"Content-Length: 3", b"Content-Length: 4", 1)):
        with pytest.raises(warc.BadRecord):
            warc.parsed(bad)
    with pytest.raises(warc.BadRecord):
        list(warc.members(one[:-3]))


# rules


def measures_by_brute_force(text):
    w, t = words(text), text or ""
    count = Counter(zip(w, w[1:], w[2:]))
    covered = {p for i, win in enumerate(zip(w, w[1:], w[2:])) if count[win] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), len(lines))


def verdict_by_brute_force(n, chars, symbols, dup, rep, lines):
    base = n < 50 or 100 * rep > 50 * n
    return base, not (base or 10 * symbols > n or chars < 2 * n or chars > 12 * n or (dup > 0 and 100 * dup > 30 * lines))


def check_rules(frame):
    got = Counter(
        (r.doc_id, r.text, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines, r.base_failed, r.kept)
        for r in rules.judged(frame).select("doc_id", "text", *rules.MEASURES, "base_failed", "kept").collect()
    )
    expected = Counter()
    for r in frame.select("doc_id", "text").collect():
        m = measures_by_brute_force(r.text)
        expected[(r.doc_id, r.text, *m, *verdict_by_brute_force(*m))] += 1
    assert got == expected


def test_rules_of_documents(docs):
    check_rules(docs)
    plan = rules.judged(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_rules_of_odd_rows(spark, odd, empty):
    check_rules(odd.drop("kept"))
    check_rules(empty.drop("kept"))
    tricky = ["a b c a b c a b c", "a b c d a b c", "a a a a a", "x\nx\n\n \nx", " p  q\tp q p q ", "a b", "#|#| b c d", "é\n é\né"]
    check_rules(spark.createDataFrame(list(enumerate(tricky)), "doc_id long, text string"))


def test_long_texts_compare_whole_hashes(spark):
    """Two windows whose 64-bit hashes have the last 47 bits in common, all that a text of 70,000 words left of them before."""
    a, b = 9637275, 14559005
    long = " ".join([f"p{a} q{a} r{a}", *[f"w{i}" for i in range(70_000)], f"p{b} q{b} r{b}"])
    row = rules.judged(spark.createDataFrame([(1, long)], "doc_id long, text string")).first()
    assert (row.n_words, row.n_repeat_words, row.kept) == (70_006, 0, True)


def test_cascade_order_changes_no_verdict(docs):
    kept = {tuple(r) for r in rules.kept(docs).select("doc_id").collect()}
    for order in (rules.RULES, rules.RULES[::-1]):
        again = docs.where(rules.verdict(list(order)).isNull()).select("doc_id").collect()
        assert {tuple(r) for r in again} == kept
    assert sorted(r.name for r in rules.ordered(docs)) == sorted(r.name for r in rules.RULES)
    assert rules.kept(docs).columns == docs.columns


# LM scoring


def test_scores_are_the_models(spark, docs, texts):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    counts = {}
    for name, ids in (("target", good), ("background", set(texts))):
        one, first, two = Counter(), Counter(), Counter()
        for i in ids & set(texts):
            w, before, pair = scoring.slots((texts[i] or "").encode())
            one.update(w.tolist()), first.update(before.tolist()), two.update(pair.tolist())
        counts[name] = one, first, two
    rows = scoring.scored(docs, labels).collect()
    assert len(rows) == len(texts)
    for r in rows[:40]:
        w, before, pair = (x.tolist() for x in scoring.slots((texts[r.doc_id] or "").encode()))
        loss = {}
        for name, (one, first, two) in counts.items():
            total = sum(one.values())
            ps = []
            for a, b, c in zip(w, before, pair):
                single = (one[a] + 1) / (total + 2**scoring.WORD_BITS)
                part = min(two[c], first[b]) / first[b] if first[b] else 0
                k = scoring.PAIR_WEIGHT if first[b] else 0
                ps.append(-math.log(k * part + (1 - k) * single))
            loss[name] = sum(ps) / len(ps)
        assert r.n_tokens == len(w)
        assert math.isclose(r.score, loss["target"] - loss["background"], abs_tol=1e-9)
        assert math.isclose(r.target_loss, loss["target"]) and math.isclose(r.background_loss, loss["background"])


def scores_by_brute_force(rows, good):
    """(n_tokens, target loss, background loss) of each (id, text), from counts of real words and pairs of words."""
    models = [(Counter(), Counter(), Counter()) for _ in range(2)]
    split = [[lower(w) for w in words(t)] for _, t in rows]
    for (i, _), w in zip(rows, split):
        for one, first, two in models[0 if i in good else 1 :]:
            before = [None, *w[:-1]] if w else []
            one.update(w), first.update(before), two.update(zip(before, w))
    vocabulary = max(len(models[1][0]), 2**scoring.WORD_BITS)
    out = []
    for w in split:
        loss = []
        for one, first, two in models:
            total, sum_ = sum(one.values()), 0.0
            for b, c in zip([None, *w[:-1]], w):
                single = (one[c] + 1) / (total + vocabulary)
                k = scoring.PAIR_WEIGHT if first[b] else 0
                sum_ -= math.log(k * (two[b, c] / first[b] if first[b] else 0) + (1 - k) * single)
            loss.append(sum_ / len(w) if w else None)
        out.append((len(w), *loss))
    return out


def check_scores(spark, frame, good):
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    labels = spark.createDataFrame([(i, 1) for i in good], "doc_id long, quality int")
    order = lambda found: sorted(found, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))
    expected = order((i, *x) for (i, _), x in zip(rows, scores_by_brute_force(rows, good)))
    got = order((r.doc_id, r.n_tokens, r.target_loss, r.background_loss) for r in scoring.scored(frame, labels).collect())
    assert [r[:2] for r in got] == [r[:2] for r in expected]
    for g, e in zip(got, expected):
        assert g[2:] == e[2:] or all(math.isclose(x, y, rel_tol=1e-9) for x, y in zip(g[2:], e[2:]))


def test_scores_are_those_of_real_words(spark, docs, texts, odd):
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    check_scores(spark, docs.select("doc_id", "text"), good)
    check_scores(spark, odd.select("doc_id", "text"), {1, 6, 77})


def test_scores_of_more_words_than_the_least_vocabulary_in_many_batches(spark, monkeypatch):
    """400,000 different words, each pair met once: before, words and pairs shared slots."""
    monkeypatch.setattr(scoring, "BATCH", 7000)
    monkeypatch.setattr(scoring, "BUCKET", 1 << 18)
    rows = [(i, " ".join(f"w{k % 400_000}" for k in range(i * 2000, i * 2000 + 2500))) for i in range(200)]
    check_scores(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), set(range(0, 200, 3)))


def test_scores_tell_labels_apart_on_held_out_documents(spark):
    """Half of the labels teach the target, the other half is ranked."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = scoring.scored(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good = [r.score for r in got if r.quality == 1]
    bad = [r.score for r in got if r.quality == 0]
    wins = sum((g < b) + 0.5 * (g == b) for g in good for b in bad)
    assert good and bad and wins / (len(good) * len(bad)) > 0.9


def test_scores_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, 1), (6, 0), (None, 1), (77, 1)], "doc_id long, quality int")
    rows = scoring.scored(odd, labels).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r.score is None) == (r.n_tokens == 0) and (r.score is None or math.isfinite(r.score))
    assert scoring.scored(empty, labels).collect() == []
    assert len(scoring.scored(odd, labels.where("false")).collect()) == odd.count()


def test_texts_are_counted_by_one_python_worker_of_a_task(odd):
    """Rows passed a worker that sifted and one that counted in each task, which both kept their memory."""
    marked = odd.select(F.col("doc_id").alias("label_id")).where("doc_id IN (1, 6)").distinct()
    met = scoring.bitmap(marked.select(F.xxhash64("label_id").alias("label")), "label")
    rows = scoring.flagged(odd, marked, met, "doc_id", "text")
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapInArrow") == 1
    found = scoring.counted(rows, 1, met).where(F.col("kind") == scoring.DOCUMENT).agg(F.sum("n")).first()[0]
    assert found == odd.count()


def test_sifting_and_counting_are_no_two_workers_of_a_task_with_few_labels(odd):
    """A few labels were broadcast, and rows then passed a worker that sifted and one that counted in one task."""
    marked = odd.select(F.col("doc_id").alias("label_id")).where("doc_id IN (1, 6)").distinct()
    met = scoring.bitmap(marked.select(F.xxhash64("label_id").alias("label")), "label")
    rows = scoring.flagged(odd, marked, met, "doc_id", "text")
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_texts_of_batches_do_not_travel(odd):
    """Texts were stored, and shuffled once more to meet the sums: only the path of a batch's file stands in its row."""
    marked = odd.select(F.col("doc_id").alias("label_id")).where("doc_id IN (1, 6)").distinct()
    met = scoring.bitmap(marked.select(F.xxhash64("label_id").alias("label")), "label")
    found = scoring.counted(scoring.flagged(odd, marked, met, "doc_id", "text"), 1, met).where(F.col("kind") == scoring.DOCUMENT)
    rows = found.collect()
    assert rows and sum(r.n for r in rows) == odd.count()
    assert all(bytes(r.counts).decode().endswith(f"/{r.batch}.arrow") for r in rows)
    # Tasks that run again replace their files by their equals.
    assert sorted(found.collect()) == sorted(rows)


def test_scores_of_batches_without_words(spark):
    rows = [(i, x) for i, x in enumerate([None, "", " \n"] * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")
    got = scoring.scored(docs, labels).collect()
    assert sorted(r.doc_id for r in got) == list(range(12)) and all(r.n_tokens == 0 and r.score is None for r in got)
