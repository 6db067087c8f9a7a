"""Hash chains and lineage."""

from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from asterline.functions import scalars
from asterline.operators import ledger as L
from asterline.operators import lineage as G


def entries(spark, n=5, chain="a"):
    rows = [(chain, i, "m", json.dumps({"a": i, "b": "é"}, ensure_ascii=False, separators=(",", ":"))) for i in range(n)]
    return spark.createDataFrame(rows, "chain_id string, at long, machine string, payload string")


def verified(log, **kwargs):
    (row,) = L.verify(log.withColumn("line", F.col("line")), "line", **kwargs).collect()
    return row.entries, row.intact, row.broken_at, row.detail


@pytest.fixture(scope="module")
def chain(spark):
    built = L.build(entries(spark), "at").cache()
    return built.withColumn("line", F.col("sequence"))


def test_known_answer(spark):
    df = spark.createDataFrame([("m", '{"a":1,"b":2}', 0)], "machine string, payload string, sequence long")
    text = '{"machine":"m","payload":{"a":1,"b":2},"previous_hash":"' + "0" * 64 + '","sequence":0}'
    got = df.select(scalars.entry_hash("machine", "payload", F.lit(scalars.GENESIS), "sequence")).first()[0]
    assert got == hashlib.sha256(text.encode()).hexdigest()
    one = spark.range(1).select(scalars.canonical_json(b=F.lit(2), a=F.lit(1))).first()[0]
    assert one == '{"a":1,"b":2}'
    null = spark.range(1).select(scalars.canonical_json(a=F.lit(None).cast("int"))).first()[0]
    assert null == '{"a":null}'


def test_chain_against_brute_force(spark, chain):
    previous = scalars.GENESIS
    for r in chain.orderBy("sequence").collect():
        assert r.previous_hash == previous
        text = '{"machine":"m","payload":%s,"previous_hash":"%s","sequence":%d}' % (r.payload, previous, r.sequence)
        previous = hashlib.sha256(text.encode()).hexdigest()
        assert r.entry_hash == previous


def test_intact(chain):
    assert verified(chain) == (5, True, -1, "chain verifies")


def test_edit(chain):
    bad = chain.withColumn("payload", F.when(F.col("sequence") == 1, "{}").otherwise(F.col("payload")))
    assert verified(bad) == (5, False, 1, "the record's contents do not match its hash")


def test_first_break_only(spark):
    log = L.build(entries(spark, 6), "at").withColumn("line", F.col("sequence"))
    bad = log.withColumn("machine", F.when(F.col("sequence") == 2, "x").otherwise(F.col("machine")))
    assert verified(bad)[:3] == (6, False, 2)


def test_swap(chain):
    line = F.when(F.col("sequence") == 0, 1).when(F.col("sequence") == 1, 0).otherwise(F.col("sequence"))
    assert verified(chain.withColumn("line", line)) == (5, False, 0, "sequence 1 found at position 0")


def test_deletion(chain):
    assert verified(chain.filter("sequence <> 1")) == (4, False, 1, "sequence 2 found at position 1")


def test_false_link(chain):
    bad = chain.withColumn(
        "previous_hash", F.when(F.col("sequence") == 3, "f" * 64).otherwise(F.col("previous_hash"))
    )
    assert verified(bad) == (5, False, 3, "previous_hash does not match the preceding record")


def test_lost_tail_is_not_seen(chain):
    assert verified(chain.filter("sequence < 3"))[:2] == (3, True)


def test_empty_chain_is_intact(spark, chain):
    names = spark.createDataFrame([("a",), ("nobody",)], "chain_id string")
    rows = {r.chain_id: r for r in L.verify(chain, "line", names).collect()}
    assert (rows["nobody"].entries, rows["nobody"].intact, rows["nobody"].detail) == (0, True, "empty ledger")
    assert rows["a"].entries == 5


def test_appending_continues_the_stored_chain(spark):
    whole = sorted(map(tuple, L.build(entries(spark, 50), "at").collect()))
    first = L.build(entries(spark, 50).filter("at < 20"), "at").cache()
    more = L.build(entries(spark, 50).filter("at >= 20"), "at", first)
    assert sorted(map(tuple, first.unionByName(more).collect())) == whole
    other = L.build(entries(spark, 2, "b"), "at", first).orderBy("sequence").collect()
    assert [r.sequence for r in other] == [0, 1] and other[0].previous_hash == scalars.GENESIS


@pytest.mark.parametrize("at", [2, 4])
@pytest.mark.parametrize("field", ["sequence", "previous_hash", "entry_hash", "machine", "payload"])
def test_an_erased_field_is_a_break(chain, field, at):
    bad = chain.withColumn(field, F.when(F.col("line") != at, F.col(field)))
    entries, intact, broken, _ = verified(bad)
    assert (entries, intact, broken) == (5, False, at)


def test_a_rehashed_stretch_breaks_where_it_ends(spark):
    log = L.build(entries(spark, 40), "at").withColumn("line", F.col("sequence")).cache()
    head = log.filter("sequence < 8").drop("line")
    forged = entries(spark, 16).filter("at >= 8").withColumn("payload", F.lit("{}"))
    stretch = L.build(forged, "at", head).withColumn("line", F.col("sequence"))
    bad = log.filter("sequence < 8 OR sequence > 15").unionByName(stretch)
    assert verified(bad) == (40, False, 16, "previous_hash does not match the preceding record")


LOG = [
    ("s.a", "d.x"), ("s.a", "d.x"), (None, "d.x"), ("s.b", "d.y"), ("d.x", "f.z"), ("d.y", "f.z"),
    ("f.z", "s.b"), ("q.raw", "d.y"),
]


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(LOG, "source string, target string")


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_lineage(spark, log):
    assert pairs(G.edges(log)) == {p for p in LOG if p[0]}
    assert pairs(G.upstream_of(log, "f.z")) == {("d.x",), ("d.y",)}
    names = spark.createDataFrame([("d.x",), ("d.date",)], "name string")
    assert pairs(G.untraced(names, log)) == {("d.date",)}
    required = spark.createDataFrame([("s.a", "d.x"), ("s.c", "d.x")], "source string, target string")
    assert pairs(G.missing_edges(required, log)) == {("s.c", "d.x")}
    assert pairs(G.foreign_edges(log, "d", ["s", "d", "f"])) == {("q.raw", "d.y")}
    sources = spark.createDataFrame([("s.a",), ("s.b",)], "name string")
    assert pairs(G.into_sources(log, sources, "f")) == {("f.z", "s.b")}


def test_impact_survives_a_cycle(spark, log):
    roots = spark.createDataFrame([("s.a",), ("s.b",)], "name string")
    assert pairs(G.impact(log, roots)) == {
        ("s.a", "d.x", 1), ("s.a", "f.z", 2), ("s.a", "s.b", 3), ("s.a", "d.y", 4),
        ("s.b", "d.y", 1), ("s.b", "f.z", 2),
    }


def test_two_loads_on_one_tail_are_a_fork(spark):
    """Both writers read the same tail: their entries claim the same places, and only one load can be appended."""
    make = lambda rows: spark.createDataFrame([(*r, "m", "{}") for r in rows], "chain_id string, n long, machine string, payload string")
    first = L.build(make([("a", 1), ("a", 2), ("b", 1)]), "n").cache()
    one = L.build(make([("a", 3), ("c", 1)]), "n", first).cache()
    two = L.build(make([("a", 4), ("a", 5)]), "n", first).cache()
    log = L.appended(first, one).cache()
    assert L.forks(log).count() == 0 and log.count() == 5
    assert {(r.chain_id, r.sequence, r.writers) for r in L.forks(log.unionByName(two)).collect()} == {("a", 2, 2)}
    with pytest.raises(Exception, match="not built on the tail of chain a"):
        L.appended(log, two).collect()
    again = L.build(make([("a", 4), ("a", 5)]), "n", log)
    whole = L.appended(log, again)
    assert all(r.intact for r in L.verify(whole.withColumn("line", whole["sequence"]), "line").collect())
    gap = one.withColumn("sequence", one["sequence"] + 1)
    with pytest.raises(Exception, match="not built on the tail"):
        L.appended(first, gap).collect()
