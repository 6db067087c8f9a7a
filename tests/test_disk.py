"""What lies on disk: intermediate tables and shuffles go, and large tables are made in slices that give the same rows."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F
from test_history import customer_feed, product_feed
from test_streams import arriving, frame

from asterline import session
from asterline.plans import star as S
from asterline.streaming import flows


def kept(spark):
    """Intermediate tables in the shared folder."""
    top = f"{session.shared_dir(spark)}/asterline".removeprefix("file:")
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def shuffled(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def new_shuffles(spark, before):
    """Files are removed in the background."""
    for _ in range(60):
        if not (left := shuffled(spark) - before):
            break
        time.sleep(0.5)
    return left


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def slices(monkeypatch):
    """Two or three slices of the few rows here."""
    monkeypatch.setattr(S, "SLICE_ROWS", 12, raising=False)


@pytest.fixture
def lines(spark, seed):
    """The seed's lines and more, some of which break a rule, one without a product and some that come twice."""
    more = [(1000 + i % 2, 10 + i, (100, 200, 999, None)[i % 4], i % 5 - 1, 1.0 + i % 3) for i in range(24)]
    extra = spark.createDataFrame([*more, *more[:3]], seed.order_line.schema)
    return seed.order_line.unionByName(extra)


@pytest.fixture(scope="module")
def dimensions(spark, seed):
    return S.dim_product(product_feed(seed)).cache(), S.dim_customer(customer_feed(seed)).cache()


def judged_counts(lines, dimensions, seed):
    placed = S.resolved_orders(seed.order, dimensions[1])
    whole = S.fact_columns(S.asof_join(lines.join(placed, "order_id"), dimensions[0], "product_id", "ordered_at", ["product_key"]))
    return whole.count(), whole.filter("NOT (quantity > 0 AND line_revenue >= 0)").count()


def test_a_fact_stream_leaves_only_its_tables(spark, seed, lines, dimensions, slices, tmp_path):
    want = rows(S.fact_order_line(lines, seed.order, *dimensions))
    n, broken = judged_counts(lines, dimensions, seed)
    zone = str(tmp_path / "lines")
    lines.write.parquet(zone)
    flow = flows.FactFlow(spark, str(tmp_path / "fact"), seed.order, *dimensions)
    tables, files = kept(spark), shuffled(spark)
    flow.run(spark.readStream.schema(lines.schema).parquet(zone))
    assert kept(spark) == tables
    assert not new_shuffles(spark, files)
    assert rows(flow.fact()) == want
    counts = {r.rule_id: (r.n_rows, r.failures, r.quarantined) for r in flows.rule_counts(spark, flow.target).collect()}
    assert counts["measures_non_negative"] == (n, broken, broken) and 0 < broken < n
    assert spark.read.parquet(f"{flow.target}/quarantine").count() == broken
    assert not [d for d in os.listdir(f"{flow.target}/fact") if d.startswith(".batch")]


def test_late_orders_leave_only_their_tables(spark, seed, lines, dimensions, slices, tmp_path):
    orders = seed.order.select("order_id", "customer_id", "ordered_at")
    line_zone, order_zone = str(tmp_path / "lines"), str(tmp_path / "orders")
    lines.write.parquet(line_zone)
    orders.filter("false").write.parquet(order_zone)
    flow = flows.FactFlow(spark, str(tmp_path / "fact"), orders.filter("false"), *dimensions)
    arrived = [spark.readStream.schema(d.schema).parquet(z) for d, z in ((lines, line_zone), (orders, order_zone))]
    want = rows(S.fact_order_line(lines, seed.order, *dimensions))
    tables, files = kept(spark), shuffled(spark)
    for part in (None, "order_id = 1001", "order_id = 1000"):
        if part:
            orders.filter(part).write.mode("append").parquet(order_zone)
        flow.run(*arrived)
    assert kept(spark) == tables
    assert not new_shuffles(spark, files)
    assert rows(flow.fact()) == want


def test_a_star_in_slices(spark, seed, lines, dimensions, slices, tmp_path):
    tables = kept(spark)
    star = S.build_star(spark, str(tmp_path), *dimensions, seed.order, lines)
    assert kept(spark) == tables
    assert sorted(os.listdir(tmp_path)) == ["dim_customer", "dim_date", "dim_product", "fact_order_line"]
    assert rows(star.fact_order_line) == rows(S.fact_order_line(lines, seed.order, star.dim_product, star.dim_customer))


def test_a_dimension_stream_leaves_only_its_tables(spark, slices, tmp_path):
    batches = [[(k, n, n + v) for k in (1, 2, 3, None) for n in range(b, 5 + b) for v in range(2)] for b in range(2)]
    flow = flows.DimensionFlow(spark, str(tmp_path / "dim"), ["k"], "key", frame(spark, []).schema, [flows.Rule("v", "v < 10")])
    zone = str(tmp_path / "zone")
    tables, files = kept(spark), shuffled(spark)
    for part in batches:
        frame(spark, part).coalesce(1).write.mode("append").parquet(zone)
        flow.run(arriving(spark, zone))
    assert not new_shuffles(spark, files)
    flow.materialize()
    assert kept(spark) == tables
    pairs = {(k, n) for b in batches for k, n, v in b if v < 10}
    log = flow.log()
    assert log.count() == len({r for b in batches for r in b if r[2] < 10})
    keyed, known = log.where("key IS NOT NULL"), {p for p in pairs if p[0] is not None}
    for columns in (["key"], ["k", "updated_at"], ["key", "k", "updated_at"]):
        assert keyed.select(*columns).distinct().count() == len(known)
    assert rows(flow.dimension()) == rows(flow.versions())
    assert flow.dimension().count() == len(pairs)


def test_what_passes_goes_and_what_outlives_stays(spark):
    df, before = spark.range(4), kept(spark)
    with session.passing(spark):
        with pytest.raises(ZeroDivisionError), session.passing(spark):
            out = session.stored(df, "stays", outlives=True)
            session.stored(df, "goes")
            1 / 0  # noqa: B018
        assert out.count() == 4 and len(kept(spark) - before) == 1
    assert kept(spark) == before
    assert session.stored(df, "lies").count() == 4 and len(kept(spark) - before) == 1
    assert spark.conf.get(session.SHUFFLES_GO) == "false"


def test_an_asof_join_keeps_one_narrow_table(spark, seed, dimensions):
    before = kept(spark)
    known = S.resolved_orders(seed.order, dimensions[1])
    left = kept(spark) - before
    assert [t.rsplit("-", 1)[0] for t in left] == ["asof-known"]
    assert known.count() == seed.order.count() and known.where(F.col("customer_key").isNull()).count() == 0
