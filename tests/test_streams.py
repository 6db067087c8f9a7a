"""Triggered streams: late, repeated and retried batches."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from asterline.contracts import END, SEQUENCE, START, Rule
from asterline.plans import star as S
from asterline.sources import sinks, tables
from asterline.streaming import flows

EPOCH = datetime.datetime(2026, 1, 1)
SCHEMA = f"k long, {SEQUENCE} timestamp_ntz, v long"


def frame(spark, rows):
    return spark.createDataFrame([(k, EPOCH + datetime.timedelta(hours=n), v) for k, n, v in rows], SCHEMA)


def history(flow):
    rows = flow.versions().select("k", SEQUENCE, "v", END).collect()
    return sorted((r.k, r[SEQUENCE], r.v, r[END]) for r in rows)


def arriving(spark, zone):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(zone)


def test_late_and_repeated_changes(spark, tmp_path):
    zone = str(tmp_path / "zone")
    flow = flows.DimensionFlow(spark, str(tmp_path / "dim"), ["k"], "key", frame(spark, []).schema,
                               [Rule("v", "v >= 0")])
    frame(spark, [(1, 0, 1), (1, 9, 2), (2, 0, 5), (3, 1, -4)]).repartition(1).write.parquet(zone)
    flow.run(arriving(spark, zone))
    before = {tuple(r) for r in flow.log().select("key", "k", SEQUENCE).collect()}
    frame(spark, [(1, 5, 7), (1, 9, 2), (2, 0, 5)]).repartition(1).write.mode("append").parquet(zone)
    flow.run(arriving(spark, zone))
    at = lambda n: EPOCH + datetime.timedelta(hours=n)
    assert history(flow) == [(1, at(0), 1, at(5)), (1, at(5), 7, at(9)), (1, at(9), 2, None), (2, at(0), 5, None)]
    after = {tuple(r) for r in flow.log().select("key", "k", SEQUENCE).collect()}
    assert before < after and len({key for key, _, _ in after}) == 4


def test_conflicts_do_not_depend_on_arrival(spark, tmp_path):
    import itertools

    rows = [(1, 0, 1), (1, 0, 9), (1, 0, 5), (1, 4, 2)]
    parts = [[rows[0], rows[3]], [rows[1]], [rows[2], rows[1]]]
    found = set()
    for n, order in enumerate(itertools.permutations(parts)):
        flow = flows.DimensionFlow(spark, str(tmp_path / str(n)), ["k"], "key", frame(spark, []).schema)
        for number, part in enumerate(order):
            flow.write(frame(spark, part), number)
        assert flow.log().count() == 4
        pairs = flow.log().where("key IS NOT NULL").select("k", SEQUENCE, "key").distinct().collect()
        assert len(pairs) == 2 and len({r.key for r in pairs}) == 2
        found.add(tuple(history(flow)))
    assert len(found) == 1, found
    assert found.pop()[0][2] == 9


def test_divisions_are_those_of_the_first_run(spark, tmp_path):
    schema = frame(spark, []).schema
    flows.DimensionFlow(spark, str(tmp_path), ["k"], "key", schema, buckets=4)
    assert flows.DimensionFlow(spark, str(tmp_path), ["k"], "key", schema, buckets=9).buckets == 4


def test_a_retried_batch_writes_the_same(spark, tmp_path):
    flow = flows.DimensionFlow(spark, str(tmp_path), ["k"], "key", frame(spark, []).schema)
    batches = [frame(spark, [(k, n, n) for k in range(4) for n in range(i, 20, 3)]) for i in range(3)]
    for number, batch in enumerate(batches):
        flow.write(batch, number)
    once = sorted(map(tuple, flow.log().collect()))
    for number, batch in enumerate(batches):
        flow.write(batch, number)
        flow.write(batch, number)
    assert sorted(map(tuple, flow.log().collect())) == once
    assert len(once) == 80


def test_incremental_dimension_equals_a_full_rebuild(spark, tmp_path):
    flow = flows.DimensionFlow(spark, str(tmp_path), ["k"], "key", frame(spark, []).schema)
    for number in range(4):
        keys = range(number, 40, 4) if number < 3 else range(2)
        flow.write(frame(spark, [(k, n, n) for k in keys for n in range(5 + number)]), number)
        flow.materialize(number)
        full = sorted(map(str, flow.versions().select("key", "k", START, END).collect()))
        kept = sorted(map(str, flow.dimension().select("key", "k", START, END).collect()))
        assert kept == full
    # Applying a batch again changes nothing.
    flow.materialize(3)
    assert sorted(map(str, flow.dimension().select("key", "k", START, END).collect())) == full


def test_fact_is_resolved_on_arrival(spark, seed, tmp_path):
    from test_history import customer_feed, product_feed

    customers = S.dim_customer(customer_feed(seed)).cache()
    early = product_feed(seed).filter(F.col(SEQUENCE) < sinks.at("2026-03-01"))
    old = S.dim_product(early).cache()
    new = S.dim_product(product_feed(seed)).cache()
    zone = str(tmp_path / "lines")
    seed.order_line.write.parquet(zone)
    stream = spark.readStream.schema(seed.order_line.schema).parquet(zone)
    flow = flows.FactFlow(spark, str(tmp_path / "fact"), seed.order, old, customers)
    flow.run(stream)
    april = flow.fact().filter("order_id = 1001 AND line_number = 1").first().product_key
    assert april == old.filter("product_id = 100").first().product_key
    # The version that arrived later is used by a rebuild, not written back.
    rebuilt = S.fact_order_line(seed.order_line, seed.order, new, customers)
    now = rebuilt.filter("order_id = 1001 AND line_number = 1").first().product_key
    assert now == new.filter("product_id = 100 AND list_price = 11.99").first().product_key
    # A second run has nothing new to do.
    flow.run(stream)
    assert flow.fact().count() == 4


def test_rule_counts_are_data(spark, tmp_path):
    zone = str(tmp_path / "zone")
    frame(spark, [(1, 0, 1), (1, 1, -1)]).repartition(1).write.parquet(zone)
    frame(spark, [(2, 0, -2)]).repartition(1).write.mode("append").parquet(zone)
    flows.judged_stream(arriving(spark, zone), str(tmp_path / "out"), [Rule("v", "v >= 0"), Rule("k", "k > 1")])
    metrics = spark.read.parquet(str(tmp_path / "out" / "metrics"))
    total = metrics.groupBy("rule_id").agg(F.sum("n_rows"), F.sum("failures")).collect()
    assert {tuple(r) for r in total} == {("v", 3, 2), ("k", 3, 2)}
    rows = spark.read.parquet(str(tmp_path / "out" / "rows"))
    assert {(r.k, r.v): sorted(r.failed_rules) for r in rows.collect()} == {
        (1, 1): ["k"], (1, -1): ["k", "v"], (2, -2): ["v"],
    }


def test_stream_of_a_single_file(spark, seed, tmp_path):
    seed.order.coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    df = tables.stream(spark, str(tmp_path / "t.parquet"), seed.order.schema)
    assert flows.append_stream(df, str(tmp_path / "out")).count() == 2


def test_lines_wait_for_their_orders(spark, seed, tmp_path):
    """Orders in any later batch, some again with a later time: each line comes out once, when its order is there."""
    from test_history import customer_feed, product_feed

    products, customers = S.dim_product(product_feed(seed)).cache(), S.dim_customer(customer_feed(seed)).cache()
    orders = seed.order.select("order_id", "customer_id", "ordered_at")
    line_zone, order_zone = str(tmp_path / "lines"), str(tmp_path / "orders")
    lost = spark.createDataFrame([(7777, 1, 100, 1, 1.0)], seed.order_line.schema)
    seed.order_line.unionByName(lost).coalesce(1).write.parquet(line_zone)
    orders.filter("false").write.parquet(order_zone)
    flow = flows.FactFlow(spark, str(tmp_path / "fact"), orders.filter("false"), products, customers)
    lines, placed = (spark.readStream.schema(d.schema).parquet(z) for d, z in ((seed.order_line, line_zone), (orders, order_zone)))
    seen = []
    for part in (None, "order_id = 1001", "order_id = 1000"):
        if part:
            orders.filter(part).coalesce(1).write.mode("append").parquet(order_zone)
        flow.run(lines, placed)
        seen.append((flow.waiting().count(), sorted(r.order_id for r in flow.fact().collect()) if part else []))
    assert seen == [(5, []), (3, [1001, 1001]), (1, [1000, 1000, 1001, 1001])]
    want = S.fact_order_line(seed.order_line, seed.order, products, customers)
    assert sorted(map(str, flow.fact().select(*want.columns).collect())) == sorted(map(str, want.collect()))
    # The last batch again, as after a failure, changes nothing.
    before = sorted(map(str, flow.fact().collect()))
    last = flow.spark.read.parquet(str(tmp_path / "fact" / "orders")).agg(F.max("batch")).first()[0]
    kinds = (seed.order_line.schema.simpleString(), orders.schema.simpleString())
    again = orders.filter("order_id = 1000").select(
        F.lit(None).cast(kinds[0]).alias("_line"), F.struct("order_id", "customer_id", "ordered_at").alias("_order")
    )
    flow.write(again, last)
    assert sorted(map(str, flow.fact().collect())) == before


def test_rejected_rows_are_counted_and_kept(spark, tmp_path):
    rules = [Rule("v_counts", "v >= 0"), Rule("k_low", "k < 3")]
    flow = flows.DimensionFlow(spark, str(tmp_path), ["k"], "key", frame(spark, []).schema, rules)
    batches = [[(1, 0, 1), (1, 1, -1), (3, 0, -2)], [(2, 0, None), (2, 1, 4), (2, 1, 4)]]
    for number, rows in enumerate(batches):
        flow.write(frame(spark, rows), number)
        flow.write(frame(spark, rows), number)
    assert {tuple(r) for r in flows.rule_counts(spark, flow.target).collect()} == {("v_counts", 6, 3, 3), ("k_low", 6, 1, 3)}
    kept = spark.read.parquet(f"{flow.target}/quarantine").collect()
    assert {(r.k, r.v, tuple(r.failed_rules)) for r in kept} == {(1, -1, ("v_counts",)), (3, -2, ("v_counts", "k_low")), (2, None, ("v_counts",))}
    assert [h[0] for h in history(flow)] == [1, 2]
