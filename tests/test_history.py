"""History: versions, keys, as-of joins, and that hot keys change nothing."""

from __future__ import annotations

import datetime
import random

import pytest
from conftest import day
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from asterline.contracts import END, SEQUENCE, START
from asterline.operators import asof, scd2
from asterline.operators.surrogate import assign_keys
from asterline.operators.timeline import PIECE, cut_points, in_pieces, last_known, with_neighbour, with_position
from asterline.plans import star as S
from asterline.sources import sinks

EPOCH = datetime.datetime(2026, 1, 1)


def moment(n: int) -> datetime.datetime:
    return EPOCH + datetime.timedelta(hours=n)


def product_feed(seed):
    first = seed.product.withColumn(SEQUENCE, sinks.at("2026-01-01"))
    second = seed.changed.withColumn(SEQUENCE, sinks.at("2026-03-01"))
    feed = first.unionByName(second).join(seed.category, "category_id", "left")
    return feed.select("product_id", "product_name", "category_name", "list_price", SEQUENCE)


def customer_feed(seed):
    stamped = seed.customer.withColumn(SEQUENCE, sinks.at("2026-01-01"))
    return stamped.select("customer_id", "full_name", "email_domain", SEQUENCE)


def test_seed_dimension(seed):
    rows = S.dim_product(product_feed(seed)).orderBy("product_id", START).collect()
    assert [(r.product_id, r.category_name, r.list_price, r[START], r[END]) for r in rows] == [
        (100, "Tools", 9.99, day("2026-01-01"), day("2026-03-01")),
        (100, "Tools", 11.99, day("2026-03-01"), None),
        (200, "Books", 55.0, day("2026-01-01"), None),
    ]
    assert len({r.product_key for r in rows}) == 3


def test_seed_fact(seed):
    products = S.dim_product(product_feed(seed)).cache()
    customers = S.dim_customer(customer_feed(seed)).cache()
    key = {(r.product_id, r.list_price): r.product_key for r in products.collect()}
    who = {r.customer_id: r.customer_key for r in customers.collect()}
    rows = S.fact_order_line(seed.order_line, seed.order, products, customers)
    got = sorted(tuple(r) for r in rows.collect())
    assert [(*r[:-1], round(r[-1], 2)) for r in got] == [
        (1000, 1, who[1], key[100, 9.99], 20260201, 2, 9.99, 19.98),
        (1000, 2, who[1], key[200, 55.0], 20260201, 1, 55.0, 55.0),
        (1001, 1, who[2], key[100, 11.99], 20260401, 3, 11.99, 35.97),
        (1001, 2, who[2], -1, 20260401, 1, 1.0, 1.0),
    ]


def test_built_star_on_disk(spark, seed, tmp_path):
    star = S.build_star(
        spark, str(tmp_path), S.dim_product(product_feed(seed)), S.dim_customer(customer_feed(seed)),
        seed.order, seed.order_line,
    )
    joined = S.star_join(star.fact_order_line, star.dim_product, star.dim_customer, star.dim_date)
    assert {(r.order_id, r.line_number): r.category_name for r in joined.collect()} == {
        (1000, 1): "Tools", (1000, 2): "Books", (1001, 1): "Tools", (1001, 2): "Unknown",
    }
    assert star.dim_date.count() == 60
    pruned = star.fact_order_line.filter("date_key >= 20260301")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_key" in plan
    assert pruned.count() == 2


def test_a_rebuilt_star_keeps_its_keys(spark, seed, tmp_path):
    """First the feed of january, then all of it and a product with a smaller id and one without: old keys stay."""
    january = product_feed(seed).filter(F.col(SEQUENCE) < sinks.at("2026-02-01"))
    customers = S.dim_customer(customer_feed(seed))
    first = S.build_star(spark, str(tmp_path / "a"), S.dim_product(january), customers, seed.order, seed.order_line)
    more = product_feed(seed).filter("product_id = 100").withColumn("product_id", F.lit(5).cast("long"))
    newer = S.dim_product(product_feed(seed).unionByName(more))
    second = S.build_star(spark, str(tmp_path / "b"), newer, customers, seed.order, seed.order_line, before=first)
    third = S.build_star(spark, str(tmp_path / "c"), newer, customers, seed.order, seed.order_line, before=second)
    key = [{(r.product_id, r[START]): r.product_key for r in s.dim_product.collect()} for s in (first, second, third)]
    assert len(key[0]) == 2 and len(key[1]) == 5 and len(set(key[1].values())) == 5
    assert key[0].items() <= key[1].items() and key[1] == key[2]
    assert {r.customer_key for r in first.dim_customer.collect()} == {r.customer_key for r in third.dim_customer.collect()}
    old = S.star_join(first.fact_order_line, third.dim_product, third.dim_customer, third.dim_date).collect()
    assert {(r.order_id, r.line_number): r.product_name for r in old}[1000, 1] == "Hammer" and len(old) == 4


def test_null_keys_keep_their_numbers(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), (3, 1)], f"k long, {SEQUENCE} long")
    first = assign_keys(rows, ["k"], SEQUENCE, "key").cache()
    again = assign_keys(rows.unionByName(spark.createDataFrame([(None, 3)], rows.schema)), ["k"], SEQUENCE, "key", stored=first)
    numbers = {(r.k, r[SEQUENCE]): r.key for r in again.collect()}
    assert len(set(numbers.values())) == 4 and all(numbers[r.k, r[SEQUENCE]] == r.key for r in first.collect())


def test_unknown_member(seed):
    members = S.with_unknown(S.dim_product(product_feed(seed)))
    (row,) = members.filter("product_key = -1").collect()
    assert (row.product_id, row.product_name, row.list_price) == (-1, "Unknown", 0.0)
    assert row[START] == day("1900-01-01") and row[END] is None
    view = scd2.reader_view(members).filter("product_id = 100").orderBy("valid_from").collect()
    assert [r.is_current for r in view] == [False, True]


def test_late_version_splits_the_interval(spark, seed):
    feed = product_feed(seed)
    late = feed.filter("product_id = 200").select(
        F.lit(100).cast("long").alias("product_id"), F.lit("Hammer").alias("product_name"),
        F.lit("Tools").alias("category_name"), F.lit(10.5).alias("list_price"),
        sinks.at("2026-02-15").alias(SEQUENCE),
    )
    rows = scd2.versions(feed.unionByName(late), ["product_id"]).filter("product_id = 100")
    assert [(r.list_price, r[END]) for r in rows.orderBy(START).collect()] == [
        (9.99, day("2026-02-15")), (10.5, day("2026-03-01")), (11.99, None),
    ]


def expected_versions(changes):
    """Brute force: greatest value per (key, sequence), ends at the next sequence."""
    best = {}
    for key, n, value in changes:
        best[key, n] = max(value, best.get((key, n), value))
    out = []
    for (key, n), value in best.items():
        later = [m for k, m in best if k == key and m > n]
        out.append((key, moment(n), value, moment(min(later)) if later else None))
    return sorted(out, key=lambda r: r[:2])


CHANGES = st.lists(
    st.tuples(st.integers(1, 3), st.integers(0, 2000), st.integers(0, 5)), min_size=1, max_size=40
)


def frame(spark, changes):
    rows = [(k, moment(n), v) for k, n, v in changes]
    return spark.createDataFrame(rows, f"k long, {SEQUENCE} timestamp_ntz, v long")


def got(df):
    rows = df.select("k", SEQUENCE, "v", END).collect()
    return sorted((tuple(r) for r in rows), key=lambda r: r[:2])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(changes=CHANGES, seed_=st.integers(0, 99), limit=st.sampled_from([1, 3, 8]))
def test_arrival_batches_and_slices_do_not_matter(spark, changes, seed_, limit):
    """Shuffled, repeated, and cut into slices of every size: one answer."""
    want = expected_versions(changes)
    arrival = changes + random.Random(seed_).choices(changes, k=3)
    random.Random(seed_).shuffle(arrival)
    assert got(scd2.versions(frame(spark, arrival), ["k"])) == want
    assert got(scd2.versions(frame(spark, arrival), ["k"], rows_per_piece=limit)) == want
    # Any split into two batches, the second with all that the first had, gives the same keys and intervals.
    cut = 1 + seed_ % len(arrival)
    first = scd2.collapse(frame(spark, arrival[:cut]), ["k"])
    again = scd2.unseen(scd2.collapse(frame(spark, arrival), ["k"]), first, ["k"])
    assert first.count() + again.count() == len(want)
    plain = lambda rows: [(k, start, end) for k, start, _, end in rows]
    assert plain(got(scd2.versions(first.unionByName(again), ["k"], unique=True))) == plain(want)


def test_hot_key_is_sliced(spark):
    """One key with most rows: the plan changes, the rows do not."""
    hot = [(1, n, n % 7) for n in range(3000)] + [(k, 5, 1) for k in range(2, 50)]
    df = frame(spark, hot)
    assert cut_points(df, ["k"], SEQUENCE, rows=100).count() == 1
    assert cut_points(df, ["k"], SEQUENCE, rows=5000) is None
    assert got(scd2.versions(df, ["k"], rows_per_piece=100)) == expected_versions(hot)


def test_a_burst_in_a_long_timeline_is_cut_evenly(spark):
    """Nine tenths of a key's rows within an hour of ten years: no piece has far more than its share."""
    rows = [(1, n * 40_000_000) for n in range(2_000)] + [(1, 39_000_000_000 + n) for n in range(18_000)] + [(k, 5) for k in range(2, 90)]
    df = spark.createDataFrame(rows, f"k long, {SEQUENCE} long")
    pieces = in_pieces(df, ["k"], SEQUENCE, cut_points(df, ["k"], SEQUENCE, rows=500)).groupBy("k", PIECE).count().collect()
    hot = [r["count"] for r in pieces if r.k == 1]
    assert len(hot) == 40 and max(hot) < 600 and sum(hot) == 20_000
    assert all(r[PIECE] == 0 and r["count"] == 1 for r in pieces if r.k != 1)


@pytest.mark.parametrize("rows", [None, 7, 1])
def test_last_known_value(spark, rows):
    """Carried over cuts, over gaps longer than a piece, and never to another key."""
    made = [(k, n, None if n % 17 else n) for k in (1, None) for n in range(-40, 120, 3)]
    df = spark.createDataFrame(made, "k long, n long, v long")
    want, last = {}, {}
    for k, n, v in sorted(made, key=lambda r: (r[0] or 0, r[1])):
        last[k] = v if v is not None else last.get(k)
        want[k, n] = last[k]
    assert {(r.k, r.n): r.w for r in last_known(df, ["k"], "n", "v", "w", rows=rows).collect()} == want


def test_copies_of_one_change_collapse(spark):
    copies = frame(spark, [(1, 7, 3)] * 500 + [(1, 9, 1)])
    rows = got(scd2.versions(copies, ["k"], rows_per_piece=10))
    assert rows == [(1, moment(7), 3, moment(9)), (1, moment(9), 1, None)]


@pytest.mark.parametrize("pieces", [None, 10, 1])
def test_neighbours_and_positions(spark, pieces):
    rows = [(k, n, None if n % 4 == 0 else n) for k in (1, 2) for n in range(0, 90, 3 * k)]
    df = frame(spark, rows)
    for step, move in (("next", 1), ("previous", -1)):
        out = with_neighbour(df, ["k"], SEQUENCE, F.col("v"), "other", step, rows=pieces).collect()
        for k in (1, 2):
            mine = sorted((r for r in out if r.k == k), key=lambda r: r[SEQUENCE])
            for i, r in enumerate(mine):
                j = i + move
                assert r.other == (mine[j].v if 0 <= j < len(mine) else None)
    placed = with_position(df, ["k"], SEQUENCE, "p", rows=pieces).orderBy("k", SEQUENCE).collect()
    assert [r.p for r in placed if r.k == 1] == list(range(30))


def test_a_rebuild_renumbers_nothing(spark):
    rows = [(k, n) for k in range(30) for n in range(10)]
    whole = spark.createDataFrame(rows, f"k long, {SEQUENCE} long")
    first = assign_keys(whole.filter((F.col("k") % 3 != 0) & (F.col(SEQUENCE) < 7)), ["k"], SEQUENCE, "key").cache()
    again = {(r.k, r[SEQUENCE]): r.key for r in assign_keys(whole, ["k"], SEQUENCE, "key", stored=first).collect()}
    assert len(again) == 300 and len(set(again.values())) == 300
    assert all(again[(r.k, r[SEQUENCE])] == r.key for r in first.collect())


def test_keys_are_unique_stable_and_continue(spark):
    df = frame(spark, [(k, n, 0) for k in range(20) for n in range(50)])
    one = assign_keys(df, ["k"], SEQUENCE, "key")
    two = assign_keys(df.repartition(5, "v"), ["k"], SEQUENCE, "key")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))
    assert one.select("key").distinct().count() == 1000
    top = one.agg(F.max("key")).first()[0]
    more = assign_keys(df, ["k"], SEQUENCE, "key", after=top)
    assert more.agg(F.min("key")).first()[0] > top


@pytest.mark.parametrize("limit", [None, 5, 50])
def test_asof_join(spark, limit):
    """Against brute force: gaps, misses, null keys, ties."""
    random.seed(4)
    versions = []
    for k in (1, 2, 3):
        starts = sorted(random.sample(range(0, 400), 40))
        for i, s in enumerate(starts):
            nxt = starts[i + 1] if i + 1 < len(starts) else None
            end = nxt if nxt is None or i % 5 else s + max(1, (nxt - s) // 2)
            versions.append((k, moment(s), None if end is None else moment(end), k * 1000 + s))
    v = spark.createDataFrame(versions, f"k long, {START} timestamp_ntz, {END} timestamp_ntz, tag long")
    rows = [(i, random.choice([1, 2, 3, 4, None]), moment(random.randrange(0, 420))) for i in range(600)]
    rows += [(600 + i, k, s) for i, (k, s, _, _) in enumerate(versions)] + [(9999, 1, None)]
    left = spark.createDataFrame(rows, "id long, k long, at timestamp_ntz")

    def true_tag(k, at):
        tags = [t for kk, s, e, t in versions
                if at is not None and kk == k and s <= at and (e is None or at < e)]
        return tags[0] if tags else None

    want = {i: true_tag(k, at) for i, k, at in rows}
    out = asof.asof_join(left, v, "k", "at", ["tag"], rows=limit)
    assert out.columns == ["id", "k", "at", "tag"]
    got_ = out.collect()
    assert len(got_) == len(rows) and {r.id: r.tag for r in got_} == want


@pytest.mark.parametrize("limit", [None, 2])
def test_overlapping_versions_have_one_answer(spark, limit):
    """The version that starts last decides, also when it has ended before an earlier one."""
    made = [(1, 0, None, 1), (1, 10, 20, 2), (1, 10, 30, 3), (1, 40, 41, 4), (1, 50, None, 5), (1, 50, 60, 6)]
    v = spark.createDataFrame(
        [(k, moment(s), None if e is None else moment(e), t) for k, s, e, t in made],
        f"k long, {START} timestamp_ntz, {END} timestamp_ntz, tag long",
    )
    asked = {-1: None, 0: 1, 9: 1, 10: 3, 25: 3, 30: None, 40: 4, 45: None, 55: 5, 99: 5}
    left = spark.createDataFrame([(1, moment(n)) for n in asked for _ in range(3)], "k long, at timestamp_ntz")
    rows = asof.asof_join(left, v, "k", "at", ["tag"], rows=limit).collect()
    assert len(rows) == 3 * len(asked) and {r["at"]: r.tag for r in rows} == {moment(n): t for n, t in asked.items()}


def test_change_detection(spark):
    feed = frame(spark, [(1, 0, 5), (1, 1, 5), (1, 2, 6), (1, 3, 5), (2, 0, 1)])
    assert scd2.changed_only(feed, ["k"], ["v"]).count() == 4
    # By default a resent row is a version all the same.
    assert scd2.versions(feed, ["k"]).count() == 5
    state = spark.createDataFrame([(1, 5), (2, None)], "k long, v long")
    batch = spark.createDataFrame([(1, 5), (2, None), (3, 1), (1, None)], "k long, v long")
    kept = {tuple(r) for r in scd2.changed_against(batch, state, ["k"], ["v"]).collect()}
    assert kept == {(3, 1), (1, None)}


@pytest.mark.parametrize("limit", [None, 1])
def test_preferred_column_decides_and_is_dropped(spark, limit):
    rows = [(1, moment(0), 1, 9), (1, moment(0), 2, 3), (1, moment(5), 1, 1)]
    df = spark.createDataFrame(rows, f"k long, {SEQUENCE} timestamp_ntz, message long, v long")
    out = scd2.versions(df, ["k"], prefer=["message"], rows_per_piece=limit)
    assert "message" not in out.columns
    assert [(r.v, r[END]) for r in out.orderBy(START).collect()] == [(3, moment(5)), (1, None)]


def test_calendar(spark):
    bounds = spark.createDataFrame([(day("2025-12-27"), day("2026-01-02"))], "first timestamp_ntz, last timestamp_ntz")
    rows = S.calendar(spark, bounds).orderBy("date_key").collect()
    assert [r.date_key for r in rows][:2] == [20251227, 20251228] and len(rows) == 7
    assert [r.is_weekend for r in rows] == [True, True, False, False, False, False, False]
    assert (rows[-1].year, rows[-1].quarter, rows[0].quarter) == (2026, 1, 4)
