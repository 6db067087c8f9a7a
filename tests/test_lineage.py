"""Builds in steps with what they read recorded, and impact on graphs of every shape."""

from __future__ import annotations

import random
from collections import defaultdict
from graphlib import CycleError

import pytest

from asterline.functions import scalars
from asterline.operators import lineage as G
from asterline.plans import steps as B

EDGE = "source string, target string"


def shortest(edges, roots):
    """(root, node, depth), breadth first."""
    below = defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None:
            below[a].add(b)
    out = set()
    for root in roots:
        seen, last = {root: 0}, [root]
        while last:
            new = []
            for a in last:
                for b in below[a]:
                    if b not in seen:
                        seen[b] = seen[a] + 1
                        new.append(b)
            last = new
        out |= {(root, n, d) for n, d in seen.items() if d}
    return out


def impacted(spark, edges, roots):
    found = [tuple(r) for r in G.impact(spark.createDataFrame(edges, EDGE), spark.createDataFrame([(r,) for r in roots], "name string")).collect()]
    assert len(found) == len(set(found))
    return set(found)


@pytest.mark.parametrize("seed", range(4))
def test_impact_of_random_graphs(spark, seed):
    """Chains, trees, meeting points, cycles, loops, several components, repeated and null edges."""
    rng = random.Random(seed)
    n = rng.choice([6, 14, 30])
    edges = [(f"n{rng.randrange(n)}", f"n{rng.randrange(n)}") for _ in range(rng.choice([n // 2, n, n + 4, 2 * n]))]
    edges += [(f"n{i}", f"n{i + 1}") for i in range(0, n, 3)] + [(f"n{n}", f"c{0}")] + [(f"c{i}", f"c{i + 1}") for i in range(9)]
    edges += [("p0", "p1"), ("p1", "p2"), ("p2", "p0"), ("p1", "q"), ("s", "s"), (None, "n1"), ("n0", None), *edges[:3]]
    roots = ["n0", "n1", "c4", "absent", "p2" if seed % 2 else "q"]
    assert impacted(spark, edges, roots) == shortest(edges, roots)


def test_impact_takes_the_shortest_of_long_ways(spark):
    """A long chain and a short one to one node: what was reached by the long one first is corrected."""
    long = [("r", "a0"), *((f"a{i}", f"a{i + 1}") for i in range(40)), ("a40", "z")]
    short = [("r", "b"), ("b", "m"), ("r", "m"), ("m", "k"), ("b", "k"), ("k", "z"), ("m", "z"), ("z", "end")]
    assert impacted(spark, long + short, ["r"]) == shortest(long + short, ["r"])


def test_a_deep_chain_has_a_plan_of_constant_size(spark):
    def leaves(depth):
        log = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(depth)], EDGE)
        found = G.impact(log, spark.createDataFrame([("n0",)], "name string"))
        assert found.agg({"depth": "max"}).first()[0] == depth and found.count() == depth
        return found._jdf.queryExecution().analyzed().collectLeaves().size()

    assert leaves(8) == leaves(1000)


def test_impact_of_nothing(spark):
    assert impacted(spark, [], ["r"]) == set()
    assert impacted(spark, [("a", "b")], []) == set()


def frames(spark):
    return {"in.a": spark.range(3).withColumnRenamed("id", "x"), "in.b": spark.range(5).withColumnRenamed("id", "x")}


def log_of(spark, path):
    return sorted(((r.source, r.target) for r in B.recorded(spark, path).collect()), key=str)


def test_steps_run_in_the_order_of_what_they_read(spark, tmp_path):
    steps = [
        B.Step("out.c", ("out.b", "out.a"), lambda t: t["out.b"].join(t["out.a"], "x")),
        B.Step("out.b", ("out.a", "in.b"), lambda t: t["in.b"].join(t["out.a"], "x", "left_anti").unionByName(t["out.a"])),
        B.Step("out.a", ("in.a", "in.b"), lambda t: t["in.a"].where("x > 0")),
        B.Step("out.days", (), lambda t: spark.range(2)),
    ]
    log = str(tmp_path / "log")
    done = B.run(spark, steps, frames(spark), str(tmp_path / "t"), log)
    assert sorted(r.x for r in done["out.b"].collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.x for r in done["out.c"].collect()) == [1, 2]
    # out.a names in.b and does not take it.
    edges = [("in.a", "out.a"), ("in.b", "out.b"), ("out.a", "out.b"), ("out.a", "out.c"), ("out.b", "out.c")]
    assert log_of(spark, log) == sorted([*edges, (None, "out.days")], key=str)
    B.run(spark, steps, frames(spark), str(tmp_path / "t2"), log)
    assert len(log_of(spark, log)) == 12 and G.edges(B.recorded(spark, log)).count() == 5
    assert B.recorded(spark, log).where("at IS NULL").isEmpty()


def test_what_is_wrong_with_steps_is_an_error_before_anything_is_written(spark, tmp_path):
    same = lambda name: lambda t: t[name]
    run = lambda *steps: B.run(spark, steps, frames(spark), str(tmp_path / "t"), str(tmp_path / "log"))
    with pytest.raises(CycleError):
        run(B.Step("o.a", ("o.b",), same("o.b")), B.Step("o.b", ("o.a",), same("o.a")), B.Step("o.c", ("in.a",), same("in.a")))
    with pytest.raises(ValueError, match="nothing gives in.z"):
        run(B.Step("o.a", ("in.z",), same("in.z")))
    with pytest.raises(ValueError, match="twice"):
        run(B.Step("o.a", ("in.a",), same("in.a")), B.Step("o.a", ("in.b",), same("in.b")))
    with pytest.raises(ValueError, match="twice"):
        run(B.Step("in.a", ("in.b",), same("in.b")))
    assert not list(tmp_path.iterdir())


def test_a_step_that_fails_is_not_logged(spark, tmp_path):
    steps = [
        B.Step("o.good", ("in.a",), lambda t: t["in.a"]),
        B.Step("o.bad", ("in.a",), lambda t: t["in.b"]),
        B.Step("o.after", ("o.bad",), lambda t: t["o.bad"]),
    ]
    with pytest.raises(LookupError, match="o.bad reads in.b without naming it"):
        B.run(spark, steps, frames(spark), str(tmp_path / "t"), str(tmp_path / "log"))
    assert log_of(spark, str(tmp_path / "log")) == [("in.a", "o.good")]
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["o.good"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"b": {"z": 1, "a": null}, "a": [{"y": "é", "x": 1.50}, 2], "B": ""}', '{"B":"","a":[{"x":1.5,"y":"é"},2],"b":{"a":null,"z":1}}'),
        ('[3, 1, {}]', "[3,1,{}]"), ("null", "null"), ('"q\\"\\n"', '"q\\"\\n"'),
        ('{"a":1,"a":2}', None), ("no json", None), ("", None), (None, None),
    ],
)
def test_canonical_object(spark, text, expected):
    assert spark.createDataFrame([(text,)], "t string").select(scalars.canonical_object("t")).first()[0] == expected
