import pytest
from helpers import rows

from tidegate.operators import lineage
from tidegate.plans.propagate import RefreshError, refresh

# Sources 1 and 4; model 3 needs both; snapshot 2 needs source 1 and model 3.
NODES = [
    ("source.p.s.n1", "source", []),
    ("source.p.s.n4", "source", []),
    ("model.p.n3", "model", ["source.p.s.n1", "source.p.s.n4"]),
    ("snapshot.p.n2", "snapshot", ["source.p.s.n1", "model.p.n3"]),
    ("test.p.n5", "test", ["model.p.n3"]),
]


@pytest.fixture
def nodes(spark):
    return spark.createDataFrame(NODES, "unique_id string, resource_type string, depends_on array<string>")


def starts(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "node string")


def test_edges(nodes):
    assert rows(lineage.edges(nodes)) == [
        ("model.p.n3", "snapshot.p.n2"),
        ("source.p.s.n1", "model.p.n3"),
        ("source.p.s.n1", "snapshot.p.n2"),
        ("source.p.s.n4", "model.p.n3"),
    ]


@pytest.mark.parametrize("start", ["source.p.s.n1", "source.p.s.n4"])
def test_closure_and_order(spark, nodes, start):
    links = lineage.edges(nodes)
    assert {r.node for r in lineage.closure(links, starts(spark, start)).collect()} == {start, "model.p.n3", "snapshot.p.n2"}
    placed = {r.node: r.level for r in lineage.levels(links, starts(spark, start)).collect()}
    assert placed == {start: 0, "model.p.n3": 1, "snapshot.p.n2": 2}


def test_a_start_without_dependents(spark, nodes):
    links = lineage.edges(nodes)
    assert rows(lineage.levels(links, starts(spark, "snapshot.p.n2"))) == [("snapshot.p.n2", 0)]
    assert rows(lineage.closure(links, starts(spark))) == []


def test_long_chain(spark):
    links = spark.createDataFrame([(str(i), str(i + 1)) for i in range(19)] + [("0", "19")], "parent string, child string")
    placed = {r.node: r.level for r in lineage.levels(links, starts(spark, "0")).collect()}
    assert placed == {str(i): i for i in range(20)}


def test_cycles_end(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("c", "d"), ("a", "e")], "parent string, child string")
    assert {r.node for r in lineage.closure(links, starts(spark, "a")).collect()} == set("abcde")
    placed = {r.node: r.level for r in lineage.levels(links, starts(spark, "a")).collect()}
    assert placed == {"a": 0, "e": 1, "b": None, "c": None, "d": None}


def test_impact(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "d"), ("d", "e"), ("c", "f")], "parent string, child string")
    status = {r.node: r.status for r in lineage.impact(links, starts(spark, "a"), starts(spark, "b", "c", "z")).collect()}
    assert status == {"a": "done", "b": "failed", "c": "blocked", "d": "done", "e": "done", "f": "blocked"}


def test_refresh_runs_parents_first(nodes):
    ran = []
    builders = {"model.p.n3": lambda: ran.append("n3"), "snapshot.p.n2": lambda: ran.append("n2")}
    assert set(refresh(nodes, "source.p.s.n1", builders).values()) == {"done"}
    assert ran == ["n3", "n2"]


def test_refresh_contains_failures(spark, nodes):
    ran = []

    def fail():
        raise RuntimeError("no")

    more = nodes.union(spark.createDataFrame([("model.p.n6", "model", ["source.p.s.n1"])], nodes.schema))
    builders = {"model.p.n3": fail, "snapshot.p.n2": lambda: ran.append("n2"), "model.p.n6": lambda: ran.append("n6")}
    with pytest.raises(RefreshError) as caught:
        refresh(more, "source.p.s.n1", builders)
    assert caught.value.status == {
        "source.p.s.n1": "done", "model.p.n3": "failed", "snapshot.p.n2": "blocked", "model.p.n6": "done",
    }
    assert ran == ["n6"]


def test_levels_of_a_random_graph(spark):
    """Longest paths, with repeated edges, diamonds, a cycle and nodes behind it."""
    import random

    chance = random.Random(3)
    pairs = [(f"n{chance.randrange(i):03d}", f"n{i:03d}") for i in range(1, 120) for _ in range(chance.randint(1, 4))]
    pairs += [("n050", "c1"), ("c1", "c2"), ("c2", "c1"), ("c2", "d1"), ("n010", "d1"), ("d1", "d2"), ("x", "y")]
    links = spark.createDataFrame(pairs + pairs[:30], "parent string, child string")
    parents = {}
    for a, b in pairs:
        parents.setdefault(b, set()).add(a)
    want = {"n000": 0}
    for i in range(1, 120):
        want[f"n{i:03d}"] = 1 + max(want[p] for p in parents[f"n{i:03d}"])
    want |= dict.fromkeys(["c1", "c2", "d1", "d2"])
    got = lineage.levels(links, starts(spark, "n000", "n000")).collect()
    assert {r.node: r.level for r in got} == want and len(got) == len(want)


def test_rounds_shuffle_the_frontier_alone(spark):
    """Edges are bucketed by parent, but for a hot parent's; repeated ones come once."""
    pairs = [(f"p{i % 700}", f"c{i}") for i in range(1400)] + [("hot", f"c{i}") for i in range(700)]
    links = spark.createDataFrame(pairs + pairs[:50], "parent string, child string")
    frontier = starts(spark, "hot", "p1", "p2", "z")
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with lineage._stored(links) as stored:
            assert stored.hot_parents == ["hot"]
            cold = stored.spread.join(frontier.withColumnRenamed("node", "parent"), "parent")
            plan = cold._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 1
            got = rows(stored.leaving(frontier))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
    assert got == sorted(p for p in pairs if p[0] in ("hot", "p1", "p2"))


def test_impact_found_out_late(spark):
    """A node that is seen before something above it is known to have failed is blocked all the same."""
    links = spark.createDataFrame(
        [("a", "x"), ("x", "y"), ("a", "b"), ("b", "c"), ("c", "x"), ("y", "b")], "parent string, child string"
    )
    status = {r.node: r.status for r in lineage.impact(links, starts(spark, "a"), starts(spark, "c")).collect()}
    assert status == {"a": "done", "b": "blocked", "c": "blocked", "x": "blocked", "y": "blocked"}
