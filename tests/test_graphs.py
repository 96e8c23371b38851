"""Random graphs against small models."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rootwise import FormulaGraph, GraphError
from rootwise.operators import blocks as blocks_module
from rootwise.operators import cycles as cycles_module
from rootwise.operators import depth as depth_module
from rootwise.operators import evaluate as evaluate_module
from rootwise.operators import peel as peel_module
from rootwise.operators import propagate as propagate_module
from rootwise.operators import spread as spread_module
from rootwise.operators.build import formula_graph
from rootwise.operators.cycles import cycle_affected, cycle_groups
from rootwise.operators.depth import depth_from_root
from rootwise.operators.evaluate import evaluate_formulas
from rootwise.operators.hierarchy import hierarchy_columns, with_hierarchy
from rootwise.operators.paths import hop_distances, reachable_subgraph, shortest_distances
from rootwise.operators.propagate import propagate
from rootwise.scratch import Scratch
from rootwise.sources.generators import log_normal_edges, log_normal_graph
from tests import models


@pytest.fixture(params=[1, 24])
def size(request, monkeypatch):
    """Run a test with round tables merged at once, then as few as there are left apart."""
    for module in (evaluate_module, peel_module, propagate_module, spread_module):
        monkeypatch.setattr(module, "MERGE_EVERY", request.param)
    if request.param == 1:
        monkeypatch.setattr(blocks_module, "BLOCK_BYTES", 1)
    return request.param


def many_digraphs(seed, count=30):
    """Disjoint random digraphs in one, partly hung under a root."""
    draw = random.Random(seed)
    ids, edges = ["r00t"], set()
    for g in range(count):
        mine = [f"g{g}v{n}" for n in range(draw.randint(1, 7))]
        ids += mine
        for _ in range(draw.randint(0, 2 * len(mine))):
            edges.add((draw.choice(mine), draw.choice(mine)))
        for v in mine:
            if draw.random() < 0.25:
                edges.add(("r00t", v))
    return ids, sorted(edges)


def graph_of(spark, ids, edges):
    vertices = spark.createDataFrame([(i,) for i in ids], "id string")
    return FormulaGraph(vertices, spark.createDataFrame(edges, "src string, dst string"))


def test_depths(spark, size):
    ids, edges = many_digraphs(1)
    got = {r.id: (r.depth, r.state) for r in depth_from_root(graph_of(spark, ids, edges)).collect()}
    assert got == models.depths(ids, edges, "r00t")


@pytest.mark.parametrize("worth", [1, 10**9])
def test_depths_with_chains(spark, monkeypatch, worth):
    """Chains under the root, between two ways, into and out of a cycle, on one, and in a ring by themselves."""
    monkeypatch.setattr(depth_module, "WORTH", worth)

    def chain(name, n, head, tail=None):
        way = [head, *(f"{name}{k}" for k in range(n)), *([tail] if tail else [])]
        return list(zip(way, way[1:]))

    edges = [
        *chain("a", 9, "r00t", "top"), *chain("b", 3, "top", "meet"), *chain("c", 5, "top", "meet"),
        *chain("d", 4, "meet", "loop"), *chain("e", 3, "loop", "loop"), *chain("f", 4, "loop", "below"),
        *chain("g", 2, "meet", "late"), *chain("h", 2, "below", "late"), ("late", "end"),
        *chain("i", 4, "i3", None)[1:], ("i3", "i0"), *chain("j", 3, "lost", "top"), ("alone", "alone"),
        ("alone", "after"), ("meet", "twin"), ("top", "twin"), ("twin", "last"), ("last", "loop"),
    ]
    ids = sorted({v for e in edges for v in e})
    got = {r.id: (r.depth, r.state) for r in depth_from_root(graph_of(spark, ids, edges)).collect()}
    assert got == models.depths(ids, edges, "r00t")


def test_root_with_parents(spark):
    ids = ["r00t", "a", "b", "c"]
    edges = [("a", "r00t"), ("r00t", "b"), ("b", "c")]
    got = {r.id: (r.depth, r.state) for r in depth_from_root(graph_of(spark, ids, edges)).collect()}
    assert got == models.depths(ids, edges, "r00t")
    edges.append(("c", "r00t"))
    got = {r.id: (r.depth, r.state) for r in depth_from_root(graph_of(spark, ids, edges)).collect()}
    assert got == {"a": (None, "unreachable"), **{i: (None, "cyclic") for i in ("r00t", "b", "c")}}


def test_cycles_and_what_they_affect(spark, size):
    ids, edges = many_digraphs(2)
    graph = graph_of(spark, ids, edges)
    groups = cycle_groups(graph)
    found = {}
    for row in groups.members.collect():
        found.setdefault(row.cycle_id, set()).add(row.id)
    want = {min(g): set(g) for g in models.components(ids, edges)}
    want |= {f"{s}#self": {s} for s, d in edges if s == d}
    assert found == want
    inner = {(r.cycle_id, r.src, r.dst) for r in groups.edges.collect()}
    assert inner == {(c, s, d) for c, g in want.items() for s, d in edges if s in g and d in g}

    hit = cycle_affected(graph, groups)
    hops = models.closure(ids, edges)
    want = {c: g | {j for i in g for j in hops[i]} for c, g in want.items()}
    assert {(r.cycle_id, r.id) for r in hit.members.collect()} == {(c, i) for c, g in want.items() for i in g}
    assert {(r.cycle_id, r.src, r.dst) for r in hit.edges.collect()} == {
        (c, s, d) for c, g in want.items() for s, d in edges if s in g
    }


def test_cycles_of_chains_in_few_rounds(spark, monkeypatch):
    """Chains of thousands, a long ring, loops of chains at one vertex and at two, chains between cycles."""
    monkeypatch.setattr(cycles_module, "_coloured", lambda *_: pytest.fail("there is nothing left to colour"))

    def path(name, first, last, n):
        inner = [f"{name}{k}" for k in range(n)]
        return list(zip([first, *inner], [*inner, last], strict=True))

    edges = path("chain", "a", "z", 20_000) + path("ring", "r", "r", 3000)
    edges += path("one", "u", "u", 40) + path("two", "u", "u", 5) + path("out", "u", "v", 9) + path("lone", "v", "v", 3)
    spark.sparkContext.setJobGroup("chains", "chains")
    got = cycle_groups(graph_of(spark, ["a"], edges)).members
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("chains"))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs < 400, jobs
    found = {}
    for r in got.collect():
        found.setdefault(r.cycle_id, set()).add(r.id)
    want = [{"r"} | {f"ring{k}" for k in range(3000)}, {"v"} | {f"lone{k}" for k in range(3)}]
    want.append({"u"} | {f"one{k}" for k in range(40)} | {f"two{k}" for k in range(5)})
    assert found == {min(group): group for group in want}


def test_no_cycles(spark):
    groups = cycle_groups(graph_of(spark, ["a", "b"], [("a", "b")]))
    assert groups.members.count() == 0 and groups.edges.count() == 0


def test_hops_and_subgraph(spark, size):
    draw = random.Random(3)
    ids = [f"v{n}" for n in range(40)]
    edges = sorted({(draw.choice(ids), draw.choice(ids)) for _ in range(60)})
    graph = graph_of(spark, ids, edges)
    hops = models.closure(ids, edges)
    marks = ids[:5]
    landmarks = spark.createDataFrame([(m,) for m in [*marks, "unknown"]], "id string")
    got = {(r.id, r.landmark): r.distance for r in hop_distances(graph, landmarks).collect()}
    assert got == {(i, m): 0 if i == m else hops[i][m] for i in ids for m in marks if i == m or m in hops[i]}

    below = reachable_subgraph(graph, "v0")
    reached = {"v0", *hops["v0"]}
    inner = {e for e in edges if e[0] in reached}
    assert {tuple(r) for r in below.edges.collect()} == inner
    assert {r.id for r in below.vertices.collect()} == {v for e in inner for v in e}


def test_shortest_distances(spark, size):
    draw = random.Random(4)
    edges = [(draw.randrange(60), draw.randrange(60), draw.choice([0.0, 0.5, 1.0, 7.0])) for _ in range(150)]
    df = spark.createDataFrame(edges, "src long, dst long, weight double")
    got = {r.id: r.distance for r in shortest_distances(df, 42).collect()}
    assert got == models.distances(edges, 42)


def test_wide_searches(spark, monkeypatch):
    """A round of many rows goes one edge far, and edges are shuffled once: neither merged nor sorted for joins."""
    draw = random.Random(5)
    edges = [(draw.randrange(80), draw.randrange(80), draw.choice([0.0, 0.5, 3.0])) for _ in range(400)] * 2
    df = spark.createDataFrame(edges, "src long, dst long, weight double")
    went, written = [], []
    hops, bucketed = spread_module._hops, Scratch.write_bucketed
    monkeypatch.setattr(spread_module, "FEW", 10)
    monkeypatch.setattr(spread_module, "_hops", lambda *args: (went.append(args[-1]), hops(*args))[1])
    monkeypatch.setattr(Scratch, "write_bucketed", lambda self, rows, *args, **kw: (written.append(rows), bucketed(self, rows, *args, **kw))[1])
    got = {r.id: r.distance for r in shortest_distances(df, 42).collect()}
    assert got == models.distances(edges, 42)
    assert went[0] == spread_module.HOPS and went[1] == 1
    assert "Exchange" not in written[0]._jdf.queryExecution().executedPlan().toString()


def test_bad_weights(spark):
    for weight in (-1.0, None, math.nan):
        df = spark.createDataFrame([(1, 2, weight)], "src long, dst long, weight double")
        with pytest.raises(GraphError):
            shortest_distances(df, 1)


def many_trees(seed, count=40):
    draw = random.Random(seed)
    parents = {}
    for g in range(count):
        mine = [f"g{g}v{n}" for n in range(draw.randint(1, 7))]
        for v in mine:
            parents[v] = draw.choice([None, *mine])
    return parents


def test_hierarchies(spark):
    parents = many_trees(6)
    vertices = spark.createDataFrame([(i, f"root {i}", f"p{i}") for i in parents], "id string, root string, path string")
    links = spark.createDataFrame([(p, c) for c, p in parents.items()], "parent string, child string")
    got = {r.id: tuple(r)[1:] for r in hierarchy_columns(vertices, links).collect()}
    want = {}
    for i, (level, path, cyclic, leaf) in models.hierarchy(parents).items():
        text = "".join(f"/p{v}" for v in path)
        want[i] = (level, f"root {path[0]}", text, cyclic, leaf)
    assert got == want


def test_a_deep_chain_in_few_rounds(spark):
    """A chain of 4,000, a ring with a chain of 300 below it, and a wide level."""
    rings = {5000 + n: 5000 + (n + 1) % 7 for n in range(7)} | {6000 + n: 5999 + n if n else 5003 for n in range(300)}
    parents = {n: n - 1 if n else None for n in range(4000)} | {7000 + n: 3999 for n in range(50)} | rings
    vertices = spark.createDataFrame([(i, str(i), str(i)) for i in parents], "id long, root string, path string")
    links = spark.createDataFrame([(p, c) for c, p in parents.items()], "parent long, child long")
    spark.sparkContext.setJobGroup("deep", "deep")
    found = hierarchy_columns(vertices, links)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("deep"))
    spark.sparkContext.setJobGroup("other", "other")
    assert jobs < 200, jobs
    got = {r.id: tuple(r)[1:] for r in found.collect()}
    chain = "".join(f"/{n}" for n in range(4000))
    want = {n: (n + 1, "0", "".join(f"/{v}" for v in range(n + 1)), 0, 0) for n in range(4000)}
    want |= {7000 + n: (4001, "0", f"{chain}/{7000 + n}", 0, 1) for n in range(50)}
    for i, (level, path, cyclic, leaf) in models.hierarchy(rings).items():
        want[i] = (level, str(path[0]), "".join(f"/{v}" for v in path), cyclic, leaf)
    assert got == want


def test_own_columns_with_the_names_of_the_hierarchy(spark):
    rows = [("a", None, "x", 7, "own"), ("b", "a", "y", 8, "own")]
    df = spark.createDataFrame(rows, "pk string, up string, root string, level int, path string")
    got = with_hierarchy(df, "pk", "up", F.col("pk"), F.col("pk"))
    assert got.columns == ["pk", "up", "level", "root", "path", "iscyclic", "isleaf"]
    assert sorted(map(tuple, got.collect())) == [("a", None, 1, "a", "/a", 0, 0), ("b", "a", 2, "a", "/a/b", 0, 1)]


def test_hierarchy_checks(spark):
    vertices = spark.createDataFrame([(i, i, i) for i in "abc"], "id string, root string, path string")

    def run(edges, **options):
        links = spark.createDataFrame(edges, "parent string, child string")
        return {r.id: (r.level, r.path) for r in hierarchy_columns(vertices, links, **options).collect()}

    two = [("a", "c"), ("b", "c")]
    with pytest.raises(GraphError, match="more than one parent"):
        run(two)
    assert run(two, multi_parent="min")["c"] == (2, "/a/c")
    lost = [("a", "b"), ("zzz", "c")]
    with pytest.raises(GraphError, match="parents are no vertices"):
        run(lost)
    assert run(lost, orphan="root") == {"a": (1, "/a"), "b": (2, "/a/b"), "c": (1, "/c")}
    with pytest.raises(GraphError, match="children are no vertices"):
        run([("a", "zzz")])
    with pytest.raises(ValueError):
        run(two, multi_parent="any")
    assert run([("a", "b"), ("a", "b")])["b"] == (2, "/a/b")


def test_vertex_programs(spark):
    ids = list(range(6))
    edges = [(0, 1, 2.0), (1, 2, 2.0), (0, 2, 5.0), (2, 3, 1.0), (4, 5, 1.0)]
    vertices = spark.createDataFrame([(i,) for i in ids], "id long")
    links = spark.createDataFrame(edges, "src long, dst long, weight double")
    far = F.col("src.far") + F.col("edge.weight")
    closer = F.col("dst.far").isNull() | (far < F.col("dst.far"))
    program = dict(
        state={"far": F.when(F.col("id") == 0, 0.0), "seen": F.lit(0)},
        message={"far": far},
        merge={"far": F.min},
        update={"far": F.least("old.far", "msg.far"), "seen": F.col("old.seen") + 1},
        send_if=far.isNotNull() & closer,
        reads_target=True,
    )
    for active in ("out", "any"):
        got = {r.id: r.far for r in propagate(vertices, links, active=active, **program).collect()}
        assert got == {0: 0.0, 1: 2.0, 2: 4.0, 3: 5.0, 4: None, 5: None}
    with pytest.raises(GraphError):
        propagate(vertices, links, max_rounds=1, **program)

    back = propagate(
        vertices,
        links,
        state={"below": F.lit(0)},
        message={"one": F.lit(1)},
        merge={"one": F.sum},
        update={"below": F.col("old.below") + F.col("msg.one")},
        send_if=F.col("src.below") == 0,
        send_to="src",
    )
    assert {r.id: r.below for r in back.collect()} == {0: 2, 1: 1, 2: 1, 3: 0, 4: 1, 5: 0}


def test_random_formulas(spark, size):
    draw = random.Random(8)
    rows, want = [], {}
    for n in range(60):
        refs = [f"f{draw.randrange(n)}" for _ in range(draw.randint(0, 3))] if n else []
        parts = [f"item({r})" for r in refs] + [draw.choice(["2", "0.5", "-3", "10"])]
        draw.shuffle(parts)
        text = parts[0]
        for part in parts[1:]:
            text += f" {draw.choice('+-*/')} {part}"
        rows.append((f"f{n}", "", text, 0))
        filled = text
        for r in refs:
            if want[r] is not None and want[r] != math.inf:
                v = want[r]
                cut = 0 if math.isnan(v) else int(max(-(2**31), min(2**31 - 1, v)))
                filled = filled.replace(f"item({r})", str(cut))
        want[f"f{n}"] = None if "item" in filled else models.arithmetic(filled)
    graph = formula_graph(spark.createDataFrame(rows, "id string, name string, formula string, value int"))
    got = {r.id: r.value for r in evaluate_formulas(graph).collect() if r.id != "r00t"}
    assert {i: str(v) for i, v in got.items()} == {i: str(v) for i, v in want.items()}


def test_log_normal_graph(spark):
    vertices, edges = log_normal_graph(spark, 300, seed=1)
    rows = sorted(tuple(r) for r in edges.collect())
    again = sorted(tuple(r) for r in log_normal_edges(vertices.repartition(5), 300, seed=1).collect())
    assert rows == again
    assert rows != sorted(tuple(r) for r in log_normal_graph(spark, 300, seed=2)[1].collect())
    assert {w for _, _, w in rows} == {1.0}
    assert all(0 <= s < 300 and 0 <= d < 300 for s, d, _ in rows)
    logs = [math.log(d) for d in (sum(1 for s, _, _ in rows if s == v) for v in range(300)) if d]
    assert max(logs) < math.log(300) and 3.3 < sum(logs) / len(logs) < 4.1
    split = log_normal_edges(vertices, 300, seed=1, block=7)
    assert sorted(tuple(r) for r in split.collect()) == rows
    blocks = split.groupBy("src", F.spark_partition_id().alias("task")).count().groupBy("src").count()
    assert blocks.agg(F.max("count")).first()[0] > 1  # the edges of a busy vertex lie in several tasks
    assert log_normal_graph(spark, 1)[1].count() == 0
    assert {r.src for r in log_normal_graph(spark, 2)[1].collect()} <= {0, 1}


def test_log_normal_plan(spark):
    """The formula of the degrees is not in the plan of the edges: planning it took half a minute."""
    edges = log_normal_graph(spark, 300, seed=1)[1]
    assert len(edges._jdf.queryExecution().optimizedPlan().toString()) < 5_000
