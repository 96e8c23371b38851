"""The sample tables and their known answers."""

import pytest
from pyspark.sql import functions as F

from rootwise import FormulaGraph, GraphError
from rootwise.operators.build import add_root, collect_edges, formula_graph, root_edges
from rootwise.operators.cycles import cycle_affected, cycle_groups, self_loops
from rootwise.operators.depth import depth_from_root
from rootwise.operators.evaluate import evaluate_formulas, formula_args, with_args_map
from rootwise.operators.hierarchy import with_hierarchy
from rootwise.operators.paths import distance_maps, hop_distances, reachable_subgraph
from tests import samples


@pytest.fixture(scope="module")
def cyclic(spark):
    ids = samples.CYCLIC_VERTICES
    rows = [(i, f"formula {i}", "", n) for n, i in enumerate(ids)]
    vertices = spark.createDataFrame(rows, samples.FORMULA_SCHEMA)
    return FormulaGraph(vertices, samples.edges(spark, samples.CYCLIC_EDGES)).validate()


def test_edges_from_texts(spark):
    vertices = add_root(samples.formulas(spark))
    found = collect_edges(vertices)
    assert found.columns == ["dst", "src"]
    expected = samples.FORMULA_EDGES
    assert sorted((r.src, r.dst) for r in found.collect()) == sorted(expected)
    assert {r.dst for r in root_edges(vertices).collect()} == {"b", "d"}


def test_named_views(spark):
    vertices = add_root(samples.formulas(spark))
    vertices.createOrReplaceTempView("formulas_vertices")
    collect_edges(vertices).createOrReplaceTempView("formulas_edges")
    joined = spark.sql(
        "select count(*) n from formulas_edges e join formulas_vertices v on v.id = e.src"
    )
    assert joined.first().n == 24


def test_depths(spark):
    graph = formula_graph(samples.formulas(spark))
    got = {r.id: r.depth for r in depth_from_root(graph).collect()}
    assert got == {i: int(n) for i, n in samples.FORMULA_DEPTHS}


@pytest.mark.parametrize("from_text", [True, False])
def test_values(spark, from_text):
    graph = formula_graph(samples.formulas(spark))
    if not from_text:
        edges = samples.edges(spark, samples.FORMULA_EDGES)
        graph = FormulaGraph(graph.vertices, edges).validate()
    result = evaluate_formulas(graph)
    rows = {r.id: r for r in result.collect()}
    assert {i: r.value for i, r in rows.items()} == {
        i: float(n) for i, n in samples.FORMULA_VALUES
    }
    assert {i: r.depth for i, r in rows.items()} == {
        i: int(n) for i, n in samples.FORMULA_DEPTHS
    }
    assert {r.status for r in rows.values()} == {"ok"}
    assert rows["f"].formula == "1 + 4"
    mapped = with_args_map(result, formula_args(graph, result))
    args = {r.id: r.args for r in mapped.collect()}
    assert args["f"] == {"b": 1.0, "c": 4.0}
    assert args["b"] == {"r00t": 0.0}
    assert args["r00t"] == {}


def test_subgraph(cyclic):
    below = reachable_subgraph(cyclic, "d")
    assert {r.id for r in below.vertices.collect()} == set("dijklmnopr")
    assert below.edges.count() == 13
    leaf = reachable_subgraph(cyclic, "p")
    assert leaf.vertices.count() == 0 and leaf.edges.count() == 0
    with pytest.raises(GraphError):
        reachable_subgraph(cyclic, "nobody")


def test_cycles(cyclic):
    groups = cycle_groups(cyclic)
    members = {}
    for row in groups.members.collect():
        members.setdefault(row.cycle_id, set()).add(row.id)
    assert members == {"d": set("dikr"), "m": set("mo"), "h#self": {"h"}, "g#self": {"g"}}
    count = {r.cycle_id: r["count"] for r in groups.edges.groupBy("cycle_id").count().collect()}
    assert count == {"d": 4, "m": 2, "h#self": 1, "g#self": 1}
    assert {r.id for r in self_loops(cyclic).collect()} == {"g", "h"}

    hit = cycle_affected(cyclic, groups)
    affected = {}
    for row in hit.members.collect():
        affected.setdefault(row.cycle_id, set()).add(row.id)
    assert affected == {
        "d": set("dijklmnopr"),
        "m": set("mop"),
        "h#self": {"h"},
        "g#self": {"g", "h"},
    }
    count = {r.cycle_id: r["count"] for r in hit.edges.groupBy("cycle_id").count().collect()}
    assert count == {"d": 13, "m": 3, "h#self": 1, "g#self": 3}


def test_hops_to_every_vertex(cyclic):
    maps = distance_maps(hop_distances(cyclic, cyclic.vertices))
    got = {r.id: r.distances for r in maps.collect()}
    assert got["p"] == {"p": 0}
    assert got["g"] == {"g": 0, "h": 1}
    assert got["m"] == {"m": 0, "o": 1, "p": 1}
    assert got["r00t"]["r"] == 4


def test_cyclic_graph_still_has_an_answer(cyclic):
    states = {r.id: (r.depth, r.state) for r in depth_from_root(cyclic).collect()}
    assert states["q"] == (3, "reached") and states["c"] == (4, "reached")
    assert states["d"] == (None, "cyclic") and states["g"] == (None, "cyclic")
    assert states["p"] == (None, "below_cycle") and states["l"] == (None, "below_cycle")


def test_employees(spark):
    staff = samples.employees(spark)
    out = with_hierarchy(
        staff,
        "emp_id",
        "mgr_id",
        F.concat("first_name", F.lit(" "), "last_name"),
        F.concat("last_name", F.lit(" "), "first_name"),
    ).orderBy("level", F.substring("emp_id", 2, 5).cast("int"))
    rows = {r.emp_id: r for r in out.collect()}
    assert [(r.level, i) for i, r in rows.items()] == [
        (1, "W10"), (1, "W20"), (2, "W11"), (2, "W12"), (2, "W13"), (2, "W21"), (3, "W14"), (3, "W15"), (3, "W16")
    ]
    assert {i for i, r in rows.items() if r.root == "Unni Bakke"} == {"W20", "W21"}
    assert {r.root for r in rows.values()} == {"Nils Torp", "Unni Bakke"}
    assert {i for i, r in rows.items() if not r.isleaf} == {"W10", "W12", "W13", "W20"}
    assert {r.iscyclic for r in rows.values()} == {0}
    assert rows["W15"].path == "/Torp Nils/Vik Odd/Dahl Siri"
    assert rows["W20"].path == "/Bakke Unni" and rows["W20"].mgr_id is None
