"""Searches that go by ranges of ids, against plain Python."""

import random

import pytest

from rootwise.model import FormulaGraph
from rootwise.operators import cycles, paths, ranges
from rootwise.operators.cycles import strong_components
from rootwise.operators.paths import reachable_subgraph
from rootwise.plans import graphs
from rootwise.scratch import Scratch


def below(edges, root):
    onward, seen, front = {}, {root}, [root]
    for a, b in edges:
        onward.setdefault(a, []).append(b)
    while front:
        front = [b for a in front for b in onward.get(a, []) if not (b in seen or seen.add(b))]
    return seen


def check(spark, names, edges, root, kind="string"):
    vertices = spark.createDataFrame([(v,) for v in names], f"id {kind}")
    links = spark.createDataFrame(edges, f"src {kind}, dst {kind}")
    found = reachable_subgraph(FormulaGraph(vertices, links), root)
    want = below(edges, root)
    assert sorted(r["id"] for r in found.vertices.collect()) == sorted(want)
    assert sorted(map(tuple, found.edges.collect())) == sorted(e for e in edges if e[0] in want)


def test_a_long_way_takes_few_rounds(spark, monkeypatch):
    written = []
    write = Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, *args, **kwargs: written.append(1) or write(self, *args, **kwargs))
    names = [f"v{i:04}" for i in range(700)]
    check(spark, names, list(zip(names[:600], names[1:600], strict=False)), "v0000")
    assert len(written) < 40


@pytest.mark.parametrize("kind", ["string", "long"])
def test_many_ranges(spark, monkeypatch, kind):
    """Ranges of a few edges, a hub that lies in several, repeated edges, loops, vertices without an edge out."""
    monkeypatch.setattr(ranges, "RANGE_EDGES", 40)
    monkeypatch.setattr(ranges, "MERGE_EVERY", 2)
    monkeypatch.setattr(paths, "SEARCH_ROUNDS", 0)
    draw = random.Random(5)
    named = (lambda i: f"v{i}") if kind == "string" else int
    edges = [(i, i + draw.randint(1, 4)) for i in range(150) if i != 120] + [(i, draw.randrange(200)) for i in range(130, 150)]
    edges += [(60, 200 + i) for i in range(130)] + [(7, 7), (8, 9), (8, 9), (330, 3), (300, 20), (299, 340)]
    edges = [(named(a), named(b)) for a, b in edges]
    for root in (0, 60, 145, 350):
        check(spark, [named(i) for i in range(360)], edges + [(named(350), named(350))], named(root), kind)


def components(edges):
    """``(smallest id, id)`` of every component of two or more."""
    ends = {v for e in edges for v in e}
    reached = {v: below(edges, v) for v in ends}
    mine = {v: sorted(w for w in reached[v] if v in reached[w]) for v in ends}
    return sorted((mine[v][0], v) for v in ends if len(mine[v]) > 1)


def check_components(spark, edges, kind="string"):
    found = strong_components(Scratch(spark, "test"), spark.createDataFrame(edges, f"src {kind}, dst {kind}"))
    assert (sorted(map(tuple, found.df.collect())) if found else []) == components(edges)


def test_small_cycles_need_no_colours(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("coloured")

    monkeypatch.setattr(cycles, "_coloured", fail)
    edges = [(10 * b + i, 10 * b + (i + step) % 10) for b in range(60) for i in range(10) for step in (1, 3, 4)]
    edges += [(10 * b + i, b // 2 * 10) for b in range(60) for i in range(10)]
    check_components(spark, [(f"v{a:03}", f"v{b:03}") for a, b in edges])


@pytest.mark.parametrize("kind", ["string", "long"])
@pytest.mark.parametrize("size", [3, 25, 10_000])
def test_components_over_ranges(spark, monkeypatch, kind, size):
    """Components inside ranges, over several of them, and both in one; hubs that lie in several."""
    monkeypatch.setattr(ranges, "RANGE_EDGES", size)
    draw = random.Random(size)
    named = (lambda i: f"v{i}") if kind == "string" else int
    edges = [(draw.randrange(200), draw.randrange(200)) for _ in range(210)]
    edges += [(a, a + draw.randint(-6, 6)) for a in range(300, 400) for _ in range(2)]
    edges += [(350, i) for i in range(500, 540)] + [(i, 350) for i in range(520, 530)] + [(7, 7)]
    check_components(spark, [(named(a), named(b)) for a, b in edges], kind)


def test_places_of_lines_are_found_once(spark):
    formulas = graphs.line_formulas(spark, "/root/testdata/sf0.001")
    assert "Window" not in formulas._jdf.queryExecution().optimizedPlan().toString()
