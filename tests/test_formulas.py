"""Edge cases of formula tables."""

import pytest
from pyspark.errors import PythonException

from rootwise import FormulaGraph, GraphError
from rootwise.operators import blocks
from rootwise.operators import evaluate as evaluate_module
from rootwise.operators.build import add_root, formula_graph, reference_edges
from rootwise.operators.evaluate import evaluate_formulas, formula_args, with_args_map

TABLE = [
    ("a", "7"),
    ("half", "item(a) / 2"),  # 3.5
    ("cut", "item(half) + 0"),  # 3, cut toward zero
    ("minus", "0 - item(half)"),
    ("cutneg", "item(minus) * 1"),  # 0 - 3 = -3
    ("big", "9e9"),
    ("sat", "item(big) - 0"),  # 2147483647
    ("satneg", "item(negbig) + 0"),
    ("negbig", "-9e9"),
    ("twice", "item(a) + item(a)"),
    ("glued", "1item(a)"),  # reads 17
    ("inf", "1 / 0"),
    ("afterinf", "item(inf) + 1"),
    ("neginf", "-1 / 0"),
    ("afterneginf", "item(neginf) + 0"),
    ("nan", "0 / 0"),
    ("afternan", "item(nan) + 5"),
    ("self", "item(self) + 1"),
    ("reachself", "item(reachself) + item(a)"),
    ("belowself", "item(reachself) + item(a)"),
    ("x", "item(y)"),
    ("y", "item(x)"),
    ("belowxy", "item(x) + item(a)"),
    ("dangling", "item(nobody)"),
    ("partdangling", "item(nobody) + item(a)"),
    ("belowdangling", "item(partdangling) + 1"),
    ("empty", ""),
    ("null", None),
    ("bad", "item(a) +"),
    ("belowbad", "item(bad) + 1"),
    ("words", "items + 1"),
    ("spaced", "item( a )"),
    ("open", "item(a + 1"),
    ("nested", "item(item(a))"),
    ("ofroot", "item(r00t) + 4"),
    ("a_b", "1"),
    ("axb", "2"),
    ("a%", "3"),
    ("it's", "4"),
    ("a.b", "5"),
    ("odd", "item(a_b) + item(a%) + item(it's) + item(a.b)"),
    ("aa", "100"),
    ("prefix", "item(a) + item(aa)"),
]

# id: (depth, value, status)
EXPECTED = {
    "r00t": (0, 0.0, "ok"),
    "a": (1, 7.0, "ok"),
    "half": (2, 3.5, "ok"),
    "cut": (3, 3.0, "ok"),
    "minus": (3, -3.0, "ok"),
    "cutneg": (4, -3.0, "ok"),
    "sat": (2, 2147483648.0, "ok"),
    "satneg": (2, -2147483648.0, "ok"),
    "twice": (2, 14.0, "ok"),
    "glued": (2, 17.0, "ok"),
    "inf": (1, float("inf"), "ok"),
    "afterinf": (2, None, "blocked"),
    "afterneginf": (2, -2147483648.0, "ok"),
    "afternan": (2, 5.0, "ok"),
    "self": (None, None, "unreachable"),
    "reachself": (None, None, "cyclic"),
    "belowself": (None, None, "blocked"),
    "x": (None, None, "unreachable"),
    "y": (None, None, "unreachable"),
    "belowxy": (2, None, "blocked"),
    "dangling": (None, None, "unreachable"),
    "partdangling": (2, None, "blocked"),
    "belowdangling": (3, None, "blocked"),
    "empty": (1, None, "parse_error"),
    "null": (None, None, "no_formula"),
    "bad": (2, None, "parse_error"),
    "belowbad": (3, None, "blocked"),
    "words": (1, None, "blocked"),
    "spaced": (None, None, "unreachable"),
    "open": (1, None, "blocked"),
    "nested": (2, None, "blocked"),
    "ofroot": (1, 4.0, "ok"),
    "odd": (2, 13.0, "ok"),
    "prefix": (2, 107.0, "ok"),
}


@pytest.fixture(scope="module")
def graph(spark):
    rows = [(i, i, text, 0) for i, text in TABLE]
    return formula_graph(spark.createDataFrame(rows, "id string, name string, formula string, value int"))


@pytest.fixture(scope="module", params=[(1, 1), (24, 150), (24, 8 << 20)])
def evaluated(graph, request):
    """Evaluated in blocks of one formula, of a few and of all; tables merged at once, then left apart."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(evaluate_module, "MERGE_EVERY", request.param[0])
        patch.setattr(blocks, "BLOCK_BYTES", request.param[1])
        return evaluate_formulas(graph)


def test_windows_of_depths(spark):
    """Small depths share a window while they fit, a large one has its own with several blocks."""
    sizes = spark.createDataFrame([(2, 40), (3, 40), (4, 40), (6, 250), (7, 90), (8, 20), (9, 101)], "depth int, bytes long")
    got = {r.depth: (r.window, r.parts) for r in blocks.depth_windows(sizes, 100).collect()}
    assert got == {2: (1, 1), 3: (1, 1), 4: (1, 1), 6: (2, 3), 7: (3, 1), 8: (4, 1), 9: (5, 2)}
    assert blocks.depth_windows(sizes.limit(0), 100).count() == 0


def test_values_and_status(evaluated):
    got = {r.id: (r.depth, r.value, r.status) for r in evaluated.collect()}
    assert len(got) == len(TABLE) + 1
    assert {i: got[i] for i in EXPECTED} == EXPECTED


def test_texts_are_filled_as_far_as_possible(evaluated):
    text = {r.id: r.formula for r in evaluated.collect()}
    assert text["odd"] == "1 + 3 + 4 + 5"
    assert text["partdangling"] == "item(nobody) + 7"
    assert text["belowself"] == "item(reachself) + 7"
    assert text["belowxy"] == "item(x) + 7"
    assert text["nested"] == "item(7)"
    assert text["open"] == "item(a + 1"
    assert text["self"] == "item(self) + 1"
    assert text["afternan"] == "0 + 5"
    assert text["null"] is None


def test_args(graph, evaluated):
    mapped = with_args_map(evaluated, formula_args(graph, evaluated))
    args = {r.id: r.args for r in mapped.collect()}
    assert args["twice"] == {"a": 7.0}
    assert args["a"] == {"r00t": 0.0}
    assert args["afterinf"] == {}
    assert args["belowxy"] == {"a": 7.0}
    assert args["odd"] == {"a_b": 1.0, "a%": 3.0, "it's": 4.0, "a.b": 5.0}


def test_edges_match_ids_exactly(graph):
    edges = {(r.src, r.dst) for r in graph.edges.collect()}
    assert ("a_b", "odd") in edges and ("axb", "odd") not in edges
    assert ("self", "self") in edges
    assert not any(s == "nobody" for s, _ in edges)
    assert ("a", "nested") in edges
    assert [e for e in edges if e[1] == "twice"] == [("a", "twice")]


def test_parse_errors_can_fail_the_job(spark):
    rows = [("a", "a", "1 +", 0)]
    graph = formula_graph(spark.createDataFrame(rows, "id string, name string, formula string, value int"))
    with pytest.raises(PythonException, match="1 \\+"):
        evaluate_formulas(graph, on_error="fail").collect()


def test_only_given_edges_carry_values(spark):
    rows = [("r00t", ""), ("a", "1"), ("b", "2"), ("c", "item(a) + item(b)"), ("d", "5")]
    vertices = spark.createDataFrame(rows, "id string, formula string")
    edges = spark.createDataFrame(
        [("r00t", "a"), ("r00t", "b"), ("a", "c"), ("c", "d")], "src string, dst string"
    )
    graph = FormulaGraph(vertices, edges).validate()
    result = evaluate_formulas(graph)
    got = {r.id: (r.formula, r.depth, r.value, r.status) for r in result.collect()}
    assert got["c"] == ("1 + item(b)", 2, None, "blocked")
    assert got["d"] == ("5", 3, 5.0, "ok")


def test_root_must_be_free(spark):
    rows = [("r00t", "x", "1", 0)]
    with pytest.raises(Exception, match="already in use"):
        add_root(spark.createDataFrame(rows, "id string, name string, formula string, value int")).collect()


def test_extra_columns_stay(spark):
    rows = [("a", "1", 5.5)]
    vertices = add_root(spark.createDataFrame(rows, "id string, formula string, price double"), "top")
    got = {r.id: (r.formula, r.price) for r in vertices.collect()}
    assert got == {"a": ("1", 5.5), "top": ("", None)}
    assert reference_edges(vertices).count() == 0


def test_validation(spark):
    vertices = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    edges = spark.createDataFrame([("a", "b"), ("b", "zzz")], "src string, dst string")
    graph = FormulaGraph(vertices, edges)
    got = sorted((r.problem, r.id, r.n) for r in graph.problems().collect())
    assert got == [("dangling_end", "zzz", 1), ("duplicate_id", "a", 2)]
    with pytest.raises(GraphError, match="zzz"):
        graph.validate()
