"""The registered queries: every operator over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rootwise.functions.arith import evaluate_expressions
from rootwise.model import FormulaGraph
from rootwise.operators.build import (
    add_root,
    collect_edges,
    formula_graph,
    reference_edges,
    root_edges,
)
from rootwise.operators.cycles import (
    affected_by_any,
    cycle_affected,
    cycle_groups,
    self_loops,
    with_vertices,
)
from rootwise.operators.depth import depth_from_root
from rootwise.operators.evaluate import evaluate_formulas, formula_args, with_args_map
from rootwise.operators.hierarchy import hierarchy_columns, with_hierarchy
from rootwise.operators.paths import (
    distance_maps,
    hop_distances,
    reachable_subgraph,
    shortest_distances,
    with_distances,
)
from rootwise.operators.propagate import propagate
from rootwise.plans import graphs
from rootwise.sources.generators import log_normal_edges


def formula_vertices(spark: SparkSession, folder: str) -> DataFrame:
    return add_root(graphs.sum_formulas(spark, folder))


def formula_edges(spark, folder):
    return reference_edges(formula_vertices(spark, folder))


def formula_root_edges(spark, folder):
    return root_edges(formula_vertices(spark, folder))


def named_views(spark, folder):
    """The graph as views, joined and ordered in SQL."""
    vertices = formula_vertices(spark, folder)
    vertices.createOrReplaceTempView("formulas_vertices")
    collect_edges(vertices).createOrReplaceTempView("formulas_edges")
    return spark.sql("""
        SELECT v.id, count(e.src) AS parents
        FROM formulas_vertices v LEFT JOIN formulas_edges e ON e.dst = v.id
        GROUP BY v.id ORDER BY parents DESC, v.id""")


def graph_problems(spark, folder):
    """Order lines as vertices repeat an order; orders without lines dangle."""
    lines = graphs.table(spark, folder, "lineitem").select(graphs.tag("O", "l_orderkey").alias("id"))
    orders = graphs.table(spark, folder, "orders").select(
        graphs.tag("C", "o_custkey").alias("src"), graphs.tag("O", "o_orderkey").alias("dst")
    )
    return FormulaGraph(lines, orders).problems()


def induced_subgraph_vertices(spark, folder):
    return graphs.account_graph(spark, folder).filter_vertices("value >= 0").vertices


def induced_subgraph_edges(spark, folder):
    return graphs.account_graph(spark, folder).filter_vertices("value >= 0").edges


def drop_isolated(spark, folder):
    kept = graphs.account_graph(spark, folder).filter_vertices("value >= 0")
    return kept.drop_isolated().vertices


def region_hops(spark, folder):
    graph = graphs.place_graph(spark, folder)
    regions = graphs.table(spark, folder, "region").select(
        graphs.tag("R", "r_regionkey").alias("id")
    )
    return hop_distances(graph, regions)


def reachable_subgraph_vertices(spark, folder):
    return reachable_subgraph(graphs.order_graph(spark, folder), "N3").vertices


def reachable_subgraph_edges(spark, folder):
    return reachable_subgraph(graphs.order_graph(spark, folder), "N3").edges


def reachable_ring(spark, folder):
    return reachable_subgraph(graphs.ring_graph(spark, folder), "P1").vertices


def shortest_paths(spark, folder):
    parts = graphs.table(spark, folder, "part").select(graphs.tag("P", "p_partkey").alias("id"))
    found = shortest_distances(graphs.sum_edges(spark, folder), "P1")
    return with_distances(parts, found).select("id", F.round("distance", 2).alias("distance"))


def self_loop_parts(spark, folder):
    return self_loops(graphs.block_graph(spark, folder))


def cycle_members(spark, folder):
    return cycle_groups(graphs.block_graph(spark, folder)).members


def cycle_edges(spark, folder):
    return cycle_groups(graphs.block_graph(spark, folder)).edges


def _affected(spark, folder):
    graph = graphs.block_graph(spark, folder)
    return cycle_affected(graph, cycle_groups(graph))


def cycle_affected_vertices(spark, folder):
    return _affected(spark, folder).members


def cycle_affected_edges(spark, folder):
    return _affected(spark, folder).edges


def cycle_vertices(spark, folder):
    """The vertices of every cycle group, with their columns."""
    graph = graphs.block_graph(spark, folder)
    return with_vertices(graph, cycle_groups(graph).members)


def cycle_affected_any(spark, folder):
    """All vertices that some cycle affects."""
    graph = graphs.block_graph(spark, folder)
    return affected_by_any(graph, cycle_groups(graph)).vertices


def formula_depth(spark, folder):
    return depth_from_root(formula_graph(graphs.sum_formulas(spark, folder)))


def formula_depth_faulty(spark, folder):
    return depth_from_root(formula_graph(graphs.faulty_formulas(spark, folder)))


def formula_values(spark, folder):
    return evaluate_formulas(formula_graph(graphs.sum_formulas(spark, folder)))


def formula_values_mixed(spark, folder):
    return evaluate_formulas(formula_graph(graphs.mixed_formulas(spark, folder)))


def formula_values_lines(spark, folder):
    return evaluate_formulas(formula_graph(graphs.line_formulas(spark, folder)))


def formula_status(spark, folder):
    values = evaluate_formulas(formula_graph(graphs.faulty_formulas(spark, folder)))
    return values.select("id", "depth", "value", "status")


def formula_arguments(spark, folder):
    graph = formula_graph(graphs.sum_formulas(spark, folder))
    return formula_args(graph, evaluate_formulas(graph))


def formula_args_text(spark, folder):
    """The arguments of every formula as one JSON text, sorted by id."""
    graph = formula_graph(graphs.sum_formulas(spark, folder))
    evaluated = evaluate_formulas(graph)
    mapped = with_args_map(evaluated, formula_args(graph, evaluated))
    return mapped.select("id", _sorted_json("args").alias("args"))


def region_hops_text(spark, folder):
    """Hop distances as one JSON text per vertex, sorted by landmark."""
    return distance_maps(region_hops(spark, folder)).select("id", _sorted_json("distances").alias("distances"))


def _sorted_json(column):
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(column))))


def formula_values_extreme(spark, folder):
    return evaluate_formulas(formula_graph(graphs.extreme_formulas(spark, folder)))


def expression_values(spark, folder):
    """A price expression per order line, in two spellings."""
    line = graphs.table(spark, folder, "lineitem")

    def text(name):
        return F.col(name).cast("string")

    right = F.concat(
        text("l_quantity"), F.lit(" * "), text("l_extendedprice"), F.lit(" / 7 - "),
        text("l_tax"), F.lit(" - "), text("l_discount"),
    )
    nested = F.concat(
        F.lit("("), text("l_extendedprice"), F.lit(" - -"), text("l_tax"), F.lit(")/("),
        text("l_quantity"), F.lit("+.5)"),
    )
    spelled = F.when(F.col("l_returnflag") == "A", nested).otherwise(right)
    texts = line.select("l_orderkey", "l_linenumber", "l_partkey", spelled.alias("text"))
    return evaluate_expressions(texts, "text").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("value").cast("double").alias("value"), "parse_ok"
    )


def sales_hierarchy(spark, folder):
    return hierarchy_columns(*graphs.sales_hierarchy(spark, folder))


def supply_hierarchy(spark, folder):
    """Parts with several suppliers, under the smallest."""
    return hierarchy_columns(*graphs.supply_tree(spark, folder), multi_parent="min")


def orphaned_hierarchy(spark, folder):
    """Orders whose customer is unknown, on top by themselves."""
    return hierarchy_columns(*graphs.orphaned_orders(spark, folder), orphan="root")


def part_hierarchy(spark, folder):
    tree = graphs.part_tree(spark, folder)
    return with_hierarchy(tree, "part_id", "parent_id", F.col("p_name"), F.col("part_id"))


def cyclic_hierarchy(spark, folder):
    rings = graphs.part_rings(spark, folder)
    return with_hierarchy(rings, "part_id", "parent_id", F.col("part_id"), F.col("part_id"))


def propagated_depth(spark, folder):
    """Depth from the root as a vertex program."""
    graph = formula_graph(graphs.sum_formulas(spark, folder))
    return propagate(
        graph.vertices,
        graph.edges,
        state={"depth": F.when(F.col("id") == graph.root_id, 0)},
        message={"depth": F.col("src.depth") + 1},
        send_if=F.col("src.depth").isNotNull(),
        merge={"depth": F.max},
        update={"depth": F.greatest("old.depth", "msg.depth")},
    )


def propagated_distance(spark, folder):
    """Weighted distance from one part as a vertex program."""
    parts = graphs.table(spark, folder, "part").select(graphs.tag("P", "p_partkey").alias("id"))
    far = F.col("src.distance") + F.col("edge.weight")
    closer = F.col("dst.distance").isNull() | (far < F.col("dst.distance"))
    found = propagate(
        parts,
        graphs.sum_edges(spark, folder),
        state={"distance": F.when(F.col("id") == "P1", 0.0)},
        message={"distance": far},
        send_if=far.isNotNull() & closer,
        merge={"distance": F.min},
        update={"distance": F.least("old.distance", "msg.distance")},
        reads_target=True,
        active="any",
    )
    return found.select("id", F.round("distance", 2).alias("distance"))


def _log_normal(spark, folder):
    parts = graphs.table(spark, folder, "part").select(F.col("p_partkey").alias("id"))
    return parts, log_normal_edges(parts, parts.count(), seed=7)


def log_normal_graph(spark, folder):
    return _log_normal(spark, folder)[1]


def log_normal_distances(spark, folder):
    parts, edges = _log_normal(spark, folder)
    return with_distances(parts, shortest_distances(edges, 42))


QUERIES = {
    query.__name__: query
    for query in (
        formula_vertices,
        formula_edges,
        formula_root_edges,
        named_views,
        graph_problems,
        induced_subgraph_vertices,
        induced_subgraph_edges,
        drop_isolated,
        region_hops,
        reachable_subgraph_vertices,
        reachable_subgraph_edges,
        reachable_ring,
        shortest_paths,
        self_loop_parts,
        cycle_members,
        cycle_edges,
        cycle_affected_vertices,
        cycle_affected_edges,
        cycle_vertices,
        cycle_affected_any,
        formula_depth,
        formula_depth_faulty,
        formula_values,
        formula_values_mixed,
        formula_values_lines,
        formula_status,
        formula_arguments,
        formula_args_text,
        region_hops_text,
        formula_values_extreme,
        expression_values,
        sales_hierarchy,
        supply_hierarchy,
        orphaned_hierarchy,
        part_hierarchy,
        cyclic_hierarchy,
        propagated_depth,
        propagated_distance,
        log_normal_graph,
        log_normal_distances,
    )
}
