"""Graphs and formula tables made from the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rootwise.model import FormulaGraph
from rootwise.scratch import Scratch
from rootwise.sources.tables import read_table


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tag(prefix: str, key: Column | str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.concat(F.lit(prefix), key.cast("string"))


def part_ref(divisor: int) -> Column:
    return F.concat(F.lit("item("), tag("P", F.expr(f"p_partkey div {divisor}")), F.lit(")"))


def formula_table(spark: SparkSession, folder: str, formula: Column) -> DataFrame:
    columns = {
        "id": tag("P", "p_partkey"),
        "name": F.col("p_name"),
        "formula": formula,
        "value": F.lit(0),
    }
    return read_table(spark, f"{folder}/part.parquet", columns)


def sum_formulas(spark: SparkSession, folder: str) -> DataFrame:
    """Part k refers to parts k/2 and k/3 and adds its size."""
    size = F.col("p_size").cast("string")
    text = F.concat(part_ref(2), F.lit(" + "), part_ref(3), F.lit(" + "), size)
    return formula_table(spark, folder, F.when(F.col("p_partkey") >= 2, text).otherwise(size))


def mixed_formulas(spark: SparkSession, folder: str) -> DataFrame:
    """Part k refers to part k/2, with every operator and fractional values on the way."""
    size = F.col("p_size").cast("string")
    shapes = [
        F.concat(part_ref(2), F.lit(" / 2 - "), size, F.lit(" - 3")),
        F.concat(F.lit("("), part_ref(2), F.lit(" + "), size, F.lit(") * 2 / 5")),
        F.concat(size, F.lit(" - "), part_ref(2), F.lit(" - 1.5")),
        F.concat(part_ref(2), F.lit("* -1 + "), size, F.lit("/ 4")),
    ]
    kind = F.col("p_partkey") % 4
    text = F.when(F.col("p_partkey") < 1, size)
    for n, shape in enumerate(shapes):
        text = text.when(kind == n, shape)
    return formula_table(spark, folder, text)


def faulty_formulas(spark: SparkSession, folder: str) -> DataFrame:
    """Part k refers to part k/2; some sizes bring in one fault each."""
    size = F.col("p_size")
    own = F.concat(F.lit("item("), tag("P", "p_partkey"), F.lit(")"))
    up = part_ref(2)
    text = (
        F.when(F.col("p_partkey") < 1, size.cast("string"))
        .when(size == 11, "item(Q1)")
        .when(size == 13, F.concat(up, F.lit(" + item(Q2)")))
        .when(size == 17, F.concat(up, F.lit(" +")))
        .when(size == 19, F.concat(up, F.lit(" / 0")))
        .when(size == 23, F.concat(own, F.lit(" + "), up))
        .when(size == 29, own)
        .when(size == 31, None)
        .when(size == 37, F.concat(F.lit("items + "), up))
        .otherwise(F.concat(up, F.lit(" + "), size.cast("string")))
    )
    return formula_table(spark, folder, text)


def line_formulas(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as constants and one formula per order line that refers to its part."""
    parts = formula_table(spark, folder, F.col("p_size").cast("string"))
    lines = table(spark, folder, "lineitem")
    # A line's number is not unique in its order: its place among the lines with that number
    # is, as told by all its columns. Lines that repeat in all of them get places in a row.
    places = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*lines.columns)
    lines = lines.withColumn("place", F.row_number().over(places))
    key = F.concat_ws("_", tag("L", "l_orderkey"), F.col("l_linenumber").cast("string"), F.col("place").cast("string"))
    text = F.concat(
        F.lit("(item("), tag("P", "l_partkey"), F.lit(") + 0.5) * "), F.col("l_quantity").cast("string")
    )
    named = lines.select(key.alias("id"), F.lit("line").alias("name"), text.alias("formula"), F.lit(0).alias("value"))
    # A graph reads its vertices several times; the places are found once.
    return parts.unionByName(Scratch(spark, "lines").write(named).df)


def extreme_formulas(spark: SparkSession, folder: str) -> DataFrame:
    """Parts beyond the range of an argument, NaN or infinite, and a formula on top of each."""
    size = F.col("p_size").cast("string")
    kind = F.col("p_partkey") % 5
    text = (
        F.when(kind == 0, F.concat(size, F.lit(" * 900000000")))
        .when(kind == 1, F.concat(size, F.lit(" * -900000000")))
        .when(kind == 2, "0 / 0")
        .when(kind == 3, F.concat(size, F.lit(" / 0")))
        .otherwise("-1 / 0")
    )
    above = F.concat(F.lit("item("), F.col("id"), F.lit(") + 1"))
    parts = formula_table(spark, folder, text)
    return parts.unionByName(
        parts.select(F.concat(F.lit("Q"), F.substring("id", 2, 30)).alias("id"), "name", above.alias("formula"), "value")
    )


def sum_edges(spark: SparkSession, folder: str) -> DataFrame:
    """The references of :func:`sum_formulas` as weighted edges."""
    part = table(spark, folder, "part").where("p_partkey >= 2")
    ends = F.array_distinct(F.array(F.expr("p_partkey div 2"), F.expr("p_partkey div 3")))
    return part.select(
        F.explode(ends).alias("up"), "p_partkey", F.col("p_retailprice").alias("weight")
    ).select(tag("P", "up").alias("src"), tag("P", "p_partkey").alias("dst"), "weight")


def _edge(df: DataFrame, src: Column, dst: Column) -> DataFrame:
    return df.select(src.alias("src"), dst.alias("dst"))


def _vertex(df: DataFrame, key: Column, name: Column | str, value: Column) -> DataFrame:
    name = F.col(name) if isinstance(name, str) else name
    return df.select(key.alias("id"), name.alias("name"), value.cast("double").alias("value"))


def order_graph(spark: SparkSession, folder: str) -> FormulaGraph:
    """Region to nation to customer to order to part."""
    region, nation, customer, orders, part, line = (
        table(spark, folder, n)
        for n in ("region", "nation", "customer", "orders", "part", "lineitem")
    )
    vertices = (
        _vertex(region, tag("R", "r_regionkey"), "r_name", F.lit(0))
        .unionByName(_vertex(nation, tag("N", "n_nationkey"), "n_name", F.lit(0)))
        .unionByName(_vertex(customer, tag("C", "c_custkey"), "c_name", F.col("c_acctbal")))
        .unionByName(_vertex(orders, tag("O", "o_orderkey"), "o_orderstatus", F.col("o_totalprice")))
        .unionByName(_vertex(part, tag("P", "p_partkey"), "p_name", F.col("p_retailprice")))
    )
    edges = (
        _edge(nation, tag("R", "n_regionkey"), tag("N", "n_nationkey"))
        .unionByName(_edge(customer, tag("N", "c_nationkey"), tag("C", "c_custkey")))
        .unionByName(_edge(orders, tag("C", "o_custkey"), tag("O", "o_orderkey")))
        .unionByName(_edge(line, tag("O", "l_orderkey"), tag("P", "l_partkey")).distinct())
    )
    return FormulaGraph(vertices, edges, root_id="R0")


def place_graph(spark: SparkSession, folder: str) -> FormulaGraph:
    """Part to its suppliers, supplier and customer to nation, nation to region."""
    region, nation, customer, supplier, part, line = (
        table(spark, folder, n)
        for n in ("region", "nation", "customer", "supplier", "part", "lineitem")
    )
    vertices = (
        _vertex(region, tag("R", "r_regionkey"), "r_name", F.lit(0))
        .unionByName(_vertex(nation, tag("N", "n_nationkey"), "n_name", F.col("n_regionkey")))
        .unionByName(_vertex(customer, tag("C", "c_custkey"), "c_name", F.col("c_acctbal")))
        .unionByName(_vertex(supplier, tag("S", "s_suppkey"), "s_name", F.col("s_acctbal")))
        .unionByName(_vertex(part, tag("P", "p_partkey"), "p_name", F.col("p_retailprice")))
    )
    edges = (
        _edge(nation, tag("N", "n_nationkey"), tag("R", "n_regionkey"))
        .unionByName(_edge(customer, tag("C", "c_custkey"), tag("N", "c_nationkey")))
        .unionByName(_edge(supplier, tag("S", "s_suppkey"), tag("N", "s_nationkey")))
        .unionByName(_edge(line, tag("P", "l_partkey"), tag("S", "l_suppkey")).distinct())
    )
    return FormulaGraph(vertices, edges, root_id="R0")


def account_graph(spark: SparkSession, folder: str) -> FormulaGraph:
    """Nation to its customers and suppliers; the value is an account balance.

    A nation's value is its region's number minus one, so a filter on it cuts whole
    nations off and leaves their customers isolated.
    """
    nation, customer, supplier = (
        table(spark, folder, n) for n in ("nation", "customer", "supplier")
    )
    vertices = (
        _vertex(nation, tag("N", "n_nationkey"), "n_name", F.col("n_regionkey") - 1)
        .unionByName(_vertex(customer, tag("C", "c_custkey"), "c_name", F.col("c_acctbal")))
        .unionByName(_vertex(supplier, tag("S", "s_suppkey"), "s_name", F.col("s_acctbal")))
    )
    edges = _edge(customer, tag("N", "c_nationkey"), tag("C", "c_custkey")).unionByName(
        _edge(supplier, tag("N", "s_nationkey"), tag("S", "s_suppkey"))
    )
    return FormulaGraph(vertices, edges)


def block_graph(spark: SparkSession, folder: str) -> FormulaGraph:
    """Many small cycles, tied together by a tree.

    Parts come in blocks of ten. Each part leads on within its block by its size and to
    the first part of the block its own block hangs on, block b on block b/2.
    """
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    within = F.expr("p_partkey - p_partkey % 10 + (p_partkey % 10 + p_size) % 10")
    above = F.expr("(p_partkey div 20) * 10")
    edges = part.select(
        "p_partkey", F.explode(F.array_distinct(F.array(within, above))).alias("next")
    ).select(tag("P", "p_partkey").alias("src"), tag("P", "next").alias("dst"))
    vertices = _vertex(
        table(spark, folder, "part"), tag("P", "p_partkey"), "p_name", F.col("p_retailprice")
    )
    return FormulaGraph(vertices, edges)


def ring_graph(spark: SparkSession, folder: str) -> FormulaGraph:
    """Part k leads to part k + size, round the end, and to part k/2: mostly one big cycle."""
    part = table(spark, folder, "part").select("p_partkey", "p_size")
    onward = (F.col("p_partkey") + F.col("p_size")) % part.count()
    half = F.expr("p_partkey div 2")
    edges = (
        part.select("p_partkey", F.explode(F.array_distinct(F.array(onward, half))).alias("next"))
        .select(tag("P", "p_partkey").alias("src"), tag("P", "next").alias("dst"))
    )
    vertices = _vertex(
        table(spark, folder, "part"), tag("P", "p_partkey"), "p_name", F.col("p_retailprice")
    )
    return FormulaGraph(vertices, edges)


def sales_hierarchy(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Vertices ``(id, root, path)`` and edges ``(parent, child)``, region down to order."""
    region, nation, customer, orders = (
        table(spark, folder, n) for n in ("region", "nation", "customer", "orders")
    )
    order_id = tag("O", "o_orderkey")
    vertices = (
        _vertex(region, tag("R", "r_regionkey"), "r_name", F.lit(0))
        .unionByName(_vertex(nation, tag("N", "n_nationkey"), "n_name", F.lit(0)))
        .unionByName(_vertex(customer, tag("C", "c_custkey"), "c_name", F.lit(0)))
        .unionByName(_vertex(orders, order_id, order_id, F.lit(0)))
        .select("id", F.col("name").alias("root"), F.col("name").alias("path"))
    )
    edges = (
        _edge(nation, tag("R", "n_regionkey"), tag("N", "n_nationkey"))
        .unionByName(_edge(customer, tag("N", "c_nationkey"), tag("C", "c_custkey")))
        .unionByName(_edge(orders, tag("C", "o_custkey"), order_id))
        .selectExpr("src as parent", "dst as child")
    )
    return vertices, edges


def supply_tree(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Parts under their suppliers, several for most of them, as order lines tell."""
    part, supplier, line = (table(spark, folder, n) for n in ("part", "supplier", "lineitem"))
    own = _vertex(part, tag("P", "p_partkey"), "p_name", F.lit(0)).unionByName(
        _vertex(supplier, tag("S", "s_suppkey"), "s_name", F.lit(0))
    )
    edges = _edge(line, tag("S", "l_suppkey"), tag("P", "l_partkey")).distinct()
    return own.select("id", F.col("name").alias("root"), F.col("id").alias("path")), edges.selectExpr(
        "src as parent", "dst as child"
    )


def orphaned_orders(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders under customers; those that are finished name a parent that is not there."""
    customer, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    vertices = _vertex(customer, tag("C", "c_custkey"), "c_name", F.lit(0)).unionByName(
        _vertex(orders, tag("O", "o_orderkey"), "o_orderstatus", F.lit(0))
    )
    parent = F.when(F.col("o_orderstatus") == "F", tag("gone", "o_custkey")).otherwise(tag("C", "o_custkey"))
    edges = _edge(orders, parent, tag("O", "o_orderkey"))
    return vertices.select("id", F.col("id").alias("root"), F.col("id").alias("path")), edges.selectExpr(
        "src as parent", "dst as child"
    )


def part_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with a parent, part k under part k/2 and part 0 on top."""
    above = F.when(F.col("p_partkey") > 0, tag("P", F.expr("p_partkey div 2")))
    return table(spark, folder, "part").select(
        tag("P", "p_partkey").alias("part_id"), "p_name", "p_brand", above.alias("parent_id")
    )


def part_rings(spark: SparkSession, folder: str) -> DataFrame:
    """Parts with a parent from the same block of ten, so that each has a cycle above it."""
    above = F.expr("p_partkey - p_partkey % 10 + (p_partkey % 10 + p_size) % 10")
    return table(spark, folder, "part").select(
        tag("P", "p_partkey").alias("part_id"), "p_name", tag("P", above).alias("parent_id")
    )
