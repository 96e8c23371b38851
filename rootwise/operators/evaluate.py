"""Evaluate every formula in dependency order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from rootwise.functions.arith import expression_value
from rootwise.functions.text import filled_piece, has_opening, int_text, is_open
from rootwise.model import FormulaGraph
from rootwise.operators import blocks
from rootwise.operators.blocks import BLOCKED, OK, PARSE_ERROR
from rootwise.operators.build import text_pieces
from rootwise.operators.depth import BELOW_CYCLE, CYCLIC, REACHED, depth_table
from rootwise.scratch import RoundTable, Scratch

# A value of ``status`` beside those of blocks.
NO_FORMULA = "no_formula"

# Partition of the reference pieces of formulas on or below a cycle.
_NO_DEPTH = -1
_PIECE = ["id", "pos", "lead", "ref", "tail", "linked"]

# Tables of handed-on arguments to pile up before they are merged into one.
MERGE_EVERY = 24


def evaluate_formulas(graph: FormulaGraph, on_error: str = "null") -> DataFrame:
    """``(id, formula, depth, value, status)`` for every vertex.

    ``formula`` is the text with each known argument filled in, ``depth`` the longest
    path from the root, ``value`` the number the filled text stands for. ``status``:

    - ``ok``: has a value (it may be infinite or NaN);
    - ``blocked``: an argument is missing: no such vertex, not reached, infinite, itself
      without a value, or below a cycle;
    - ``cyclic``: on a cycle; ``unreachable``: not below the root;
    - ``parse_error``: the filled text is no expression (``on_error="fail"`` raises);
    - ``no_formula``: the text is NULL.

    Texts without references are evaluated at once. The others are cut into pieces, one
    per reference, and their depths put together into windows of bounded blocks
    (:mod:`rootwise.operators.blocks`). A block resolves all that lies inside it; a piece whose
    argument comes from an earlier window is joined once, with the values of that window.
    """
    scratch = Scratch(graph.spark, "evaluate")
    depths = depth_table(graph, scratch)
    texts = graph.vertices.select("id", "formula")
    at_depth = depths.df
    settled = at_depth.where(F.col("state") == REACHED).drop("state")

    plain = texts.where(F.col("formula").isNull() | ~has_opening(F.col("formula")))
    judge = _judge(graph.root_id, on_error)
    done = [scratch.write(judge(plain.join(settled, "id")))]
    cut = _pieces(graph, texts, at_depth)
    pieces = _windows(scratch, cut, at_depth, graph.root_id, on_error, done)
    parts = [scratch.scan(done)]
    if depths.unbounded:
        tied = at_depth.where(F.col("state").isin(CYCLIC, BELOW_CYCLE))
        here = pieces.df.where(F.col("lane") == _NO_DEPTH).select(*_PIECE)
        known = scratch.scan(done).select(F.col("id").alias("known"), _argument())
        given = here.join(known, (F.col("ref") == F.col("known")) & F.col("linked"), "left")
        held = _joined_up(given).unionByName(plain.join(tied, "id", "left_semi"))
        parts.append(_without_value(held.join(tied, "id")))
    if depths.table.rows > sum(table.rows for table in done):
        idle = texts.join(at_depth.where("state = 'unreachable'"), "id")
        parts.append(_without_value(idle))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def formula_args(graph: FormulaGraph, evaluated: DataFrame) -> DataFrame:
    """``(id, arg, value)``: every parent value that reached a formula over an edge.

    Long form, as a formula may have any number of parents.
    """
    sent = evaluated.where(_sendable(F.col("value"))).select(F.col("id").alias("src"), "value")
    return (
        graph.edges.select("src", "dst")
        .distinct()
        .join(sent, "src")
        .select(F.col("dst").alias("id"), F.col("src").alias("arg"), "value")
    )


def with_args_map(evaluated: DataFrame, args: DataFrame) -> DataFrame:
    """``evaluated`` with ``args map<id, value>``, for formulas whose parents fit a row."""
    maps = args.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("arg", "value"))).alias("args")
    )
    empty = F.create_map().cast("map<string,double>")
    return evaluated.join(maps, "id", "left").withColumn("args", F.coalesce("args", empty))


def _sendable(value: Column) -> Column:
    """Positive infinity stands for "not computed" and is not passed on."""
    return value.isNotNull() & (value != float("inf"))


def _judge(root_id: str, on_error: str) -> Callable[[DataFrame], DataFrame]:
    """From ``(id, formula, depth)`` to value and status; the root is 0 by definition."""
    text, value = F.col("formula"), F.col("value")
    is_root = F.col("id") == root_id
    number = expression_value(F.when(~is_open(text) & ~is_root, text), on_error).cast("double")
    status = (
        F.when(text.isNull(), NO_FORMULA)
        .when(value.isNotNull(), OK)
        .when(is_open(text), BLOCKED)
        .otherwise(PARSE_ERROR)
    )
    columns = [
        "id",
        "formula",
        "depth",
        F.when(is_root, F.lit(0.0)).otherwise(value).alias("value"),
        F.when(is_root, OK).otherwise(status).alias("status"),
    ]
    return lambda filled: filled.withColumn("value", number).select(*columns)


def _pieces(graph: FormulaGraph, texts: DataFrame, at_depth: DataFrame) -> DataFrame:
    """Reference pieces of all reached texts, each with the depth of its text as ``lane``."""
    lanes = at_depth.where(F.col("state").isin(REACHED, CYCLIC, BELOW_CYCLE)).select(
        "id", F.coalesce("depth", F.lit(_NO_DEPTH)).alias("lane")
    )
    cut = graph.pieces if graph.pieces is not None else text_pieces(texts)
    cut = cut.join(lanes, "id")
    if graph.edges_from_text:
        return cut.withColumn("linked", F.lit(True))
    edges = graph.edges.select(F.col("src").alias("ref"), F.col("dst").alias("id"))
    edges = edges.distinct().withColumn("linked", F.lit(True))
    return cut.join(edges, ["id", "ref"], "left").withColumn(
        "linked", F.coalesce("linked", F.lit(False))
    )


def _windows(scratch, cut, at_depth, root_id, on_error, done) -> RoundTable:
    """Evaluate window by window, handing values on to the pieces that wait for them.

    A piece's ``lane`` is the window of its text and its ``turn`` the window its argument comes
    from; that is 0 when there is nothing to wait for, as the argument is a constant, will never
    come, or is found inside the block. The values of a window meet only the pieces of that turn,
    so every piece and value is shuffled a fixed number of times, whatever the depth of the graph.
    Tables are sorted by turn and lane inside their files: their number does not grow with the
    depth, and a read skips other turns' pages.
    """
    cut = scratch.write(cut)
    sizes = cut.df.where("lane > 0").groupBy(F.col("lane").alias("depth")).agg(
        F.sum(blocks.piece_bytes()).alias("bytes")
    )
    windows = scratch.write(blocks.depth_windows(sizes, blocks.BLOCK_BYTES), last=F.max("window"))
    constants = done[0].df.select("id", _argument(), F.lit(True).alias("constant"))
    sources = (
        at_depth.where(F.col("state") == REACHED)
        .select("id", F.col("depth").alias("source_depth"))
        .join(constants, "id", "left")
        .join(windows.df.select(F.col("depth").alias("source_depth"), F.col("window").alias("source")), "source_depth", "left")
        .withColumnRenamed("id", "known")
    )
    own = windows.df.withColumnRenamed("depth", "lane")
    joined = cut.df.join(own, "lane", "left").join(
        sources, (F.col("ref") == F.col("known")) & F.col("linked"), "left"
    )
    waits = F.col("window").isNotNull() & F.col("source").isNotNull() & F.col("constant").isNull()
    inner = waits & (F.col("source") == F.col("window"))
    pieces = scratch.write(
        joined.select(
            *_PIECE,
            "argument",
            F.when(waits & ~inner, F.col("source")).otherwise(0).alias("turn"),
            F.coalesce("window", F.lit(_NO_DEPTH)).alias("lane"),
            F.when(F.col("lane") > 0, F.col("lane")).cast("int").alias("depth"),
            F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"),
            F.coalesce(inner, F.lit(False)).alias("inner"),
        ).sortWithinPartitions("turn", "lane")
    )
    scratch.drop(cut)
    schema = done[0].schema
    resolve = blocks.block_resolver(root_id, on_error, to_arrow_schema(schema))
    served = [*_PIECE, "argument", "lane", "depth", "part", "inner"]
    handed: list[RoundTable] = []
    for window in range(1, windows.counts["last"] + 1):
        here = pieces.df.where((F.col("turn") == 0) & (F.col("lane") == window)).select(*served)
        if handed:
            here = here.unionByName(scratch.scan(handed).where(F.col("lane") == window))
        level = scratch.write(here.groupBy("part").applyInArrow(resolve, schema))
        done.append(level)
        if window < windows.counts["last"]:
            values = level.df.select(F.col("id").alias("known"), _argument())
            next_up = pieces.df.where(F.col("turn") == window).drop("argument")
            given = next_up.join(values, F.col("ref") == F.col("known"), "left")
            table = scratch.write(given.select(*served).sortWithinPartitions("lane"))
            if table.rows:
                handed.append(table)
        if len(handed) > MERGE_EVERY:
            rest = scratch.scan(handed).where(F.col("lane") > window)
            merged = scratch.write(rest.sortWithinPartitions("lane"))
            scratch.drop(*handed)
            handed = [merged]
        if len(done) > MERGE_EVERY:
            merged = scratch.write(scratch.scan(done))
            scratch.drop(*done)
            done[:] = [merged]
    return pieces


def _argument() -> Column:
    """A value as the text that replaces a reference, NULL if it is not passed on."""
    value = F.col("value")
    return F.when(_sendable(value), int_text(value)).alias("argument")


def _joined_up(pieces: DataFrame) -> DataFrame:
    """``(id, formula)`` from pieces with their ``argument``."""
    piece = filled_piece(F.col("lead"), F.col("ref"), F.col("tail"), F.col("argument"))
    row = F.array_sort(F.collect_list(F.struct("pos", piece.alias("piece"))))
    texts = pieces.groupBy("id").agg(row.alias("row"))
    return texts.select("id", F.array_join(F.col("row.piece"), "").alias("formula"))


def _without_value(rows: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("formula").isNull(), NO_FORMULA)
        .when(F.col("state") == BELOW_CYCLE, BLOCKED)
        .otherwise(F.col("state"))
    )
    return rows.select(
        "id", "formula", "depth", F.lit(None).cast("double").alias("value"), status.alias("status")
    )
