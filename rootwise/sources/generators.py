"""Generated graphs."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rootwise.scratch import Scratch

# The usual parameters of the out-degree distribution.
MU = 4.0
SIGMA = 1.3

# Edges of one vertex that are drawn together.
BLOCK = 100_000


def log_normal_edges(
    vertices: DataFrame,
    count: int,
    mu: float = MU,
    sigma: float = SIGMA,
    seed: int = 0,
    weight: float = 1.0,
    block: int = BLOCK,
) -> DataFrame:
    """``(src, dst, weight)`` over ``vertices(id)`` numbered ``0 .. count-1``.

    Out-degrees are whole parts of log-normal numbers, conditional on being below ``count``; targets are
    uniform, so repeats and self-loops occur. All draws are MD5 sums of the seed, the vertex and
    the draw's number: the graph is the same however the rows are partitioned or recomputed,
    and other engines can draw it too.

    A vertex's edges are drawn in blocks of at most ``block``, which are dealt out over the tasks: neither
    a row nor a task holds all edges of a vertex that has very many.
    """
    if count < 1 or block < 1:
        raise ValueError("count is the number of vertices, block that of a block's edges; both are at least 1")
    # A stated number of tasks: by their sizes the blocks would be put together, and their edges with them.
    tasks = int(vertices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    draw = _draw(F.lit(f"{seed}-degree-"), F.col("id").cast("string"))
    target = _draw(F.lit(f"{seed}-target-"), F.col("src").cast("string"), F.lit("-"), F.col("nth").cast("string"))
    # Step by step, as written out over the draw the number is a text that takes the planner half a minute; and
    # written, as the planner would put the steps into one another below the filter.
    degrees = (
        vertices.select("id", draw.alias("draw"), F.expr(_share_below(str(count), mu, sigma)).alias("below"))
        .select("id", F.expr(_quantile_place("draw", "below")).alias("place"))
        .select("id", F.expr(normal_quantile_sql("place")).alias("normal"))
        .select("id", F.expr(_degree_at("normal", str(count), mu, sigma)).cast("int").alias("degree"))
    )
    return (
        Scratch(vertices.sparkSession, "degrees").write(degrees).df
        .where("degree > 0")
        .select("id", "degree", F.explode(F.expr(f"sequence(0, (degree - 1) div {block})")).alias("block"))
        .repartition(tasks, "id", "block")
        .select(
            F.col("id").alias("src"),
            F.explode(
                F.expr(f"sequence(block * {block} + 1, least(block * {block} + {block}, cast(degree as bigint)))")
            ).alias("nth"),
        )
        .select("src", F.pmod(target, F.lit(count)).alias("dst"), F.lit(weight).alias("weight"))
    )


def log_normal_graph(spark: SparkSession, num_vertices: int, **options) -> tuple[DataFrame, DataFrame]:
    """Vertices ``0 .. num_vertices-1`` and their log-normal edges."""
    vertices = spark.range(num_vertices)
    return vertices, log_normal_edges(vertices, num_vertices, **options)


DRAWS = 1 << 52  # a draw is a whole number below this

# The coefficients of a well-known rational approximation of the normal quantile.
_A = (-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239)
_B = (-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0)
_C = (-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783)
_D = (0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0)
_TAIL = 0.02425
# The same for the normal share: highest power first, without the constant term.
_E = (1.330274429, -1.821255978, 1.781477937, -0.356563782, 0.319381530)


def _draw(*parts: Column) -> Column:
    """A whole number from the first 13 hex digits of an MD5 sum."""
    return F.conv(F.substring(F.md5(F.concat(*parts).cast("binary")), 1, 13), 16, 10).cast("long")


def _double(number: float) -> str:
    return f"cast({number!r} as double)"


def _polynomial(coefficients: tuple[float, ...], x: str) -> str:
    text = _double(coefficients[0])
    for coefficient in coefficients[1:]:
        text = f"({text} * {x} + {_double(coefficient)})"
    return text


def normal_quantile_sql(p: str) -> str:
    """The number that a standard normal one is below with probability ``p``, as SQL."""
    q, r = f"({p} - 0.5)", f"(({p} - 0.5) * ({p} - 0.5))"
    low, high = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))"
    return (
        f"CASE WHEN {p} < {_TAIL} THEN {_polynomial(_C, low)} / {_polynomial(_D, low)} "
        f"WHEN {p} > {1 - _TAIL} THEN -{_polynomial(_C, high)} / {_polynomial(_D, high)} "
        f"ELSE {_polynomial(_A, r)} * {q} / {_polynomial(_B, r)} END"
    )


def normal_share_sql(x: str) -> str:
    """The probability that a standard normal number is below ``x``, as SQL, to seven digits."""
    t = f"(1 / (1 + {_double(0.2316419)} * abs({x})))"
    above = f"exp(-({x}) * ({x}) / 2) * {_double(1 / math.sqrt(2 * math.pi))} * {_polynomial(_E, t)} * {t}"
    return f"CASE WHEN {x} < 0 THEN {above} ELSE 1 - {above} END"


def degree_sql(draw: str, count: str, mu: float = MU, sigma: float = SIGMA) -> str:
    """A log-normal degree below ``count`` from a draw, as SQL over two columns.

    The draw is a quantile of the part of the distribution below ``count``, so none is
    too large and none has to be drawn again.
    """
    return _degree_at(normal_quantile_sql(_quantile_place(draw, _share_below(count, mu, sigma))), count, mu, sigma)


def _share_below(count: str, mu: float, sigma: float) -> str:
    return normal_share_sql(f"((ln({count}) - {_double(mu)}) / {_double(sigma)})")


def _quantile_place(draw: str, below: str) -> str:
    return f"(({draw} + 0.5) / {_double(float(DRAWS))} * ({below}))"


def _degree_at(normal: str, count: str, mu: float, sigma: float) -> str:
    return f"least({count} - 1, floor(exp({_double(mu)} + {_double(sigma)} * ({normal}))))"
