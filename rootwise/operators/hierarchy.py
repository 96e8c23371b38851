"""Parent/child tables: level, root, path, cycle and leaf flag of every row."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootwise.model import GraphError
from rootwise.operators.doubling import rings
from rootwise.scratch import RoundTable, Scratch

_COLUMNS = ["id", "level", "root", "path", "isleaf"]


def hierarchy_columns(
    vertices: DataFrame,
    edges: DataFrame,
    multi_parent: str = "error",
    orphan: str = "error",
    separator: str = "/",
) -> DataFrame:
    """``(id, level, root, path, iscyclic, isleaf)`` for ``vertices(id, root, path)``.

    ``edges(parent, child)``. A vertex without a parent is at level 1; ``root`` is the
    topmost vertex's, ``path`` the ``path`` entries from there down. ``isleaf`` is 1
    without any other vertex below, ``iscyclic`` is 1 on or below a cycle.

    On a cycle of n vertices there is no top: a vertex there has level n, its path is the
    n vertices walked up from it, and its root that of the last one; what hangs below goes
    on from there. ``multi_parent="min"`` keeps the smallest parent instead of raising and
    ``orphan="root"`` makes a vertex with an unknown parent a top one.
    """
    scratch = Scratch(vertices.sparkSession, "hierarchy")
    nodes = _nodes(scratch, vertices, edges, multi_parent, orphan)
    text = F.concat(F.lit(separator), "seg")
    found = _lifted(scratch, _unlifted(nodes.df, text), nodes.rows)
    out = found.df.withColumn("iscyclic", F.lit(0))
    if found.rows < nodes.rows:
        tied = scratch.write(nodes.df.join(found.df.select("id"), "id", "left_anti"))
        out = out.unionByName(_cyclic(scratch, tied, separator).withColumn("iscyclic", F.lit(1)))
    return out.select("id", "level", "root", "path", "iscyclic", "isleaf")


def with_hierarchy(
    df: DataFrame,
    pk: str,
    parent: str,
    root: Column,
    path: Column,
    **options,
) -> DataFrame:
    """``df`` with the hierarchy columns of its own ``pk``/``parent`` relation.

    Columns of ``df`` with the names of these are replaced, as ``withColumn`` does.
    """
    vertices = df.select(F.col(pk).alias("id"), root.alias("root"), path.alias("path"))
    edges = df.where(F.col(parent).isNotNull()).select(
        F.col(parent).alias("parent"), F.col(pk).alias("child")
    )
    found = hierarchy_columns(vertices, edges, **options)
    own = df.select(F.col(pk).alias("id"), F.struct(*[F.col(f"`{name}`") for name in df.columns]).alias("own"))
    added = ["level", "root", "path", "iscyclic", "isleaf"]
    kept = [F.col(f"own.`{name}`") for name in df.columns if name.lower() not in added]
    return own.join(found, "id").select(*kept, *added)


def _nodes(scratch, vertices, edges, multi_parent, orphan) -> RoundTable:
    """``(id, root, seg, parent, isleaf)``, checked to have at most one parent each."""
    if multi_parent not in ("error", "min") or orphan not in ("error", "root"):
        raise ValueError("multi_parent is 'error' or 'min', orphan is 'error' or 'root'")
    links = scratch.write(
        edges.where("parent is not null and child is not null")
        .groupBy("child")
        .agg(F.min("parent").alias("parent"), F.max("parent").alias("other")),
        several=F.count_if(F.col("parent") != F.col("other")),
    )
    if links.counts["several"] and multi_parent == "error":
        raise GraphError(f"{links.counts['several']} vertices have more than one parent")
    links_df = links.df.select("child", "parent")
    # One pass over all uses of an id tells what it is; a parent of many is counted before
    # the shuffle.
    def use(df, name, vertex, over):
        return df.select(F.col(name).alias("id"), F.lit(vertex).alias("vertex"), over.alias("over"))

    is_other = F.col("parent") != F.col("child")
    kinds = scratch.write(
        use(vertices, "id", 1, F.lit(0))
        .unionByName(use(links_df, "parent", 0, F.when(is_other, 2).otherwise(1)))
        .unionByName(use(links_df, "child", 0, F.lit(0)))
        .groupBy("id")
        .agg(F.sum("vertex").alias("vertex"), F.max("over").alias("over")),
        repeated=F.count_if(F.col("vertex") > 1),
        orphaning=F.count_if((F.col("vertex") == 0) & (F.col("over") > 0)),
        unknown=F.count_if((F.col("vertex") == 0) & (F.col("over") == 0)),
    )
    if kinds.counts["repeated"]:
        raise GraphError(f"{kinds.counts['repeated']} ids occur more than once")
    if kinds.counts["unknown"]:
        raise GraphError(f"{kinds.counts['unknown']} children are no vertices")
    if kinds.counts["orphaning"]:
        if orphan == "error":
            raise GraphError(f"{kinds.counts['orphaning']} parents are no vertices")
        unknown = kinds.df.where("vertex = 0").select(F.col("id").alias("parent"))
        links_df = links_df.join(unknown, "parent", "left_anti")
    leaf = kinds.df.select("id", F.when(F.col("over") == 2, 0).otherwise(1).alias("isleaf"))
    return scratch.write(
        vertices.select("id", "root", F.col("path").alias("seg"))
        .join(leaf, "id")
        .join(links_df.withColumnRenamed("child", "id"), "id", "left")
    )


@dataclass(frozen=True)
class _Lifted:
    """Rows ``(id, level, root, path, isleaf)`` that a top was found for, and their number."""

    df: DataFrame
    rows: int


def _unlifted(nodes: DataFrame, text: Column) -> DataFrame:
    """Every vertex with its parent ``up`` and the path from below that, here its own entry."""
    return nodes.select(
        "id",
        F.col("parent").alias("up"),
        F.lit(1).alias("level"),
        F.when(F.col("parent").isNull(), F.col("root")).alias("root"),
        text.alias("path"),
        "isleaf",
    )


def _lifted(scratch, start: DataFrame, rows: int) -> _Lifted:
    """Double the way up of every vertex of ``start`` until it ends at a top, which has ``up`` NULL.

    A round puts the path of ``up``, as far as it is known, before a vertex's own, so levels from ``2**k`` on
    are found in round k. A round that finds none means that what is left has no top: were there a
    deeper vertex with one, some vertex above it would have been found.
    """
    is_top = F.col("up").isNull()
    last = scratch.write(start, tops=F.count_if(is_top))
    tables, found = [last], last.counts["tops"]
    fresh = found
    while fresh and found < rows:
        here = last.df.where(~is_top)
        known = scratch.scan(tables).where(is_top).unionByName(here)
        above = known.select(
            F.col("id").alias("at"), F.col("up").alias("next"), F.col("level").alias("more"),
            F.col("root").alias("top"), F.col("path").alias("before"),
        )
        joined = here.join(above, F.col("up") == F.col("at")).select(
            "id",
            F.col("next").alias("up"),
            (F.col("level") + F.col("more")).alias("level"),
            F.col("top").alias("root"),
            F.concat("before", "path").alias("path"),
            "isleaf",
        )
        last = scratch.write(joined, tops=F.count_if(is_top))
        fresh = last.counts["tops"]
        tables.append(last)
        found += fresh
    return _Lifted(scratch.scan(tables).where(is_top).select(*_COLUMNS), found)


def _cyclic(scratch, tied: RoundTable, separator: str) -> DataFrame:
    """Rows of the vertices no top is above: cycles, and the trees below them."""
    members = rings(scratch, tied.df.select("id", F.col("parent").alias("to")), tied.rows).select("id", "n")
    ring = scratch.write(tied.df.join(members, "id"), longest=F.max("n"))
    rows = _walked(scratch, ring, separator)
    nothing = F.lit(None).cast(tied.schema["parent"].dataType)
    trees = tied.df.join(members.select("id"), "id", "left_anti")
    below = _unlifted(trees, F.concat(F.lit(separator), "seg"))
    tops = rows.withColumn("up", nothing).select(*below.columns)
    return _lifted(scratch, tops.unionByName(below), tied.rows).df


def _walked(scratch, ring: RoundTable, separator: str) -> DataFrame:
    """Each vertex of a cycle of n with the path of the n vertices walked up from it.

    Walks of 1, 2, 4 and more steps are put together from two of half the length; those
    that make up n are joined end to end, so there are as many rounds as n has binary digits.
    ``to`` is where a walk arrives, ``text`` the vertices before that, ``last`` the root of the last one.
    """
    text = F.concat(F.lit(separator), "seg")
    jumps = scratch.write(ring.df.select("id", F.col("parent").alias("to"), text.alias("text"), F.col("root").alias("last")))
    walks = scratch.write(
        ring.df.select("id", "isleaf", "n", F.col("id").alias("to"), F.lit("").alias("text"), "root")
    )
    step = 1
    while step <= (ring.counts["longest"] or 0):
        onward = jumps.df.toDF("at", "next", "more", "last")
        takes = F.col("n").bitwiseAND(F.lit(step)) != 0
        joined = walks.df.join(onward, F.when(takes, F.col("to")) == F.col("at"), "left")
        longer = scratch.write(
            joined.select(
                "id",
                "isleaf",
                "n",
                F.when(takes, F.col("next")).otherwise(F.col("to")).alias("to"),
                F.when(takes, F.concat("more", "text")).otherwise(F.col("text")).alias("text"),
                F.when(takes, F.col("last")).otherwise(F.col("root")).alias("root"),
            )
        )
        step *= 2
        if step <= ring.counts["longest"]:
            doubled = scratch.write(
                jumps.df.drop("last")
                .join(onward, F.col("to") == F.col("at"))
                .select("id", F.col("next").alias("to"), F.concat("more", "text").alias("text"), "last")
            )
            scratch.drop(jumps)
            jumps = doubled
        scratch.drop(walks)
        walks = longer
    return walks.df.select("id", F.col("n").cast("int").alias("level"), "root", F.col("text").alias("path"), "isleaf")
