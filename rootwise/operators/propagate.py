"""Vertex programs: messages along edges, merged per vertex, until none is sent."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootwise.model import GraphError
from rootwise.scratch import Scratch

# Tables of changed rows to pile up before all states are written anew.
MERGE_EVERY = 24
# All states are written anew, too, when more than this part of them has changed since, as a divisor.
WHOLE = 8


def propagate(
    vertices: DataFrame,
    edges: DataFrame,
    state: dict[str, Column],
    message: dict[str, Column],
    merge: dict[str, Callable[[Column], Column]],
    update: dict[str, Column],
    send_if: Column | None = None,
    send_to: str = "dst",
    reads_target: bool = False,
    active: str = "out",
    max_rounds: int | None = None,
) -> DataFrame:
    """Run a vertex program and return ``(id, *state)``.

    - ``state``: initial columns, from the columns of ``vertices(id, ...)``.
    - ``message``: what an edge sends, from ``src.<state>``, ``edge.<column>`` and, with
      ``reads_target`` or ``active="any"``, ``dst.<state>``; ``src.id``/``dst.id`` are the
      ends. It is sent where ``send_if`` holds, to the ``send_to`` end.
    - ``merge``: the aggregate that joins the messages for one vertex, such as ``F.max``.
    - ``update``: new state of a vertex that got messages, from ``old.<state>`` and
      ``msg.<message>``; state columns it leaves out keep their value. A state column keeps
      the type it begins with.

    In the first round every vertex is active, later those that just got a message.
    ``active="out"`` looks at edges out of an active vertex, ``"any"`` at edges with an
    active vertex at either end. It ends when nothing is sent; going on for more than
    ``max_rounds`` raises.

    A round writes the vertices it changes and reads the edges next to them; the others'
    states stay where they were written, in buckets of their id. Where many change, a round writes all
    states instead: the next one then joins them with the edges as both lie, and no older rows are grouped.
    Of several rows with one id, one is taken.
    """
    if active not in ("out", "any") or send_to not in ("src", "dst"):
        raise ValueError("active is 'out' or 'any', send_to is 'src' or 'dst'")
    scratch = Scratch(vertices.sparkSession, "propagate")
    names = list(state)
    links = scratch.write_bucketed(edges.select("src", "dst", F.struct(*edges.columns).alias("edge")), "src").df
    started = vertices.select("id", *[column.alias(name) for name, column in state.items()], F.lit(0).alias("round"))
    all_states = scratch.write_bucketed(_newest(started, names, keep_round=True), "id", spread=False)
    kinds = {name: all_states.schema[name].dataType for name in names}
    known = [all_states]
    changed, changed_rows = all_states.df, all_states.rows
    needs_target = reads_target or active == "any"
    rounds = 0
    while changed_rows:
        if max_rounds is not None and rounds > max_rounds:
            raise GraphError(f"messages are still sent after {max_rounds} rounds")
        whole, used = len(known) == 1, []
        # Ends come in as structs, so that src.x and dst.x are what the caller names.
        near = links.withColumnsRenamed({"src": "src_id", "dst": "dst_id"})
        if active == "out":
            looks = near.join(_end(changed, "src", names, whole), "src_id")
            if needs_target:
                ids = looks.select(F.col("dst_id").alias("id"))
                ends = known[0].df if whole else _latest(scratch, known, ids, names)
                looks = looks.join(_end(ends, "dst", names, whole), "dst_id")
        elif whole:
            looks = near
            for end in ("src", "dst"):
                just = (F.col("round") == rounds).alias(f"{end}_just")
                looks = looks.join(_end(known[0].df, end, names, whole, just), f"{end}_id")
            looks = looks.where(F.col("src_just") | F.col("dst_just"))
        else:
            touched = scratch.write(_touched(near, changed.select("id")))
            ids = touched.df.select(F.explode(F.array("src_id", "dst_id")).alias("id"))
            ends = scratch.write(_latest(scratch, known, ids, names))
            looks = touched.df.join(_end(ends.df, "src", names), "src_id").join(_end(ends.df, "dst", names), "dst_id")
            used = [touched, ends]
        if send_if is not None:
            looks = looks.where(send_if)
        sent = looks.select(
            F.col(f"{send_to}_id").alias("id"),
            *[column.alias(name) for name, column in message.items()],
        )
        inbox = sent.groupBy("id").agg(*[merge[name](F.col(name)).alias(name) for name in message])
        inbox = scratch.write(inbox.select("id", F.struct(*message).alias("msg")))
        scratch.drop(*used)
        if not inbox.rows:
            break
        rounds += 1
        newer = {name: update.get(name, F.col(f"old.{name}")).cast(kinds[name]) for name in names}
        if WHOLE * (sum(table.rows for table in known[1:]) + inbox.rows) > known[0].rows or len(known) > MERGE_EVERY:
            # One row a vertex on both sides: a bucket's messages fit a hash table, and the states stay where they lie.
            rows = known[0].df if whole else _newest(scratch.scan(known), names, keep_round=True)
            rows = rows.select("id", F.struct(*names).alias("old"), "round").join(inbox.df.hint("shuffle_hash"), "id", "left")
            got = F.col("msg").isNotNull()
            following = rows.select(
                "id",
                *[F.when(got, new).otherwise(F.col(f"old.{name}")).alias(name) for name, new in newer.items()],
                F.when(got, rounds).otherwise(F.col("round")).alias("round"),
            )
            table = scratch.write_bucketed(following, "id", spread=False, changed=F.count_if(F.col("round") == rounds))
            scratch.drop(*known)
            known = [table]
            changed, changed_rows = table.df.where(F.col("round") == rounds), table.counts["changed"]
        else:
            old = _latest(scratch, known, inbox.df.select("id"), names).select("id", F.struct(*names).alias("old"))
            columns = [new.alias(name) for name, new in newer.items()]
            table = scratch.write(inbox.df.join(old, "id").select("id", *columns, F.lit(rounds).alias("round")))
            known.append(table)
            changed, changed_rows = table.df, table.rows
        scratch.drop(inbox)
    if len(known) == 1:
        return known[0].df.select("id", *names)
    return _newest(scratch.scan(known), names)


def _newest(rows: DataFrame, names: list[str], keep_round: bool = False) -> DataFrame:
    """Each vertex as the last round that changed it left it."""
    last = rows.groupBy("id").agg(F.max_by(F.struct(*names, "round"), "round").alias("last"))
    return last.select("id", *[f"last.{name}" for name in ([*names, "round"] if keep_round else names)])


def _latest(scratch: Scratch, known: list, ids: DataFrame, names: list[str]) -> DataFrame:
    """The states of some vertices only: other rows are not grouped."""
    rows = scratch.scan(known).join(ids.select("id").distinct(), "id", "left_semi")
    return _newest(rows, names)


def _touched(links: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges with one of ``ids`` at either end, each once."""
    source = ids.select(F.col("id").alias("src_id"), F.lit(True).alias("out"))
    target = ids.select(F.col("id").alias("dst_id"), F.lit(True).alias("in"))
    marked = links.join(source, "src_id", "left").join(target, "dst_id", "left")
    return marked.where(F.col("out").isNotNull() | F.col("in").isNotNull()).select(*links.columns)


def _end(vertices: DataFrame, end: str, names: list[str], whole: bool = False, *more: Column) -> DataFrame:
    """States as one end of an edge; those read from the table of ``whole`` states are met by hash, bucket by bucket."""
    ends = vertices.select(F.col("id").alias(f"{end}_id"), F.struct("id", *names).alias(end), *more)
    return ends.hint("shuffle_hash") if whole else ends
