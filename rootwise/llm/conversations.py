"""Conversation structure repair by weighted CYK parsing of spans.

A well-formed conversation is ``(s?(ua)+)?``: perhaps a system turn, then user and assistant in turn.
The grammar is in Chomsky normal form: a nonterminal ``(p, q)`` is what leads from state ``p`` of that
pattern to state ``q``, and ``(p, q) -> (p, r) (r, q)``. A row is a span of length one, whose cell has for
every nonterminal the least ``(cost, audit)`` of keeping, re-roling or deleting the row, after the
insertion closure: what inserted turns alone lead to. Cells of neighbouring spans are combined
bottom-up, spans of 1, 2, 4 and more rows. As any bracketing of these nonterminals derives the same
strings, one split a span is enough.

Least cells may be put together: two audits of one cost over the same rows and states are never the start
of one another (only insertions could follow, and they cost), so what is appended doesn't change their order.

Rows are sorted by range over conversation and turn, so that a long conversation lies in several tasks. One
that lies inside a task is repaired there. Those at a task's edges go on as rows: their repeats are
found by a join, each task's stretch becomes one cell, and a conversation's few cells are combined.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootwise.scratch import Scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
# The costs of edits.
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FINAL = (START, ASSISTANT)
NAMES = {"u": "user", "a": "assistant"}
PAIRS = [
    *((START, q) for q in range(4)), *((SYSTEM, q) for q in (SYSTEM, USER, ASSISTANT)),
    *((p, q) for p in (USER, ASSISTANT) for q in (USER, ASSISTANT)),
]
PLACE = {pair: i for i, pair in enumerate(PAIRS)}
RULES = [
    (PLACE[p, q], PLACE[p, r], PLACE[r, q]) for p, q in PAIRS for r in range(4) if (p, r) in PLACE and (r, q) in PLACE
]

Cell = list  # per nonterminal the least (cost, audit), or None

_STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


# -- the grammar -----------------------------------------------------------------------


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out: Cell = [None] * len(PAIRS)
    for i, j, k in RULES:
        a, b, best = left[j], right[k], out[i]
        if a is None or b is None:
            continue
        cost = a[0] + b[0]
        if best is None or cost < best[0] or (cost == best[0] and a[1] + b[1] < best[1]):
            out[i] = (cost, a[1] + b[1])
    return out


def _closure() -> Cell:
    """The cell of no rows: insertions only."""
    cell: Cell = [(0, "") if p == q else None for p, q in PAIRS]
    for (p, symbol), q in STEPS.items():
        if symbol in NAMES:
            cell[PLACE[p, q]] = (INSERT, "I")
    while (wider := combine(cell, cell)) != cell:
        cell = wider
    return cell


CLOSURE = _closure()
_cells: dict[tuple[str, int], Cell] = {}


def row_cell(initial: str, fault: int) -> Cell:
    """The cell of one row: insertions before it, then its own edit."""
    known = initial if initial in ("s", "u", "a") else ""
    if (known, fault) not in _cells:
        cell: Cell = [(DELETE, "D") if p == q else None for p, q in PAIRS]
        if fault not in (BLANK, DUPLICATE):
            more = CUT_OFF if fault == TRUNCATED else 0
            for (p, symbol), q in STEPS.items():
                edits = [(more, "K")] if symbol == known else [(REROLE + more, "R")] if symbol in NAMES else []
                cell[PLACE[p, q]] = min([*edits, *filter(None, [cell[PLACE[p, q]]])], default=None)
        _cells[known, fault] = combine(CLOSURE, cell)
    return _cells[known, fault]


def span_cell(cells: list[Cell]) -> Cell:
    """The cell of all rows, combined bottom-up by span length."""
    cells = cells or [[(0, "") if p == q else None for p, q in PAIRS]]
    while len(cells) > 1:
        paired = [combine(a, b) for a, b in zip(cells[::2], cells[1::2], strict=False)]
        cells = paired + cells[len(paired) * 2 :]
    return cells[0]


def cheapest(cell: Cell) -> tuple[int, str]:
    """The least (cost, audit) of a whole conversation."""
    ended = combine(cell, CLOSURE)
    return min(ended[PLACE[START, q]] for q in FINAL if ended[PLACE[START, q]] is not None)


def applied(rows: Iterable[tuple[str, str]], audit: str, state: int = START) -> Iterator[tuple[str, str, str]]:
    """``(role, text, edit)`` of the turns that ``audit`` makes of ``(role, text)`` rows, from a state on."""
    rows = iter(rows)
    for edit in audit:
        if edit == "D":
            next(rows)
            continue
        role, text = ("", "") if edit == "I" else next(rows)
        symbol = role[:1] if edit == "K" else "a" if state == USER else "u"
        yield role if edit == "K" else NAMES[symbol], text, edit
        state = STEPS[state, symbol]


def state_after(audit: str, initials: Iterable[str], state: int) -> int:
    for role, _, _ in applied(((initial, "") for initial in initials), audit, state):
        state = STEPS[state, role[:1]]
    return state


# -- rows ------------------------------------------------------------------------------


def own_fault(text: str) -> int:
    """What a text shows by itself."""
    stripped = text.rstrip(BLANKS)
    return BLANK if not stripped else FINE if stripped[-1] in ENDS else TRUNCATED


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def _gaps(turns: Iterable[int | None]) -> int:
    known = {turn for turn in turns if turn is not None}
    return max(known) - min(known) + 1 - len(known) if known else 0


def _digest(turns: Iterable[tuple[str, str, str]]) -> str:
    whole = hashlib.sha256()
    for n, (role, text, _) in enumerate(turns):
        whole.update(f"{'\n' if n else ''}{role}:{text}".encode())
    return whole.hexdigest()


def _repaired_here(rows: list[tuple], as_turns: bool) -> list[tuple]:
    """The output rows of a conversation ``(turn, role, text)`` that lies in one task."""
    faults, seen = [], set()
    for _, role, text in rows:
        fault = own_fault(text)
        faults.append(DUPLICATE if fault != BLANK and (role, text) in seen else fault)
        seen.add((role, text))
    initials = [role[:1] for _, role, _ in rows]
    cost, audit = cheapest(span_cell([row_cell(i, f) for i, f in zip(initials, faults, strict=True)]))
    turns = applied(((role, text) for _, role, text in rows), audit)
    if as_turns:
        return [(None, n, *turn) for n, turn in enumerate(turns)]
    counts = [faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)]
    return [(None, _gaps(r[0] for r in rows), *counts, _illegal(initials), cost, audit, _digest(turns))]


def _sorted_runs(schema: pa.Schema, as_turns: bool):
    """A task's function over rows sorted by conversation and turn.

    The first and the last conversation of a task may go on in its neighbours: their rows come
    out as they are, with the task's number and their place in it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment = TaskContext.get().partitionId()
        held: list[tuple] = []
        conv, first, at, out, size = None, True, 0, [], 0
        width = len(schema.names)

        def as_batch() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, schema.types, strict=True)], names=schema.names
            )

        def edge(rows: list[tuple], begin: int) -> None:
            for n, (turn, role, text) in enumerate(rows):
                out.append((conv, segment, begin + n, turn, role, text, *[None] * (width - 6)))

        def close() -> None:
            turns = [row for row in held if row[1] is not None]
            for row in _repaired_here(turns, as_turns):
                out.append((conv, None, None, None, None, None, *row[1:]))

        begin = 0
        started = False
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("conv_id", "turn", "role", "text")]
            for now, *row in zip(*columns, strict=True):
                if started and now != conv:
                    if first:
                        edge(held, begin)
                    else:
                        close()
                    first, held, begin = False, [], at
                conv, started = now, True
                held.append(tuple(row))
                size += 40 + len(row[2] or "")
                at += 1
                if first and len(held) >= 4096:  # an edge for sure: nothing to wait for
                    edge(held, begin)
                    held, begin = [], at
                if size > 4 << 20 and out:
                    yield as_batch()
                    out, size = [], 0
        if started:
            edge(held, begin)
        if out:
            yield as_batch()

    return run


# -- conversations at the edges of tasks -----------------------------------------------


def _segment_cell(group: pa.Table) -> pa.Table:
    """One row for a task's stretch of a conversation."""
    group = group.sort_by("at")
    initials = [role[:1] for role in group["role"].to_pylist()]
    faults = group["fault"].to_pylist()
    cell = span_cell([row_cell(i, f) for i, f in zip(initials, faults, strict=True)])
    return pa.table(
        {
            "conv_id": group["conv_id"][:1],
            "segment": group["segment"][:1],
            "initials": pa.array(["".join(i or " " for i in initials)]),
            "blank": pa.array([faults.count(BLANK)], pa.int64()),
            "duplicate": pa.array([faults.count(DUPLICATE)], pa.int64()),
            "truncated": pa.array([faults.count(TRUNCATED)], pa.int64()),
            "costs": pa.array([[c and c[0] for c in cell]], pa.list_(pa.int64())),
            "audits": pa.array([[c and c[1] for c in cell]], pa.list_(pa.string())),
        }
    )


def _whole(group: pa.Table) -> pa.Table:
    """A conversation from its stretches: its own row, and every stretch's part of the audit."""
    group = group.sort_by("segment")
    parts = group.to_pylist()
    initials = "".join(part["initials"] for part in parts)
    best: dict[int, tuple] = {START: (0, "", [])}
    for part in [*parts, None]:
        cell = CLOSURE if part is None else list(zip(part["costs"], part["audits"], strict=True))
        ahead: dict[int, tuple] = {}
        for p, (cost, audit, lengths) in best.items():
            for q in range(4):
                got = cell[PLACE[p, q]] if (p, q) in PLACE else None
                if got is None or got[0] is None:
                    continue
                new = (cost + got[0], audit + got[1], [*lengths, len(got[1])])
                if q not in ahead or new[:2] < ahead[q][:2]:
                    ahead[q] = new
        best = ahead
    cost, audit, lengths = min((best[q] for q in FINAL if q in best), key=lambda found: found[:2])
    # The last insertions belong to the last stretch.
    lengths = [*lengths[:-2], lengths[-2] + lengths[-1]] if len(lengths) > 1 else lengths
    sums = [sum(part[name] for part in parts) for name in ("blank", "duplicate", "truncated")]
    rows = [(parts[0]["conv_id"], None, None, None, None, *sums, _illegal(list(initials)), cost, audit)]
    state, done, place = START, 0, 0
    for part, length in zip(parts, lengths, strict=True):
        own = audit[done : done + length]
        rows.append((part["conv_id"], part["segment"], own, state, place, *[None] * 6))
        state = state_after(own, part["initials"], state)
        done, place = done + length, place + length - own.count("D")
    names = ["conv_id", "segment", "own", "state", "place", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    kinds = [group.schema.field("conv_id").type, pa.int32(), pa.string(), pa.int32(), *[pa.int64()] * 6, pa.string()]
    columns = zip(*rows, strict=True)
    return pa.table({n: pa.array(c, kind) for n, c, kind in zip(names, columns, kinds, strict=True)})


def _edited(rows: pa.Table, audits: pa.Table) -> pa.Table:
    """The repaired turns of a task's stretch of a conversation."""
    part = audits.to_pylist()[0]
    rows = rows.sort_by("at") if rows.num_rows else rows
    turns = zip(rows["role"].to_pylist(), rows["text"].to_pylist(), strict=True)
    made = list(applied(turns, part["own"], part["state"]))
    return pa.table(
        {
            "conv_id": pa.array([part["conv_id"]] * len(made), audits.schema.field("conv_id").type),
            "place": pa.array([part["place"] + n for n in range(len(made))], pa.int64()),
            "role": pa.array([m[0] for m in made], pa.string()),
            "text": pa.array([m[1] for m in made], pa.string()),
            "edit": pa.array([m[2] for m in made], pa.string()),
        }
    )


def _streamed_digests(kind: pa.DataType):
    """One digest a conversation, from repaired turns sorted by conversation and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, whole = None, None

        def out() -> pa.RecordBatch:
            columns = [pa.array([conv], kind), pa.array([whole.hexdigest()], pa.string())]
            return pa.RecordBatch.from_arrays(columns, names=["conv_id", "repaired_sha256"])

        for batch in batches:
            for now, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text")), strict=True):
                if whole is None or now != conv:
                    if whole is not None:
                        yield out()
                    conv, whole = now, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    whole.update(f"\n{role}:{text}".encode())
        if whole is not None:
            yield out()

    return run


def _at_edges(scratch: Scratch, split: DataFrame, kind: pa.DataType, as_turns: bool) -> DataFrame:
    conv = split.schema["conv_id"].dataType.simpleString()
    edges = split.where("segment is not null")
    rows = edges.where("role is not null").select("conv_id", "segment", "at", "turn", "role", "text")
    key = ["conv_id", "role", "digest"]
    told = rows.withColumn("digest", F.sha2("text", 256)).withColumn("own", _own_fault())
    firsts = told.groupBy(*key).agg(F.min(F.struct("segment", "at")).alias("first"))
    firsts = firsts.toDF("first_conv", "first_role", "first_digest", "first")
    same = F.col("conv_id").eqNullSafe(F.col("first_conv")) & (F.col("role") == F.col("first_role"))
    flagged = told.join(firsts, same & (F.col("digest") == F.col("first_digest")))
    repeated = (F.struct("segment", "at") != F.col("first")) & (F.col("own") != BLANK)
    flagged = flagged.select(
        "conv_id", "segment", "at", "role", F.when(repeated, DUPLICATE).otherwise(F.col("own")).alias("fault")
    )
    cell = f"conv_id {conv}, segment int, initials string, blank long, duplicate long, truncated long, costs array<long>, audits array<string>"
    cells = flagged.groupBy("conv_id", "segment").applyInArrow(_segment_cell, cell)
    whole = f"conv_id {conv}, segment int, own string, state int, place long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    found = scratch.write(cells.groupBy("conv_id").applyInArrow(_whole, whole)).df
    audits = found.where("segment is not null").select("conv_id", "segment", "own", "state", "place")
    turns = (
        rows.groupBy("conv_id", "segment")
        .cogroup(audits.groupBy("conv_id", "segment"))
        .applyInArrow(_edited, f"conv_id {conv}, place long, role string, text string, edit string")
    )
    if as_turns:
        return turns
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    digests = ordered.mapInArrow(_streamed_digests(kind), f"conv_id {conv}, repaired_sha256 string")
    gaps = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    turned = rows.groupBy("conv_id").agg(F.coalesce(gaps, F.lit(0)).alias("gaps"))
    report = edges.select("conv_id").distinct()
    for part in (turned, found.where("segment is null").drop("segment", "own", "state", "place"), digests):
        part = part.withColumnRenamed("conv_id", "_conv")
        report = report.join(part, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    zero = {name: F.coalesce(F.col(name), F.lit(0).cast("long")) for name in REPORT[:6]}
    empty = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    return report.select(
        "conv_id",
        *[column.alias(name) for name, column in zero.items()],
        *[F.coalesce(F.col(name), other).alias(name) for name, other in empty.items()],
    )


def _own_fault():
    blank = r"[\x20\x09-\x0D]*"
    return (
        F.when(F.col("text").rlike(rf"\A{blank}\z"), BLANK)
        .when(F.col("text").rlike(rf"[.!?]{blank}\z"), FINE)
        .otherwise(TRUNCATED)
    )


# -- the operator ----------------------------------------------------------------------


def _repaired(turns: DataFrame, as_turns: bool) -> DataFrame:
    named_only = F.col("role").isNull() & F.col("text").isNull()
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(~named_only, F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(~named_only, F.coalesce("text", F.lit(" "))).alias("text"),
    )
    order = [F.col(name).asc_nulls_first() for name in ("conv_id", "turn", "role", "text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    conv = turns.schema["conv_id"].dataType.simpleString()
    lead = f"conv_id {conv}, segment int, at long, turn long, role string, text string, "
    schema = lead + ("place long, new_role string, new_text string, edit string" if as_turns else _STATS + ", repaired_sha256 string")
    empty = turns.sparkSession.createDataFrame([], schema)
    kinds = empty.toArrow().schema
    scratch = Scratch(turns.sparkSession, "conversations")
    split = scratch.write(rows.mapInArrow(_sorted_runs(kinds, as_turns), schema), edges=F.count("segment"))
    inside = split.df.where("segment is null")
    if as_turns:
        inside = inside.select("conv_id", "place", F.col("new_role").alias("role"), F.col("new_text").alias("text"), "edit")
    else:
        inside = inside.select("conv_id", *REPORT)
    return inside.unionByName(_at_edges(scratch, split.df, kinds.types[0], as_turns)) if split.counts["edges"] else inside


def repaired_turns(turns: DataFrame) -> DataFrame:
    """``(conv_id, place, role, text, edit)``: the turns of every repaired conversation, from place 0.

    ``turns(conv_id, turn, role, text)`` are taken by turn, NULL first; ties by role and text. A NULL
    conversation is one as well; a NULL role or text alone counts as a space. A row with neither
    is no turn and only names its conversation. Repeated rows are duplicates; other columns are not
    read; an empty table, and a conversation without turns, gives no rows. A role of no
    letter ``s``, ``u`` or ``a`` in front cannot be kept.

    ``edit`` is K (kept), R (new role) or I (inserted, with an empty text); deleted turns have no row.
    Edits are the cheapest that give ``(s?(ua)+)?``: 1 for a new role, 2 to delete, 5 to insert, and 5 for
    a text kept that ends without one of ``.!?``; blank and repeated turns must go. Ties take the
    least sequence of initials, where deleting, inserting, keeping and re-roling are D, I, K, R.
    """
    return _repaired(turns, as_turns=True)


def conversation_repairs(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns``: its faults, its repair's cost, edits and SHA-256.

    ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``; the repair and
    odd rows are those of :func:`repaired_turns`, whose ``role:text`` lines the digest is of. ``gaps`` are
    turn numbers missing between the first and the last. A row counts with its first fault; ``illegal`` are
    neighbours whose roles cannot follow one another. A conversation without turns has zeros, an
    empty audit and the digest of nothing; an empty table gives no rows.

    The audit has a letter per turn, so a conversation must fit a value by definition; its SHA-256 is taken
    by one task in order, which holds one turn at a time.
    """
    return _repaired(turns, as_turns=False)


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns of ``conversations`` with faults put in by the CRC-32 of ``conv_id:turn``; NULLs are spaces.

    Of 20 remainders 0 drops the turn, 1 empties its text, 2 removes its ``.!?``, 3 repeats it and 4 makes
    its role ``user``. A dropped turn stays as a row that names its conversation only.
    """
    space = F.lit(" ")
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    )
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(name), space) for name in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text)
    there = kind != 0
    return conversations.select(
        "conv_id",
        "turn",
        F.when(there, F.when(kind == 4, "user").otherwise(role)).alias("role"),
        F.when(there, text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
