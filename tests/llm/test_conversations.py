"""Conversation repair against a search that knows nothing of spans."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from rootwise.llm.conversations import conversation_repairs, damaged, repaired_turns

BLANK = re.compile(r"[\x20\x09-\x0D]*")
GOOD, BEGUN = re.compile(r"(s?(ua)+)?"), re.compile(r"s?(ua)*u?")
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.fixture
def many_tasks(spark):
    """Range partitions stay as they are, so that conversations are cut by them."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield spark
    spark.conf.unset(name)


def cheapest(rows):
    """The least (cost, audit) for ``(initial, fault)`` rows by best-first search over whole edit sequences."""
    queue = [(0, "", 0, "", ())]
    done = set()
    while True:
        cost, audit, at, roles, made = heapq.heappop(queue)
        if at == len(rows) and GOOD.fullmatch(roles):
            return cost, audit, made
        if (at, roles[-2:], bool(roles)) in done:
            continue
        done.add((at, roles[-2:], bool(roles)))
        steps = [(5, "I", at, symbol) for symbol in "ua"]
        if at < len(rows):
            initial, fault = rows[at]
            steps.append((2, "D", at + 1, ""))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                steps += [(more, "K", at + 1, initial)] if initial in ("s", "u", "a") else []
                steps += [(1 + more, "R", at + 1, symbol) for symbol in "ua"]
        for price, edit, to, symbol in steps:
            if BEGUN.fullmatch(roles + symbol):
                heapq.heappush(queue, (cost + price, audit + edit, to, roles + symbol, (*made, (edit, symbol))))


def report(rows):
    """The report of one conversation of ``(turn, role, text)`` rows, and its repaired turns."""
    rows = [(t, *(" " if x is None else x for x in rt)) for t, *rt in rows if rt != [None, None]]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, faults = set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        fault = "blank" if BLANK.fullmatch(text) else "duplicate" if (role, text) in seen else ""
        faults.append(fault or ("" if body[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    cost, audit, made = cheapest(list(zip(initials, faults, strict=True)))
    left, out = list(rows), []
    for edit, symbol in made:
        row = None if edit == "I" else left.pop(0)
        if edit != "D":
            role = row[1] if edit == "K" else {"u": "user", "a": "assistant"}[symbol]
            out.append((role, row[2] if row else "", edit))
    turns = {r[0] for r in rows if r[0] is not None}
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        *(faults.count(name) for name in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{role}:{text}" for role, text, _ in out).encode()).hexdigest(),
    ), out


def check(turns):
    groups = {}
    for conv, *row in map(tuple, turns.select("conv_id", "turn", "role", "text").collect()):
        groups.setdefault(conv, []).append(row)
    want = {conv: report(rows) for conv, rows in groups.items()}
    got = conversation_repairs(turns).collect()
    assert len(got) == len(want)
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == {conv: w[0] for conv, w in want.items()}
    places = sorted((str(r["conv_id"]), r["place"], r["role"], r["text"], r["edit"]) for r in repaired_turns(turns).collect())
    assert places == sorted((str(c), n, *turn) for c, (_, out) in want.items() for n, turn in enumerate(out))


ODD = [
    (1, 0, "system", "Rules."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Yes."),
    (2, None, "user", "No turn."), (2, None, None, "No role."), (2, 5, "assistant", None), (2, 9, None, None),
    (3, 1, "", "."), (3, 1, "tool", "x."), (3, 1, "tool", "x."), (None, 4, "user", "a"), (None, 7, "assistant", "b!"),
    (4, None, None, None), (5, 0, "assistant", " \t\x0b"), (6, 0, "system", "Only rules."), (7, 0, "User", "É?\n"),
    (8, 3, "user", "word " * 20_000 + "."), (8, 2, "assistant", "z" * 70_000), (9, -5, "sudo", "!"), (9, 5, "under", "a. "),
]


def test_odd_rows(spark):
    rows = [(*row, "clash", 7) for row in [*ODD, *ODD[:3]]]
    check(spark.createDataFrame(rows, SCHEMA + ", audit string, segment long"))


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversation_repairs(empty).count() == repaired_turns(empty).count() == 0
    assert conversation_repairs(damaged(empty)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_random_conversations(many_tasks, seed):
    draw = random.Random(seed)
    texts = ["a.", "b!", "c", " ", "d?", ""]
    rows = []
    for conv in range(150):
        for turn in range(draw.randint(1, 9)):
            role = draw.choice(["system", "user", "assistant", "user", "assistant", "tool"])
            rows.append((conv, draw.choice([turn, turn, None]), role, draw.choice(texts) + draw.choice(["", str(turn) + "."])))
    check(many_tasks.createDataFrame(rows, SCHEMA).repartition(5))


def test_one_conversation_in_many_tasks(many_tasks):
    draw = random.Random(9)
    rows = [(n % 40, n, "user", f"{n}.") for n in range(100)]
    rows += [(17, n // 2, draw.choice(["system", "user", "assistant"]), draw.choice(["same.", f"{n}.", f"{n}", ""])) for n in range(1500)]
    turns = many_tasks.createDataFrame(rows, SCHEMA)
    check(turns)
    place = F.spark_partition_id()
    spread = turns.repartitionByRange("conv_id", "turn", "role", "text").where("conv_id = 17").select(place).distinct()
    assert spread.count() > 4  # so it was cut


def test_damage(spark):
    rows = [(c, t, "assistant", f"One. Two! Three? {c}") for c in range(60) for t in range(3)] + [(None, None, None, None)]
    want = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (conv, turn, None, None) if kind == 0 else (conv, turn, "user" if kind == 4 else role, text)
        want += [row] * (2 if kind == 3 else 1)
    got = damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
