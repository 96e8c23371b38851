"""Vertex programs: how many older states a round reads, and the same results however states are kept."""

import random

import pytest
from pyspark.sql import functions as F

from rootwise.operators import propagate as propagate_module
from rootwise.operators.propagate import propagate
from rootwise.scratch import Scratch


def test_states_do_not_pile_up(spark, monkeypatch):
    """All vertices change in each of ten rounds: no round reads more than the last states of each."""
    n, read = 40, []
    scan = Scratch.scan
    monkeypatch.setattr(Scratch, "scan", lambda self, tables: read.append(sum(t.rows for t in tables)) or scan(self, tables))
    found = propagate(
        spark.range(n),
        spark.range(n).select(F.col("id").alias("src"), ((F.col("id") + 1) % n).alias("dst")),
        state={"turns": F.lit(0)},
        message={"one": F.lit(1)},
        merge={"one": F.sum},
        update={"turns": F.col("old.turns") + F.col("msg.one")},
        send_if=F.col("src.turns") < 10,
    )
    assert {(r.id, r.turns) for r in found.collect()} == {(i, 10) for i in range(n)}
    assert max(read, default=0) <= n + n // propagate_module.WHOLE


@pytest.mark.parametrize("whole", [0, 8])
@pytest.mark.parametrize("active", ["out", "any"])
def test_any_share_of_changes(spark, monkeypatch, whole, active):
    """Least distances along weighted edges, some parallel, some loops, some to ids that are no vertices."""
    monkeypatch.setattr(propagate_module, "WHOLE", whole, raising=False)
    draw = random.Random(5)
    n = 30
    edges = [(draw.randrange(n), draw.randrange(n + 3), float(draw.randint(1, 9))) for _ in range(60)]
    edges += [(0, 1, 2.0), (0, 1, 3.0), (4, 4, 1.0)]
    far = F.col("src.far") + F.col("edge.weight")
    found = propagate(
        spark.range(n),
        spark.createDataFrame(edges, "src long, dst long, weight double"),
        state={"far": F.when(F.col("id") == 0, 0.0), "heard": F.lit("never")},
        message={"far": far},
        merge={"far": F.min},
        update={"far": F.least("old.far", "msg.far"), "heard": F.lit("once")},
        send_if=far.isNotNull() & (F.col("dst.far").isNull() | (far < F.col("dst.far"))),
        reads_target=True,
        active=active,
    )
    want = {0: 0.0}
    for _ in range(n):
        for src, dst, weight in edges:
            if src in want and dst < n:
                want[dst] = min(want.get(dst, float("inf")), want[src] + weight)
    got = {r.id: r for r in found.collect()}
    assert {i: r.far for i, r in got.items()} == {i: want.get(i) for i in range(n)}
    assert all((r.heard == "once") == (i in want and i != 0) for i, r in got.items())
