"""Edges next to changed vertices are found in one pass over the edges."""

from rootwise.operators.propagate import _touched
from rootwise.scratch import Scratch


def test_touched_edges_in_one_pass(spark):
    rows = [(1, 2), (2, 1), (1, 1), (1, 2), (3, 4), (4, 1), (5, 6)]
    links = Scratch(spark, "touched").write(spark.createDataFrame(rows, "src_id long, dst_id long")).df
    touched = _touched(links, spark.createDataFrame([(1,), (3,)], "id long"))
    assert sorted(map(tuple, touched.collect())) == sorted(row for row in rows if {1, 3} & set(row))
    plan = touched._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [src_id") == 1, plan
