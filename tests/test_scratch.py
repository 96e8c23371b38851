"""Round tables: where they lie, and what is left of them after a run."""

import random

from pyspark.sql import functions as F

from rootwise.operators.build import formula_graph
from rootwise.operators.evaluate import evaluate_formulas
from rootwise.operators.peel import _round
from rootwise.operators.spread import HOPS, _hops, spread_min
from rootwise.scratch import Scratch, _session_dir, _table_prefix, shared_dir


def tables(scratch):
    """Folders of written tables below a scratch folder."""
    jvm = scratch.spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch.path)
    system = path.getFileSystem(scratch.spark.sparkContext._jsc.hadoopConfiguration())
    return {status.getPath().getName() for status in system.listStatus(path)}


def test_superseded_tables_are_deleted(spark, monkeypatch):
    monkeypatch.setattr("rootwise.operators.spread.MERGE_EVERY", 3)
    scratch = Scratch(spark, "test-spread")
    links = [(n, n + 1) for n in range(12)]
    edges = scratch.write(spark.createDataFrame(links, "src long, dst long"))
    seeds = spark.createDataFrame([(0, 0)], "id long, val int")
    found = spread_min(scratch, edges.df, seeds, "val + 1")
    assert {(r.id, r.val) for r in found.collect()} == {(n, n) for n in range(13)}
    read = {path.split("/")[-2] for path in found.inputFiles()}
    # The result's tables are left: up to three rounds, their merged predecessors, one without rows.
    left = tables(scratch) - {edges.path.rsplit("/", 1)[1]}
    assert read <= left and len(left) <= 4, (read, left)


def test_only_the_own_application_is_cleared(spark):
    scratch = Scratch(spark, "test-clear")
    assert scratch.path.startswith(_session_dir(spark)) and _session_dir(spark).startswith(shared_dir(spark))
    other = f"{shared_dir(spark)}/rootwise/another-application/table"
    spark.range(3).write.mode("overwrite").parquet(other)
    before = _session_dir(spark)
    spark_sc = spark.sparkContext
    assert spark_sc.applicationId in before
    assert spark.read.parquet(other).count() == 3


def test_a_chain_of_formulas(spark, monkeypatch):
    """A chain of 2,000: depths by doubling, values in one block; as many tables as the length has digits, and some."""
    n = 2000
    rows = [("v0", "v0", "1", 0)] + [(f"v{k}", "", f"item(v{k - 1}) + 1", 0) for k in range(1, n)]
    random.Random(4).shuffle(rows)
    table = spark.createDataFrame(rows, "id string, name string, formula string, value int")
    written = []
    write = Scratch._next_path
    monkeypatch.setattr(Scratch, "_next_path", lambda self: written.append(self.path) or write(self))
    values = evaluate_formulas(formula_graph(table))
    assert len(written) < 30, len(written)
    assert sum("evaluate" in path for path in written) == len(written) - 1
    got = {r.id: (r.depth, r.value, r.formula) for r in values.where(F.col("id") != "r00t").collect()}
    assert got == {f"v{k}": (k + 1, k + 1.0, f"{k} + 1" if k else "1") for k in range(n)}


def above_scans(df):
    """For every read of a bucketed table, the operators between it and the join above."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    found = []
    for n, line in enumerate(lines):
        if "FileScan" in line and "Bucketed: true" in line:
            above, at = [], depth[n]
            for m in range(n - 1, -1, -1):
                if depth[m] < at:
                    above.append(lines[m].lstrip(" :+-").split()[0])
                    at = depth[m]
                    if "Join" in above[-1]:
                        break
            found.append(above)
    return found


def test_no_round_shuffles_the_edges(spark):
    """Rounds too large for a broadcast read bucketed edges where they lie, on every hop."""
    scratch = Scratch(spark, "test-buckets")
    links = spark.range(1000).selectExpr("id AS src", "(id * 7 + 1) % 1000 AS dst", "1 AS steps", "cast(1 AS long) AS need")
    edges = scratch.write_bucketed(links, "src")
    assert edges.rows == edges.df.count() == 1000
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hops = _hops(edges.df.select("src", "dst"), scratch.write(spark.range(300).selectExpr("id", "0 AS val")).df, "val + 1", ())
        peeled = _round(edges.df, scratch.write(spark.range(300).selectExpr("id", "0 AS depth")).df, None, None)
        for plan, reads in ((hops, HOPS * (HOPS + 1) // 2), (peeled, 1)):
            found = above_scans(plan)
            assert len(found) == reads
            assert not [above for above in found if any("Exchange" in name for name in above)], found
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert {r.val for r in hops.collect()} <= {1, 2, 3}
    scratch.drop(edges)
    assert not [t for t in spark.catalog.listTables() if t.name == edges.name]
    assert edges.name.startswith(_table_prefix(spark))
