"""What the plans look like: no hidden cross joins, splittable hot keys, pruned scans."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from sparkloom.operators import graph, topk
from sparkloom.operators.graph import coloring
from sparkloom.operators.graph.changes import _alive_before
from sparkloom.operators.joins import join_group_rows
from sparkloom.plans import catalog
from sparkloom.scratch import Scratch, shared_folder

SMALL = "/root/testdata/sf0.001"
ITERATIVE = {"graph_color", "graph_color_count", "graph_color_histogram", "graph_color_rounds", "graph_recolor"}


@pytest.fixture
def settings(spark):
    before = {}

    def change(**values):
        for name, value in values.items():
            name = "spark.sql." + name.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield change
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return physical(df).split("+- == Initial Plan ==")[0]


@pytest.mark.parametrize("key", sorted(set(catalog.queries()) - ITERATIVE))
def test_plans_have_no_cross_join_or_python(spark, key):
    plan = physical(entry_module.queries()[key](spark, SMALL))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas|Arrow", plan)


def test_hot_key_is_split(spark, settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    # A third of the rows share one key.
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    groups = rows.groupBy("k").agg(F.count("*").alias("n"))
    joined = join_group_rows(rows, groups, "k")
    result = joined.agg(F.count("*").alias("n"), F.countDistinct("payload").alias("p"))
    plan = final_plan(result)
    assert result.first()["n"] == 200_000
    assert "skew=true" in plan


def test_rounds_do_not_move_edges(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    scratch = Scratch(spark, "plan_test")
    _, half = graph.generate_graph(spark, 500, 8)
    state = scratch.write(
        spark.range(500).select(
            "id",
            F.lit(8).cast("long").alias("degree"),
            F.array().cast("array<int>").alias("used"),
            F.lit(None).cast("int").alias("color"),
        ),
        "state",
    )
    for slot_edges, largest in ((10**6, 8), (3, 8)):
        edges = coloring._Edges(scratch, slot_edges)
        edges.version = largest * slot_edges
        edges.store(half, state, 10, largest)
        plan = final_plan(coloring._round(state, edges))
        # The edge scan keeps its buckets: nothing shuffles between it and the join.
        assert plan.count("Bucketed: true") >= 1
        for block in re.findall(r"((?:.*\n){6}).*Bucketed: true", plan):
            tail = block.splitlines()[-3:]
            assert not any("Exchange" in line for line in tail)
        assert "ReusedExchange" in plan
        edges.close()


def test_top_values_rank_per_task_first(spark):
    plan = physical(entry_module.queries()["profile_top_values"](spark, SMALL))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_k_is_not_a_sort(spark):
    plan = physical(topk.top_k(spark.range(100), [F.desc("id")], 3, []))
    assert "TakeOrderedAndProject" in plan


@pytest.mark.parametrize(
    "key,scans", [("collab_boost", 2), ("entity_diversity", 2), ("topk_vs_group", 2), ("flag_impact", 1), ("sweetspot_best", 1), ("breakthrough_gap", 1)]
)
def test_table_is_scanned_as_often_as_needed(spark, key, scans):
    plan = final_plan(entry_module.queries()[key](spark, SMALL))
    found = len(re.findall(r"FileScan parquet \[[^\]]*l_partkey", plan))
    assert found == scans


def test_scan_is_pruned(spark):
    plan = physical(entry_module.queries()["flag_impact"](spark, SMALL))
    schema = re.search(r"FileScan parquet \[([^\]]*l_partkey[^\]]*)\]", plan).group(1)
    assert {c.split("#")[0] for c in schema.split(",")} == {"l_partkey", "l_quantity", "l_returnflag"}


def test_block_size_does_not_matter(spark):
    events = [(i % 3, i, i % 7 < 4) for i in range(0, 300, 2)]
    asked = [(i % 3, i) for i in range(1, 300, 2)]
    e = spark.createDataFrame(events, "id long, seq long, alive boolean")
    a = spark.createDataFrame(asked, "id long, seq long")
    want = {}
    for i, seq in asked:
        earlier = [x for x in events if x[0] == i and x[1] < seq]
        want[i, seq] = max(earlier, key=lambda x: x[1])[2] if earlier else None
    for block in (5, 64, 10**6):
        got = {(r["id"], r["seq"]): r["alive"] for r in _alive_before(a, e, block).collect()}
        assert got == want


class FakeSession:
    """Stands in for a session whose checkpoint folder is, or is not, set."""

    def __init__(self, setting=None, context_folder=None, master="yarn"):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = self
        self.folder, self.master = context_folder, master

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = "file:" + folder


def test_shared_folder():
    assert shared_folder(FakeSession("hdfs://all/x/", "hdfs://other")) == "hdfs://all/x"
    assert shared_folder(FakeSession(None, "hdfs://other")) == "hdfs://other"
    with pytest.raises(ValueError):
        shared_folder(FakeSession())
    local = FakeSession(master="local[4]")
    assert shared_folder(local) == shared_folder(local) == local.folder
