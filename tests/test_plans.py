"""What the plans must look like, and what is left on disk."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from cofi.operators.pairs import co_rated_pairs
from cofi.plans.catalog import QUERIES, Fixture
from cofi.session import materialize, table_path, table_scope

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pair_join_is_split_when_skewed(spark):
    """One item holds most ratings: adaptive execution splits the pair join's partition."""
    df = materialize(spark.range(6000).select(
        F.col("id").alias("user_id"), F.when(F.col("id") % 10 < 7, 0).otherwise(F.col("id") % 50).alias("item_id"),
        F.lit(1.0).alias("x")), "skewed")
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.shuffle.partitions": "8",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = co_rated_pairs(df, ["item_id"], "x", block_rows=5000).groupBy("u", "v").agg(F.sum("a").alias("s"))
        counted = out.agg(F.count(F.lit(1)))
        counted.collect()
        assert "SortMergeJoin(skew=true)" in plan(counted)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_requests_reach_the_scan(spark):
    for name, needle in (("user_avg_point", "EqualTo(o_custkey,1)"), ("item_avg_point", "EqualTo(l_partkey,1)"),
                         ("sim_cosine_pair", "In(user_id, [1,2])")):
        assert needle in plan(QUERIES[name](spark, SF)), name


def test_building_a_query_of_one_branch_writes_nothing(spark):
    root = os.path.dirname(table_path(spark, "probe").replace("file:", ""))
    before = set(os.listdir(root))
    for name in ("global_avg", "user_avg", "item_avg", "user_avg_point", "norm_dev", "item_raters", "unseen_items"):
        QUERIES[name](spark, SF)
    Fixture(spark, SF, "o", shared=True)
    assert set(os.listdir(root)) == before


def test_no_cross_join(spark):
    with table_scope(spark):
        for name in ("recommend_all", "mae_by_replication", "knn_graph", "pred_cosine"):
            text = plan(QUERIES[name](spark, SF))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_tables_are_released(spark, tmp_path):
    with table_scope(spark):
        materialize(spark.range(3), "kept_inside")
        path = table_path(spark, "probe").replace("file:", "")
        inside = os.listdir(os.path.dirname(path))
        assert any(x.startswith("kept_inside") for x in inside)
    assert not any(x.startswith("kept_inside") for x in os.listdir(os.path.dirname(path)))
    code = ("from cofi.session import build_session, materialize\n"
            f"s = build_session('local[1]', 1, extra={{'spark.checkpoint.dir': '{tmp_path}'}})\n"
            "materialize(s.range(5), 'left')\ns.stop()\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120, capture_output=True)
    left = [f for d, _, names in os.walk(tmp_path) for f in names]
    assert left == []
