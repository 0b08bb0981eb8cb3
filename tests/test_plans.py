"""Physical plan shape: shuffles, pushdown, pruning, broadcast, partial aggregation."""

import re

import __spark_entry__ as entry

Q = entry.queries()


def explain(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def main_tree(plan: str) -> str:
    """The operator tree of the main query (before the numbered details)."""
    return plan.split("\n\n")[0]


def test_rolling_uses_two_shuffles_and_prunes_columns(spark, sf_dir):
    plan = explain(Q["rolling_performance"](spark, sf_dir))
    tree = main_tree(plan)
    shuffles = re.findall(r"(?<!Broadcast)Exchange \(", tree)
    assert len(shuffles) == 2, tree                   # (symbol, day) for bars, symbol for both windows
    assert tree.count("Window") == 2, tree            # lag, then all rolling expressions in one operator
    assert "BroadcastHashJoin" in tree                # asset dimension, size checked
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    orders = [s for s in schemas if "o_orderdate" in s and "o_orderpriority" in s]
    assert orders and all("o_custkey" not in s and "o_orderstatus" not in s for s in orders)


def test_relative_broadcasts_benchmark_series(spark, sf_dir):
    tree = main_tree(explain(Q["relative_performance"](spark, sf_dir)))
    assert "BroadcastHashJoin Inner BuildRight" in tree
    assert "SortMergeJoin" not in tree


def test_filters_reach_the_scan(spark, sf_dir):
    plan = explain(Q["qc_accepted_values"](spark, sf_dir))
    pushed = re.findall(r"PushedFilters: \[(.*)\]", plan)
    assert any("o_orderstatus" in p for p in pushed), pushed
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_dedupe_aggregates_partially_before_shuffle(spark, sf_dir):
    plan = explain(Q["dedupe_latest"](spark, sf_dir))
    assert "partial_max" in plan
    assert "row_number" not in plan.lower()


def test_rank_is_not_a_single_partition_window_over_the_rows(spark, sf_dir):
    from pyspark.sql import functions as F

    from tidemark.functions.ranking import global_rank

    df = spark.range(0, 5000).select((F.col("id") % 997).alias("k"), F.col("id"))
    ranked = global_rank(df, "k", "rk", ascending=False, single_task_rows=0)
    plan = explain(ranked)
    # The only window without partitioning runs over one row per range partition.
    assert re.search(r"rank\(__local|rank\(\)", plan) is None or "partitionBy" not in plan
    assert "windowspecdefinition(__part" in plan
    rows = {r["id"]: r["rk"] for r in ranked.collect()}
    keys = {i: i % 997 for i in range(5000)}
    srt = sorted(keys.values(), reverse=True)
    first = {}
    for pos, k in enumerate(srt, start=1):
        first.setdefault(k, pos)
    assert all(rows[i] == first[keys[i]] for i in range(5000))


def test_pairwise_correlation_is_an_equi_join_not_a_nested_loop(spark, sf_dir):
    tree = main_tree(explain(Q["pairwise_correlation"](spark, sf_dir)))
    assert "CartesianProduct" not in tree and "BroadcastNestedLoopJoin" not in tree
    assert "SortMergeJoin" in tree or "BroadcastHashJoin" in tree


def test_bounded_broadcast_falls_back_to_a_shuffle_join(spark):
    from tidemark.plans.sizing import bounded_broadcast

    big = spark.range(0, 1000).withColumnRenamed("id", "k")
    small = spark.range(0, 50).withColumnRenamed("id", "k")
    hinted = explain(big.join(bounded_broadcast(small, max_rows=100), "k"))
    assert "BroadcastHashJoin" in main_tree(hinted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = explain(big.join(bounded_broadcast(small, max_rows=10), "k"))
        assert "BroadcastHashJoin" not in main_tree(plain) and "SortMergeJoin" in main_tree(plain)
        known = explain(big.join(bounded_broadcast(small, max_rows=100, known_bound=60), "k"))
        assert "BroadcastHashJoin" in main_tree(known)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
