"""Shape of the plans: no Python rows, no products of tables, no single-task window over a table."""

import pytest

import __spark_entry__ as registered

QUERIES = registered.queries()
NATIVE = sorted(n for n in QUERIES if not n.startswith(("m", "co_", "precipitation_develop", "precipitation_score", "fire_score", "s1", "s3", "op", "pipeline")))
TIES = ("a5_arg_best", "j7_nearest_pixel")  # whole rows are compared, but only those that reach the best metric


@pytest.mark.parametrize("name", NATIVE)
def test_plan(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Window" in line:
            assert not any("SinglePartition" in below for below in lines[i + 1 : i + 4]), plan
        if name not in TIES and "SortAggregate(key=[" in line and "SortAggregate(key=[]" not in line:
            raise AssertionError(f"an aggregation that sorts its input first\n{plan}")


@pytest.mark.parametrize("name", ["a13_metrics_by_class_report", "w1_stratified_split", "e5_density_weight", "j10_regrid_bilinear"])
def test_result_does_not_depend_on_shuffle_partitions(name, spark, sf_dir):
    results = []
    for partitions in ("1", "13"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            results.append(sorted(tuple(map(str, r)) for r in QUERIES[name](spark, sf_dir).collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = QUERIES["p18_select_date"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan
    plan = QUERIES["a12_best_threshold"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan
