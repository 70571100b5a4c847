"""What the plans must look like to hold at scale."""

import pytest
from pyspark.sql import functions as F

from sluice import Condition
from sluice.operators import aggregate, joins, rows, windows
from sluice.operators.aggregate import Aggregation
from sluice.operators.values import filter_rows
from sluice.session import planned_bytes, settled

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{FOLDER}/orders.parquet")


def test_filters_and_columns_reach_the_scan(orders):
    recent = Condition("o_orderdate", "GTE", "1998-01-01")
    rich = Condition("o_totalprice", "GT", 1000)
    text = plan(filter_rows(orders, recent & rich).select("o_orderkey"))
    assert "GreaterThanOrEqual(o_orderdate" in text
    assert "GreaterThan(o_totalprice" in text
    assert "o_custkey" not in text.split("ReadSchema")[1]


def test_extremes_are_scalar_subqueries(orders):
    text = plan(filter_rows(orders, Condition("o_totalprice", "IS_MAXVAL")))
    assert "Subquery" in text
    assert "CartesianProduct" not in text
    assert "NestedLoop" not in text


def test_groups_are_cut_before_the_shuffle(orders):
    order = [["o_orderdate", "DESC"], "o_orderkey"]
    for df in (
        rows.dedupe_latest(orders, ["o_custkey"], order),
        windows.top_per_group(orders, 3, ["o_custkey"], order),
        rows.discard_duplicates(orders, ["o_orderkey", "o_orderdate"]),
    ):
        text = plan(df)
        assert "WindowGroupLimit" in text
        assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_limits_do_not_sort_everything(orders):
    assert "TakeOrderedAndProject" in plan(rows.limit_rows(orders, 5, order_by=["o_totalprice"]))


def test_running_values_of_a_whole_table_use_many_tasks(orders):
    order = ["o_orderdate", "o_orderkey"]
    df = windows.window(orders, "SUM", "o_totalprice", "t", order_by=order, range_type="RUNNING")
    text = plan(df)
    # the only single task sums up one row per bucket
    singles = text.split("Exchange SinglePartition")[1:]
    assert len(singles) == 1
    assert singles[0].split("FileScan")[0].count("HashAggregate") == 2
    assert "hashpartitioning(_scan_bucket" in text


def test_grand_totals_are_partial_sums(orders):
    text = plan(windows.window(orders, "SUM", "o_totalprice", "t"))
    assert "partial_sum" in text
    assert "Window" not in text


def test_hot_group_totals_avoid_the_window(orders):
    df = windows.window(
        orders, "AVG", "o_totalprice", "t", partition_by=["o_orderstatus"], split=True
    )
    text = plan(df)
    assert "partial_avg" in text
    assert "Window" not in text


def test_aggregates_are_partial(orders):
    text = plan(aggregate.pivot(orders, ["o_custkey"], [Aggregation("o_totalprice", "SUM", "t")]))
    assert text.index("sum(") < text.index("Exchange") < text.rindex("partial_sum")


def test_no_operator_forces_a_broadcast(spark, orders):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        customer = spark.read.parquet(f"{FOLDER}/customer.parquet")
        joined = joins.join(orders, customer, [("o_custkey", "c_custkey")], "LEFT", ["c_name"])
        looked = joins.lookup(orders, "o_custkey", customer, "c_custkey", "c_name", "name")
        assert "SortMergeJoin" in plan(joined)
        assert "SortMergeJoin" in plan(looked)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_only_costly_inputs_are_written(orders):
    cheap = orders.filter("o_totalprice > 5").withColumn("x", F.lit(1))
    assert settled(cheap) is cheap
    grouped = orders.groupBy("o_custkey").count()
    assert settled(grouped) is not grouped
    assert sorted(settled(grouped).collect()) == sorted(grouped.collect())
    assert planned_bytes(orders) < 1 << 20


def test_chained_running_windows_stay_linear(orders):
    """Each window reads its input three times; without writing, four would mean 81 scans."""
    df = orders
    for i in range(4):
        order = ["o_orderdate", "o_orderkey"]
        df = windows.window(df, "SUM", "o_totalprice", f"t{i}", order_by=order, range_type="RUNNING")
    assert plan(df).count("FileScan") <= 3


def test_intermediates_go_when_they_are_no_longer_needed(spark):
    import os

    from sluice.catalog import QUERIES
    from sluice.session import intermediates, scratch_root

    root = scratch_root(spark).removeprefix("file://")
    before = set(os.listdir(root))
    with intermediates(spark):
        assert QUERIES["win_rank_split"](spark, "/root/testdata/sf0.001").count() > 0
        assert set(os.listdir(root)) - before
    assert set(os.listdir(root)) == before
