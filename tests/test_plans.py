"""The registered queries' plans: what is read, and what must not appear in them."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"

MODELLED = [
    "bronze_lineitem", "dq_not_null", "dim_customer", "dim_part", "fct_orders",
    "wide_order_details", "wide_order_details_fanout", "finance_metrics",
    "finance_metrics_refcompat", "daily_sales_metrics", "supply_chain_dashboard",
    "supplier_performance", "inventory_analysis", "lazy_pipeline_finance",
]


def plan_of(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    return df._jdf.queryExecution().executedPlan().toString()


def columns_read(plan, prefix):
    """Columns of the table with that prefix, per scan."""
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    named = [[c.split("#")[0] for c in scan.split(",")] for scan in scans]
    return sorted({tuple(sorted(cols)) for cols in named if cols[0].startswith(prefix)})


@pytest.fixture(autouse=True)
def whole_lines(setting):
    setting("spark.sql.maxMetadataStringLength", "10000")
    setting("spark.sql.debug.maxToStringFields", "1000")


@pytest.mark.parametrize("name", MODELLED)
@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_no_all_pairs_joins_and_no_python(spark, setting, name, threshold):
    setting("spark.sql.autoBroadcastJoinThreshold", threshold)
    plan = plan_of(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "RDDScan"):
        assert operator not in plan


def test_finance_reads_the_columns_it_needs(spark):
    plan = plan_of(spark, "finance_metrics")
    assert columns_read(plan, "l_") == [("l_discount", "l_extendedprice", "l_orderkey", "l_tax")]
    assert columns_read(plan, "o_") == [("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")]
    assert columns_read(plan, "c_") == [("c_custkey", "c_nationkey")]


def test_lines_are_summed_before_they_are_joined(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(spark, "finance_metrics")
    lines = plan[plan.rindex("HashAggregate(keys=[l_orderkey"):]
    lines = lines[: lines.index("FileScan")]
    assert "partial_sum" in lines
    assert "Join" not in lines


def test_checks_read_the_key_column_only(spark):
    plan = plan_of(spark, "dq_not_null")
    assert columns_read(plan, "o_") == [("o_orderkey",)]
    assert columns_read(plan, "c_") == [("c_custkey",)]


def test_filters_reach_the_scan(spark):
    lines = entry.queries()["bronze_lineitem"](spark, FOLDER).filter("l_linenumber = 3")
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_linenumber,3)" in plan


def test_finance_shuffles_no_customers(spark):
    """They are within the threshold, and nation names come in after the sums."""
    plan = plan_of(spark, "finance_metrics")
    assert "SortMergeJoin [o_custkey" not in plan and "hashpartitioning(o_custkey" not in plan
    assert "hashpartitioning(c_nationkey" not in plan
    joined = plan.index("geo_nationkey")
    assert plan.index("HashAggregate(keys=[date#") < joined


def test_sales_plan_has_no_expand(spark):
    for name in ("daily_sales_metrics", "lazy_daily_sales_metrics"):
        plan = plan_of(spark, name)
        assert "Expand" not in plan
        assert plan.count("Exchange hashpartitioning") <= 7


def test_the_lazy_plan_is_the_registered_one(spark):
    """No part, supplier or offer is read for finance."""
    plan = plan_of(spark, "lazy_pipeline_finance")
    assert "ps_partkey" not in plan and "p_partkey" not in plan
    assert plan.count("FileScan") == plan_of(spark, "finance_metrics").count("FileScan")


def test_wide_rows_are_shuffled_narrow(spark, setting):
    """Suppliers fit a broadcast and are joined last; what follows from other columns is not sent."""
    setting("spark.sql.autoBroadcastJoinThreshold", "12000")
    lines = plan_of(spark, "wide_order_details").splitlines()
    sent = [lines[i + 1] for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    assert any("l_shipdate#" in x and "part_name#" in x for x in sent)
    for name in (
        "wholesale_price", "category", "packaging", "supplier_name",
        "supplier_account_balance", "manufacturing_country", "manufacturing_region",
    ):
        assert not any(f"{name}#" in x for x in sent), name
