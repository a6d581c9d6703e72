"""What the physical plans must and must not contain."""

import re

import pytest

from __spark_entry__ import queries
from tallymart.operators.sinks import write_partitioned
from tallymart.plans.daily_run import in_months
from tallymart.sources.tables import read_parquet

BATCH = [
    "sales_incentive_mart",
    "customer_monthly_mart",
    "sales_incentive_mart_many_customers",
    "customer_monthly_mart_many_customers",
    "customer_daily_purchases",
    "distinct_customer_month",
    "window_customer_month_sum",
    "rank_salesperson",
    "enriched_sales_many_customers",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_join_and_no_python(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas", text)


@pytest.mark.parametrize("name", ["sales_incentive_mart", "customer_monthly_mart"])
def test_sums_are_partial_before_the_shuffle(spark, sf_dir, name):
    text = plan(queries()[name](spark, sf_dir))
    assert "partial_sum" in text
    assert "Window" not in text


@pytest.mark.parametrize("name", ["window_customer_month_sum", "window_salesperson_month_sum"])
def test_totals_on_rows_need_no_window(spark, sf_dir, name):
    assert "Window" not in plan(queries()[name](spark, sf_dir))


@pytest.mark.parametrize("name", [name for name in BATCH if name.endswith("many_customers")])
def test_large_dimensions_need_one_read_of_the_facts(spark, sf_dir, name):
    result = queries()[name](spark, sf_dir)
    result.collect()
    final = plan(result).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet[^\n]*total_cost", final)) == 1


def test_scan_reads_only_the_columns_in_use(spark, sf_dir):
    text = queries()["sales_incentive_mart"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_tax" not in re.sub(r"Relation \[[^\]]*\]", "", text)
    scans = plan(queries()["sales_incentive_mart"](spark, sf_dir))
    schema = re.search(r"lineitem\.parquet.*?ReadSchema: struct<([^>]*)>", scans).group(1)
    assert {field.split(":")[0] for field in schema.split(",")} == {
        "l_orderkey",
        "l_suppkey",
        "l_extendedprice",
        "l_shipdate",
    }


def test_flagship_reads_the_facts_once(spark, sf_dir):
    result = queries()["sales_incentive_mart"](spark, sf_dir)
    result.collect()
    final = plan(result).split("== Initial Plan ==")[0]
    assert len(re.findall(r"lineitem\.parquet", final)) == 1
    assert "ReusedExchange" in final


def test_month_filter_prunes_partitions(spark, tmp_path):
    rows = spark.range(4).selectExpr("id AS n", "concat('2024-0', id % 2 + 1) AS sales_month")
    write_partitioned(rows, f"{tmp_path}/mart", ["sales_month"])
    read = read_parquet(spark, f"{tmp_path}/mart", rows.schema)
    text = plan(read.filter(in_months("sales_month", ["2024-01"])))
    assert re.search(r"PartitionFilters: \[[^\]]*sales_month", text)


def test_listing_reads_no_content(spark, sf_dir):
    text = plan(queries()["file_inventory"](spark, sf_dir))
    assert re.search(r"ReadSchema: struct<[^>]*length", text)
    assert "content" not in re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
