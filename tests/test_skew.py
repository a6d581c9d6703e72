"""Rows in which one key, or copies of one row, are a third or more of the whole."""

import random
import re
from collections import Counter
from contextlib import contextmanager
from decimal import Decimal

import pytest
from fixtures import bag, customers, dimensions, fact, facts, sellers, stores
from pyspark.sql import functions as F

from tallymart.operators.aggregates import attach_group_sum
from tallymart.operators.joins import enrich, merged
from tallymart.operators.ranking import attach_rank, ordered_values


@contextmanager
def settings(spark, **values):
    """Settings of the session for a while; names with _ for the dots behind spark.sql."""
    names = {f"spark.sql.{name.replace('__', '.')}": value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# Thresholds that make a few kilobytes a large partition.
SMALL = {
    "adaptive__advisoryPartitionSizeInBytes": "16k",
    "adaptive__skewJoin__skewedPartitionThresholdInBytes": "16k",
    "adaptive__skewJoin__skewedPartitionFactor": "2",
    "shuffle__partitions": "8",
}


def final_plan(df):
    """The plan that has run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def skewed(spark):
    rng = random.Random(7)
    rows = [fact(1, 121, 1, "2024-03-01", "5.00")] * 150
    rows += [
        fact(rng.choice([2, 3, 4, None]), rng.choice([121, 122]), rng.choice([1, 2, 9]), "2024-04-01", str(i))
        for i in range(150)
    ]
    return facts(spark, rows)


@pytest.mark.parametrize("how", ["inner", "left_semi"])
def test_merged_join_equals_plain_join(spark, how):
    rows = skewed(spark)
    lookup = customers(spark).select("customer_id", "phone_number")
    plain = rows.join(lookup, "customer_id", how)
    assert bag(merged(rows, lookup, "customer_id", how), *plain.columns) == bag(plain)


def hot_facts(spark, n):
    """Half of the rows are one customer's, stored so that a plan that reads them shows."""
    return spark.range(n).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 5000).cast("bigint").alias("customer_id"),
        F.lit(121).cast("bigint").alias("store_id"),
        (1 + F.col("id") % 2).alias("sales_person_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("sales_date"),
        (F.xxhash64("id") % 100000 / 100).cast("decimal(18,2)").alias("total_cost"),
    )


@pytest.mark.parametrize("checked", [False, True])
def test_partition_of_a_hot_key_is_split(spark, tmp_path, checked):
    """Facts are read once, and the tasks of the join read no more than a small part of the hot key."""
    hot_facts(spark, 40_000).write.parquet(f"{tmp_path}/facts")
    sold = spark.read.parquet(f"{tmp_path}/facts")
    found = dimensions(spark, customers=customers(spark, ids=range(5000)), broadcast_bytes=1000)
    assert not found.customers.small_keys and found.stores.small
    with settings(spark, **SMALL):
        rows = enrich(sold, found, checked_only=[found.customers] if checked else [])
        text = final_plan(rows)
        assert re.search(r"SortMergeJoin\(skew=true\)", text)
        assert len(re.findall(r"FileScan parquet", text)) == 1
        assert rows.count() == 40_000


def test_group_sums_of_a_hot_group_are_split(spark, tmp_path):
    hot_facts(spark, 40_000).withColumn("sales_month", F.lit("2024-01")).write.parquet(f"{tmp_path}/facts")
    keys = ["customer_id", "sales_month"]
    rows = spark.read.parquet(f"{tmp_path}/facts").select(*keys, "total_cost")
    with settings(spark, **SMALL, autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1"):
        attached = attach_group_sum(rows, keys, "total")
        text = final_plan(attached)
        assert "Window" not in text and "skew=true" in text
        hot = attached.filter("customer_id = 1").select("total").distinct().collect()
    assert [row["total"] for row in hot] == [rows.filter("customer_id = 1").agg(F.sum("total_cost")).first()[0]]


def test_large_dimensions_give_the_same_star(spark):
    tables = {
        "customers": customers(spark, ids=(1, 2, 3)),
        "stores": stores(spark),
        "sellers": sellers(spark, ids=(1, 2)),
    }
    small = enrich(skewed(spark), dimensions(spark, **tables))
    large = enrich(skewed(spark), dimensions(spark, **tables, broadcast_bytes=-1))
    assert bag(large, *sorted(small.columns)) == bag(small, *sorted(small.columns))


def brute_ranks(rows):
    totals = {}
    for store, _, total in rows:
        totals.setdefault(store, []).append(total)
    ranked = []
    for store, seller, total in rows:
        larger = [t for t in totals[store] if t is not None and (total is None or t > total)]
        ranked.append((store, seller, total, 1 + len(larger)))
    return ranked


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_rank_equals_brute_force(spark, partitions):
    rng = random.Random(partitions)
    rows = []
    for seller in range(300):
        store = 121 if seller % 3 else rng.choice([122, 123, None])
        kind = rng.random()
        total = None if kind < 0.1 else Decimal("7.00") if kind < 0.4 else Decimal(rng.randint(-500, 90000)) / 100
        rows.append((store, seller, total))
    df = spark.createDataFrame(rows, "store_id bigint, seller bigint, total decimal(18,2)")
    with settings(spark, shuffle__partitions=partitions, adaptive__coalescePartitions__enabled="false"):
        ranked = attach_rank(df, ["store_id"], "total", "rnk")
        found = Counter(tuple(row) for row in ranked.select("store_id", "seller", "total", "rnk").collect())
    assert found == Counter(brute_ranks(rows))


@pytest.mark.parametrize("shape", ["outlier", "half tied", "one store", "many stores"])
def test_ranges_hold_about_equally_many_values(spark, shape):
    n = 20_000
    total = F.xxhash64("id") % 10_000_000
    if shape == "outlier":
        total = F.when(F.col("id") == 0, F.lit(10**15)).otherwise(total % 1000 + F.col("id") / n)
    if shape == "half tied":
        total = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(total)
    store = F.col("id") % 997 if shape == "many stores" else F.when(F.col("id") % 3 == 0, F.col("id") % 5)
    rows = spark.range(n).select(store.alias("store_id"), total.cast("decimal(38,4)").alias("total"))
    with settings(spark, shuffle__partitions="8", adaptive__coalescePartitions__enabled="false"):
        sizes = [row["count"] for row in ordered_values(rows, ["store_id"], "total").groupBy("_range").count().collect()]
        assert len(sizes) == 8
        assert max(sizes) <= 2 * sum(sizes) / len(sizes)
        ranked = attach_rank(rows, ["store_id"], "total", "rnk")
        rows.createOrReplaceTempView("ranges_input")
        window = spark.sql(
            "SELECT *, rank() OVER (PARTITION BY store_id ORDER BY total DESC NULLS LAST) rnk FROM ranges_input"
        )
        assert bag(ranked, *window.columns) == bag(window)


def test_rank_of_nothing(spark):
    rows = spark.createDataFrame([], "store_id bigint, total decimal(18,2)")
    assert attach_rank(rows, ["store_id"], "total", "rnk").isEmpty()
