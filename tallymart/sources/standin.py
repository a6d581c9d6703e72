"""The driver's order tables, read as sales facts and dimensions.

Order lines are sales, suppliers are sellers, nations are stores. Joins are left
to Spark: Parquet tables have sizes, so it broadcasts only under its threshold
and splits skewed partitions beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.schemas import MONEY
from tallymart.sources.dimensions import BROADCAST_BYTES, Dimensions, current_dimensions, file_fingerprint
from tallymart.sources.tables import read_parquet
from tallymart.workspace import once


# The columns in use of the driver's tables. Stated, so that no job has
# to open files only to learn them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_name string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double"
    ", l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", TABLES[name])


def sold_lines(spark: SparkSession, sf_dir: str, *line_columns: str, order_columns: tuple[str, ...] = ()) -> DataFrame:
    """Order lines with their customer, seller and store, and any further columns asked for."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_shipdate", "l_extendedprice", *line_columns
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id"), *order_columns
    )
    sellers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("bigint").alias("store_id")
    )
    return (
        lines.join(sellers, "l_suppkey")
        .join(orders, "l_orderkey")
        .withColumns(
            {
                "sales_date": F.to_date("l_shipdate"),
                "sales_person_id": F.col("l_suppkey"),
                "total_cost": F.col("l_extendedprice").cast(MONEY),
            }
        )
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact columns the marts use; products are not even read for them."""
    return sold_lines(spark, sf_dir).select(
        "customer_id", "store_id", "sales_date", "sales_person_id", "total_cost"
    )


def add_product(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product name, price and quantity, for queries that show whole facts."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast(MONEY).alias("price"),
    )
    return lines.join(parts, "l_partkey").withColumn("quantity", F.col("l_quantity").cast("int"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    key = F.col("c_custkey").cast("string")
    return people.join(nations, "c_nationkey").select(
        F.col("c_custkey").alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.col("n_name").alias("address"),
        (F.lit(100000) + F.col("c_nationkey")).cast("string").alias("pincode"),
        F.concat(F.lit("91"), F.lpad(key, 8, "0")).alias("phone_number"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    return nations.join(regions, "n_regionkey").select(
        F.col("n_nationkey").cast("bigint").alias("id"),
        F.col("r_name").alias("address"),
        F.concat(F.lit("Manager "), F.col("n_name")).alias("store_manager_name"),
    )


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers; the one with the lowest key manages each store."""
    people = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    managers = people.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("manager_id"))
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return (
        people.join(managers, "s_nationkey")
        .join(nations, "s_nationkey")
        .select(
            F.col("s_suppkey").alias("id"),
            F.split_part("s_name", F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part("s_name", F.lit("#"), F.lit(2)).alias("last_name"),
            "manager_id",
            F.when(F.col("s_suppkey") == F.col("manager_id"), "Y").otherwise("N").alias("is_manager"),
            F.col("n_name").alias("address"),
            (F.lit(200000) + F.col("s_nationkey")).cast("string").alias("pincode"),
        )
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast(MONEY).alias("current_price"),
    )


# The tables the dimensions are made from.
DIMENSION_TABLES = ("customer", "nation", "region", "supplier")


def dimensions(spark: SparkSession, sf_dir: str, broadcast_bytes: int = BROADCAST_BYTES) -> Dimensions:
    """The three dimensions, checked once for each state of the files they come from."""
    paths = [f"{sf_dir}/{name}.parquet" for name in DIMENSION_TABLES]
    folder = once(spark, "dimensions", lambda path: None)
    return current_dimensions(
        spark,
        folder,
        file_fingerprint(spark, paths),
        lambda: (customers(spark, sf_dir), stores(spark, sf_dir), sellers(spark, sf_dir)),
        broadcast_bytes=broadcast_bytes,
    )
