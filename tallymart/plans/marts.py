"""The marts: what is computed, as functions from DataFrames to DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.columns import full_name, incentive, month_of
from tallymart.operators.aggregates import sum_cost
from tallymart.operators.joins import enrich, keep_all_known
from tallymart.operators.ranking import attach_group_max, attach_rank
from tallymart.schemas import MONEY
from tallymart.sources.dimensions import Dimension, Dimensions

CUSTOMER_NAME = ("customer_first_name", "customer_last_name")
SELLER_NAME = ("sales_person_first_name", "sales_person_last_name")


def _name(columns: tuple[str, str]):
    return full_name(*map(F.col, columns)).alias("full_name")


def _extend(totals: DataFrame, dimension: Dimension) -> DataFrame:
    """Inner join of summed rows to a dimension; per key there are only months left."""
    rows = F.broadcast(dimension.rows) if dimension.small else dimension.rows
    return totals.join(rows, dimension.key)


# Row-level marts. Their columns.


def customer_rows(facts: DataFrame, dimensions: Dimensions) -> DataFrame:
    rows = enrich(facts, dimensions, checked_only=[dimensions.stores, dimensions.sellers])
    return rows.select(
        "customer_id",
        F.col("customer_first_name").alias("first_name"),
        F.col("customer_last_name").alias("last_name"),
        F.col("customer_address").alias("address"),
        F.col("customer_pincode").alias("pincode"),
        "phone_number",
        "sales_date",
        "total_cost",
    )


def sales_rows(facts: DataFrame, dimensions: Dimensions) -> DataFrame:
    return enrich(facts, dimensions, checked_only=[dimensions.customers]).select(
        "store_id",
        "sales_person_id",
        "sales_person_first_name",
        "sales_person_last_name",
        "store_manager_name",
        "manager_id",
        "is_manager",
        "sales_person_address",
        "sales_person_pincode",
        "sales_date",
        "total_cost",
        month_of(F.col("sales_date")).alias("sales_month"),
    )


# Monthly marts. ``rows`` carry the keys, ``sales_month`` and ``total_cost``: facts
# through ``with_month``, or the stored monthly cube.


def customer_totals(rows: DataFrame, dimensions: Dimensions) -> DataFrame:
    """Spend per customer and month, over sales whose store and seller are known."""
    known = keep_all_known(rows, [dimensions.stores, dimensions.sellers])
    return sum_cost(known, ["customer_id", "sales_month"], "total_sales")


def named_customers(totals: DataFrame, dimensions: Dimensions) -> DataFrame:
    """The same with what is known of the customers; those unknown are lost."""
    return _extend(totals, dimensions.customers).select(
        "customer_id",
        _name(CUSTOMER_NAME),
        F.col("customer_address").alias("address"),
        "phone_number",
        F.col("sales_month").alias("sales_date_month"),
        "total_sales",
    )


def customer_monthly(rows: DataFrame, dimensions: Dimensions) -> DataFrame:
    """Spend per customer and month, over sales whose three dimensions are known."""
    return named_customers(customer_totals(rows, dimensions), dimensions)


def added_customers(parts: DataFrame) -> DataFrame:
    """One mart of several, by the same dimensions, of different sales."""
    keys = [name for name in parts.columns if name != "total_sales"]
    return parts.groupBy(*keys).agg(F.sum("total_sales").cast(MONEY).alias("total_sales"))


def added_sellers(parts: DataFrame) -> DataFrame:
    """The same for sellers, of whom the best are found anew."""
    keys = ["store_id", "sales_person_id", "full_name", "sales_month"]
    return add_incentive(parts.groupBy(*keys).agg(F.sum("total_sales").cast(MONEY).alias("total_sales")))


def seller_monthly(rows: DataFrame, dimensions: Dimensions) -> DataFrame:
    """Sales per store, seller and month, over sales whose three dimensions are known."""
    keys = ["store_id", "sales_person_id", "sales_month"]
    known = keep_all_known(rows, [dimensions.customers, dimensions.stores])
    totals = sum_cost(known, keys, "total_sales")
    return _extend(totals, dimensions.sellers).select(
        "store_id", "sales_person_id", _name(SELLER_NAME), "sales_month", "total_sales"
    )


def add_incentive(monthly: DataFrame) -> DataFrame:
    """One percent for the best seller of each store and month, ties included.

    The best total is a maximum, so nobody has to be sorted. A store whose only
    totals are NULL has a NULL best: its sellers tie, and their share is NULL.
    """
    ranked = attach_group_max(monthly, ["store_id", "sales_month"], "total_sales", "_best")
    is_top = F.col("total_sales").eqNullSafe(F.col("_best"))
    return ranked.select(
        "store_id",
        "sales_person_id",
        "full_name",
        "sales_month",
        "total_sales",
        incentive(F.col("total_sales"), is_top).alias("incentive"),
    )


def sales_incentive(rows: DataFrame, dimensions: Dimensions) -> DataFrame:
    return add_incentive(seller_monthly(rows, dimensions))


def rank_sellers(monthly: DataFrame) -> DataFrame:
    return attach_rank(monthly, ["store_id", "sales_month"], "total_sales", "rnk")


def daily_purchases(facts: DataFrame, dimensions: Dimensions) -> DataFrame:
    """What each customer bought on each day."""
    keys = ["customer_id", "sales_date"]
    known = keep_all_known(facts, [dimensions.stores, dimensions.sellers])
    totals = known.groupBy(*keys).agg(
        F.sum("total_cost").cast(MONEY).alias("total_spent"),
        F.count("*").alias("purchases"),
    )
    return _extend(totals, dimensions.customers).select(
        "customer_id", _name(CUSTOMER_NAME), "sales_date", "total_spent", "purchases"
    )


def customers_by_month(rows: DataFrame, dimensions: Dimensions) -> DataFrame:
    """Each customer once per month with a sale."""
    keys = ["customer_id", "sales_month"]
    known = keep_all_known(rows, [dimensions.stores, dimensions.sellers]).select(*keys).distinct()
    return _extend(known, dimensions.customers).select(
        "customer_id",
        _name(CUSTOMER_NAME),
        F.col("customer_address").alias("address"),
        "phone_number",
        F.col("sales_month").alias("sales_date_month"),
    )


def sellers_by_month(rows: DataFrame, dimensions: Dimensions) -> DataFrame:
    """Each seller once per store and month with a sale."""
    keys = ["store_id", "sales_person_id", "sales_month"]
    known = keep_all_known(rows, [dimensions.customers, dimensions.stores]).select(*keys).distinct()
    return _extend(known, dimensions.sellers).select(
        "store_id", "sales_person_id", _name(SELLER_NAME), "sales_month"
    )


def incentive_report(mart: DataFrame) -> DataFrame:
    """Seller, store, billing of the month and incentive, as handed to payroll."""
    return mart.select(
        F.col("full_name").alias("sales_person_name"),
        F.col("store_id").alias("sales_person_store_id"),
        "sales_month",
        F.col("total_sales").alias("total_billing"),
        F.col("incentive").alias("total_incentive"),
    )

