"""Sums per key and month. Every one combines map-side before it shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.columns import month_of
from tallymart.operators.joins import join_on
from tallymart.schemas import MONEY


def with_month(facts: DataFrame) -> DataFrame:
    """The columns the monthly marts need, and nothing else of the fact."""
    return facts.select(
        "customer_id",
        "store_id",
        "sales_person_id",
        month_of(F.col("sales_date")).alias("sales_month"),
        "total_cost",
    )


def monthly_cube(facts: DataFrame) -> DataFrame:
    """Sales per customer, store, seller and month: additive over runs."""
    return sum_cost(with_month(facts), ["customer_id", "store_id", "sales_person_id", "sales_month"], "total_cost")


def sum_cost(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("total_cost").cast(MONEY).alias(name))


def attach_group_sum(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Every row with the total of its group: totals by a partial aggregation, joined back.

    No group is held by a task, whatever its size: rows stream past their total, and adaptive
    execution splits the partition of a hot group, or broadcasts the totals where they
    are found to be few. Read twice, ``rows`` should be a stored table.
    """
    return join_on(rows, sum_cost(rows, keys, name), keys)
