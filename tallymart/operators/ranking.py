"""Best sellers and exact ranks within a store and month.

The rows ranked here are sums, one per seller, so a store that sells most of
everything still has no more rows than sellers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.operators.joins import join_on
from tallymart.sources.tables import stage
from tallymart.workspace import shared_folder


def attach_group_max(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Every row with the largest value of its group; nothing is sorted or gathered."""
    return join_on(rows, rows.groupBy(*keys).agg(F.max(value).alias(name)), keys)


def ordered_values(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Each group's distinct values with ``_ties``, their number of rows, in ranges that Spark cuts from a sample.

    Ranges follow the order of keys and falling value, NULLs last, and hold about equally many
    values, however these are spread, and however many rows share one. ``_range``
    numbers them. They are written once, as the cuts of a sample need not come out alike twice.
    """
    order = [*(F.col(key).asc_nulls_first() for key in keys), F.col(value).desc_nulls_last()]
    values = rows.groupBy(*keys, value).agg(F.count("*").alias("_ties"))
    ranges = values.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    return stage(ranges, shared_folder(rows.sparkSession, "ordered-values"))


def attach_rank(rows: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """SQL RANK within each group, largest value first and NULLs last.

    A value's rank is one more than the rows of its group in earlier ranges and the rows of larger
    values in its own. So a task orders one range, never a whole group, and
    a group that spans many ranges is ranked by as many tasks.
    """
    values = ordered_values(rows, keys, value)
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # A row per range that a group reaches into.
    sums = values.groupBy(*keys, "_range").agg(F.sum("_ties").alias("_in_range"))
    offsets = sums.select(*keys, "_range", F.coalesce(F.sum("_in_range").over(earlier), F.lit(0)).alias("_earlier"))
    larger = (
        Window.partitionBy(*keys, "_range")
        .orderBy(F.col(value).desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = values.withColumn("_larger", F.coalesce(F.sum("_ties").over(larger), F.lit(0)))
    ranked = join_on(placed, offsets, [*keys, "_range"]).select(
        *keys, value, (F.col("_earlier") + F.col("_larger") + 1).cast("int").alias(name)
    )
    return join_on(rows, ranked, [*keys, value])
