"""Joins of facts to dimensions: by broadcast where a size has been measured, else by a merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.sources.dimensions import Dimension, Dimensions

# What facts bring to a star join, besides what the dimensions add.
SOLD = ("customer_id", "store_id", "sales_person_id", "sales_date", "total_cost")


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL matches NULL, as it does in a grouping; keeps the left keys."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    match = reduce(lambda a, b: a & b, (F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys))
    return left.join(renamed, match, how).drop(*(f"_right_{key}" for key in keys))


def merged(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join to a lookup with unique keys that is too large to broadcast.

    Rows without a key match nothing and are dropped before the shuffle. Rows are read once;
    adaptive execution splits the partition of a hot key over several tasks,
    each with a copy of the few lookup rows of that partition.
    """
    return rows.filter(F.col(key).isNotNull()).join(lookup.hint("merge"), key, how)


def add_dimension(rows: DataFrame, dimension: Dimension) -> DataFrame:
    """Inner join to one dimension: rows with an unknown or NULL key are lost."""
    if dimension.small:
        return rows.join(F.broadcast(dimension.rows), dimension.key)
    return merged(rows, dimension.rows, dimension.key)


def keep_known(rows: DataFrame, dimension: Dimension) -> DataFrame:
    """Rows whose key exists in a dimension, which adds no columns."""
    if dimension.small_keys:
        return rows.join(F.broadcast(dimension.keys()), dimension.key, "left_semi")
    return merged(rows, dimension.keys(), dimension.key, "left_semi")


def keep_all_known(rows: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Rows known to all dimensions; those that are broadcast come first, as they drop rows before any shuffle."""
    for dimension in sorted(dimensions, key=lambda d: not d.small_keys):
        rows = keep_known(rows, dimension)
    return rows


def enrich(facts: DataFrame, dimensions: Dimensions, *, checked_only: Sequence[Dimension] = ()) -> DataFrame:
    """Star join to customers, stores and sellers, under unique column names.

    Dimensions in ``checked_only`` must know the sale but add no columns. Broadcasts come first.
    """
    rows = facts.select(*SOLD, *(name for name in ("sales_month",) if name in facts.columns))
    added = [dimension for dimension in dimensions.all() if dimension not in checked_only]
    rows = keep_all_known(rows, [dimension for dimension in checked_only if dimension.small_keys])
    for dimension in sorted(added, key=lambda d: not d.small):
        rows = add_dimension(rows, dimension)
    return keep_all_known(rows, [dimension for dimension in checked_only if not dimension.small_keys])
