"""Scalar expressions. Each takes and returns Columns, so all of it runs in codegen."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallymart.schemas import MONEY

# The top seller's share of the month, and the separator of folded columns.
INCENTIVE_RATE = Decimal("0.01")
FOLD_SEPARATOR = ", "


def month_of(day: Column) -> Column:
    """``yyyy-MM`` of a date; NULL stays NULL. Cheaper per row than a format pattern."""
    return F.substring(day.cast("string"), 1, 7)


def full_name(first: Column, last: Column) -> Column:
    """First and last name with one space; NULL as soon as one part is NULL."""
    return F.concat(first, F.lit(" "), last)


def fold_columns(columns: Sequence[Column]) -> Column:
    """Extra columns as one text, NULLs skipped; a typed NULL when there are none."""
    if not columns:
        return F.lit(None).cast("string")
    return F.concat_ws(FOLD_SEPARATOR, *columns)


def incentive(total: Column, is_top: Column) -> Column:
    """One percent of the total, rounded half up, for top sellers and 0 for the rest."""
    share = F.round(total * F.lit(INCENTIVE_RATE), 2)
    return F.when(is_top, share).otherwise(F.lit(0)).cast(MONEY)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def canonical_path(path: Column) -> Column:
    """One spelling for local paths, which Spark prints with one or three slashes.

    It is asked for with every row, so paths that are spelled so already are not taken apart by a pattern.
    """
    spelled = path.startswith("file:///") & ~path.startswith("file:////")
    respelled = F.regexp_replace(path, "^file:/+", "file:///")
    return F.when(spelled | ~path.startswith("file:/"), path).otherwise(respelled)


def decoded_path(metadata_path: Column) -> Column:
    """``_metadata.file_path`` is percent-encoded; undo that to match listed paths.

    It is asked for with every row, so paths without a code are left as they are.
    """
    decoded = F.url_decode(F.replace(metadata_path, F.lit("+"), F.lit("%2B")))
    return canonical_path(F.when(F.contains(metadata_path, F.lit("%")), decoded).otherwise(metadata_path))


def whole_number(text: Column, kind: str) -> Column:
    """Integer text; ``7.0`` counts, as exporters write it for columns with gaps."""
    as_decimal = text.try_cast("decimal(38,6)")
    integral = F.when(as_decimal == F.floor(as_decimal), as_decimal.try_cast(kind))
    return F.coalesce(text.try_cast(kind), integral)


def money(text: Column) -> Column:
    return text.try_cast(MONEY)


def day(text: Column) -> Column:
    """A full date, with or without a time behind it; bare years or months do not count."""
    return F.when(text.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), text.try_cast("date"))


def header_columns(line: Column) -> Column:
    """Column names of a CSV header line: commas inside double quotes do not split."""
    parts = F.split(F.coalesce(line, F.lit("")), r',(?=(?:[^"]*"[^"]*")*[^"]*$)', -1)
    return F.transform(parts, lambda part: F.regexp_replace(part, r'^"(.*)"$', "$1"))
