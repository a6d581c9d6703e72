"""From raw CSV files to typed facts: header gate, folding, casts, quarantine."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.columns import day, fold_columns, header_columns, money, whole_number
from tallymart.schemas import (
    CONFORMED_SCHEMA,
    EXTRA_COLUMN,
    FACT_COLUMNS,
    FACT_TYPES,
    MANDATORY_COLUMNS,
    MONEY,
    REFUSED_SCHEMA,
)
from tallymart.sources.files import (
    TORN_ROW,
    header_lines,
    openable,
    read_csv_group,
    read_raw_lines,
    scanned_header_lines,
)
from tallymart.sources.tables import stage
from tallymart.workspace import shared_folder

MISSING = "missing_columns"
DUPLICATE = "duplicate_columns"
# What failed in a row with more or fewer fields than its header.
ROW_WIDTH = "row_width"


def gate_headers(headers: DataFrame) -> DataFrame:
    """Compare each file's header with the mandatory columns.

    Names are case-sensitive and may come in any order. A header that spells a
    mandatory column twice (in any case) is refused under its own reason, as it
    does not say which of the two is meant.
    """
    mandatory = F.array(*map(F.lit, MANDATORY_COLUMNS))
    columns = F.col("columns")
    spelled = F.filter(F.transform(columns, F.lower), lambda name: name.isin(*MANDATORY_COLUMNS))
    return (
        headers.withColumn("columns", header_columns(F.col("header_line")))
        .withColumn("missing_columns", F.array_sort(F.array_except(mandatory, columns)))
        .withColumn(
            "reason",
            F.when(F.size(spelled) > F.size(F.array_distinct(spelled)), DUPLICATE)
            .when(F.size("missing_columns") > 0, MISSING)
            .otherwise(F.lit(None).cast("string")),
        )
    )


@dataclass
class HeaderGroup:
    """Files with the same header line, hence the same columns at the same places."""

    columns: list[str]
    missing: list[str]
    reason: str | None
    paths: list[str] = field(default_factory=list)


def read_headers(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Header line per file: of files that tasks can open by opening them, of others by a scan of their text."""
    named = files.select("file_path")
    others = named.filter(~openable(F.col("file_path")))
    opened = header_lines(named.filter(openable(F.col("file_path"))))
    # The reader that scans needs the names, as any reader does.
    paths = [row["file_path"] for row in others.collect()]
    if not paths:
        return opened
    return opened.unionByName(others.join(scanned_header_lines(spark, paths), "file_path", "left"))


def stored_headers(gated: DataFrame) -> DataFrame:
    """Gated headers written once, as several steps ask for them and headers cost a read per file."""
    return stage(gated, shared_folder(gated.sparkSession, "headers"))


def header_groups(gated: DataFrame) -> list[HeaderGroup]:
    """One group per distinct header line.

    Only file names and header lines come to the driver, which needs them to name
    the files to read; Spark's file index holds the same list there anyway.
    """
    groups: dict[str | None, HeaderGroup] = {}
    for row in gated.select("file_path", "header_line", "columns", "missing_columns", "reason").collect():
        group = groups.setdefault(
            row["header_line"], HeaderGroup(row["columns"], row["missing_columns"], row["reason"])
        )
        group.paths.append(row["file_path"])
    return list(groups.values())


def _typed(name: str, text: Column) -> Column:
    kind = FACT_TYPES[name]
    if kind == "string":
        return text
    if kind == "date":
        return day(text)
    if kind == MONEY:
        return money(text)
    return whole_number(text, kind)


def _labels(columns: Sequence[str]) -> list[str]:
    """Header names, made distinct where a file repeats or omits one."""
    lowered = [name.lower() for name in columns]
    return [
        name if name and lowered.count(name.lower()) == 1 else f"{name}_{at}" for at, name in enumerate(columns)
    ]


def conform_group(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Typed facts from one header group's text rows, with the fields that failed.

    A field fails when it holds text that is not a value of its type. Such rows keep
    their fields as JSON in ``raw_row``; sound rows do not carry it. A row with more or
    fewer fields than the header fails as a whole, has no values, and keeps its line as it is.
    """
    place = {name: F.col(f"_c{at}") for at, name in enumerate(columns)}
    extra = sorted((name, at) for at, name in enumerate(columns) if name not in MANDATORY_COLUMNS)
    folded = fold_columns([F.col(f"_c{at}") for _, at in extra])
    typed = {name: _typed(name, place[name]) for name in MANDATORY_COLUMNS}
    # Values are made once, in a step of their own, and then looked at.
    read = rows.select("*", *(value.alias(name) for name, value in typed.items()))
    unread = {
        name: place[name].isNotNull() & F.col(name).isNull()
        for name in MANDATORY_COLUMNS
        if FACT_TYPES[name] != "string"
    }
    torn = F.col(TORN_ROW).isNotNull()
    any_unread = reduce(Column.__or__, unread.values())
    # Lists of names are made row by row in interpreted code, so only for rows that need them.
    names = F.array_compact(F.array(*(F.when(is_unread, F.lit(name)) for name, is_unread in unread.items())))
    failed = (
        F.when(torn, F.array(F.lit(ROW_WIDTH)))
        .when(any_unread, names)
        .otherwise(F.array().cast("array<string>"))
    )
    raw = F.to_json(F.struct(*(F.col(f"_c{at}").alias(label) for at, label in enumerate(_labels(columns)))))
    return read.select(
        *(F.when(~torn, F.col(name)).alias(name) for name in typed),
        F.when(~torn, folded).alias(EXTRA_COLUMN),
        "file_path",
        failed.alias("failed_columns"),
        F.when(torn, F.col(TORN_ROW)).when(any_unread, raw).alias("raw_row"),
    )


def union_groups(spark: SparkSession, groups: Iterable[HeaderGroup]) -> DataFrame:
    """All accepted files as one bag of rows, one CSV scan per distinct header."""
    frames = [
        conform_group(read_csv_group(spark, group.paths, len(group.columns)), group.columns)
        for group in groups
        if group.reason is None
    ]
    if not frames:
        return spark.createDataFrame([], CONFORMED_SCHEMA)
    return reduce(DataFrame.unionByName, frames)


def facts_only(conformed: DataFrame) -> DataFrame:
    """Rows whose every field was read, in fact columns."""
    return conformed.filter(F.size("failed_columns") == 0).select(*FACT_COLUMNS)


def refused_lines(spark: SparkSession, groups: Iterable[HeaderGroup]) -> DataFrame:
    """Every line of the refused files, with the reason and the missing columns."""
    by_reason: dict[tuple, list[str]] = defaultdict(list)
    for group in groups:
        if group.reason is not None:
            by_reason[group.reason, tuple(group.missing)] += group.paths
    frames = [
        read_raw_lines(spark, paths).select(
            "raw_line",
            "file_path",
            F.array(*map(F.lit, missing)).cast("array<string>").alias("missing_columns"),
            F.lit(reason).alias("reason"),
        )
        for (reason, missing), paths in by_reason.items()
    ]
    if not frames:
        return spark.createDataFrame([], REFUSED_SCHEMA)
    return reduce(DataFrame.unionByName, frames)
