"""Raw sales files: listing, header lines and the CSV scan."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.columns import base_name, canonical_path, decoded_path

LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
CSV_SUFFIX = ".csv"

# Stores a task can open by itself to read no more than a file's first block.
OPENABLE = ("file", "s3", "s3a", "gs", "abfs", "abfss")

# Column with the text of rows that do not have the header's number of fields.
TORN_ROW = "torn_row"


class NoSalesData(Exception):
    """There is nothing to work on: no file, no CSV file, or no acceptable one."""


def file_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below a folder. The content column is pruned, so no file is read.

    Spark leaves out files of zero bytes, which hold neither a header nor sales.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return describe_files(listing)


def describe_files(listing: DataFrame) -> DataFrame:
    """Key, name and kind of each listed file; works on a batch and on a stream."""
    path = canonical_path(F.col("path"))
    return listing.select(
        path.alias("file_path"),
        base_name(path).alias("file_name"),
        F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"),
        path.endswith(CSV_SUFFIX).alias("is_csv"),
    )


def require_files(inventory: DataFrame) -> None:
    """Fail early, with the reason, when a listing cannot lead to any sales."""
    seen = inventory.agg(F.count("*").alias("files"), F.count_if("is_csv").alias("csv")).first()
    if not seen["files"]:
        raise NoSalesData("no files to process")
    if not seen["csv"]:
        raise NoSalesData("no CSV files to process")


# A header is looked for in this many bytes; a file whose first line is longer has none.
HEADER_BYTES = 1 << 20


def first_line(stream, most: int = HEADER_BYTES) -> str | None:
    """The first line that is not blank; None if there is none, or none that ends within ``most`` bytes.

    Blocks are searched once each, and what is left of one is at most a line.
    """
    held, seen, ended = b"", 0, False
    while not ended and seen < most:
        block = stream.read(min(1 << 16, most - seen))
        ended = not block
        held = (held if seen else b"") + block
        seen += len(block)
        *lines, rest = re.split(rb"\r\n|\n|\r", held) if ended or re.search(rb"[\r\n]", block) else [held]
        for line in [*lines, rest] if ended else lines:
            line = line.removeprefix(b"\xef\xbb\xbf")
            if line.strip():
                return line.decode("utf-8", "replace")
        held = rest
    return None


def opened_by_arrow():
    """A function from a path to Arrow's file system for it and its name there, for use within a task."""
    from pyarrow import fs as pafs

    stores = {}

    def locate(path):
        scheme, _, rest = path.partition("://")
        if scheme == "file":
            return stores.setdefault("file", pafs.LocalFileSystem()), rest
        authority, _, key = rest.partition("/")
        scheme = "s3" if scheme == "s3a" else scheme
        if (scheme, authority) not in stores:
            stores[scheme, authority] = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
        store, root = stores[scheme, authority]
        return store, f"{root.rstrip('/')}/{key}"

    return locate


def header_lines(files: DataFrame, opened: Callable = opened_by_arrow) -> DataFrame:
    """First non-blank line of each listed file, read by opening the files in tasks.

    Costs one small read per file, in constant memory. A text scan would give the same lines
    but read every byte of every file to get them. ``opened`` is called in each task;
    stores with endpoints or credentials of their own are opened by a function of one's own.
    """

    def open_files(batches):
        import pandas as pd

        locate = opened()

        def header(path):
            store, name = locate(path)
            with store.open_input_stream(name) as stream:
                return first_line(stream)

        for batch in batches:
            yield pd.DataFrame(
                {"file_path": batch["file_path"], "header_line": [header(path) for path in batch["file_path"]]},
                columns=["file_path", "header_line"],
            )

    return files.select("file_path").mapInPandas(open_files, "file_path string, header_line string")


def scanned_header_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The same lines through Spark's text reader, for stores tasks cannot open."""
    lines = (
        spark.read.text([escape_glob(path) for path in paths])
        .select("value", "_metadata.file_path", "_metadata.file_block_start")
        .filter((F.col("file_block_start") == 0) & (F.trim("value") != ""))
    )
    numbered = lines.select(
        decoded_path(F.col("file_path")).alias("file_path"), "value", F.monotonically_increasing_id().alias("at")
    )
    heads = numbered.groupBy("file_path").agg(F.min_by(F.struct("value"), "at").alias("first"))
    line = F.regexp_replace("first.value", "^\ufeff", "")
    return heads.select("file_path", F.when(F.octet_length(line) <= HEADER_BYTES, line).alias("header_line"))


def openable(path: Column) -> Column:
    return F.substring_index(path, "://", 1).isin(*OPENABLE)


def escape_glob(path: str) -> str:
    """Readers expand wildcards; listed names must be taken literally."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_csv_group(spark: SparkSession, paths: Sequence[str], width: int) -> DataFrame:
    """Files that share one header line, as text columns named by position.

    Positional names keep odd or repeated header names apart; the caller maps
    them, knowing the one header all these files have. ``torn_row`` is the text of a row
    that has more or fewer fields than the header, as after an open quote, else NULL.
    """
    schema = ", ".join([*(f"_c{at} string" for at in range(width)), f"{TORN_ROW} string"])
    reader = spark.read.schema(schema).option("header", True).option("columnNameOfCorruptRecord", TORN_ROW)
    # A parser that skips fields nobody asks for would not count them.
    rows = reader.option("columnPruning", False).csv([escape_glob(path) for path in paths])
    return rows.select("*", decoded_path(F.col("_metadata.file_path")).alias("file_path"))


def read_raw_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Refused files line by line, unparsed."""
    lines = spark.read.text([escape_glob(path) for path in paths])
    return lines.select(
        F.col("value").alias("raw_line"),
        decoded_path(F.col("_metadata.file_path")).alias("file_path"),
    )
