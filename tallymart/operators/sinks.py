"""Sinks: snapshots, partitioned and versioned Parquet, CSV reports, JDBC."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators.joins import join_on
from tallymart.operators.ledger import as_utc
from tallymart.sources.files import file_inventory


# Tables are written once and read few times: bytes count for more than the time to pack them.
# The lowest level packs these tables as small as the codec's own default, in less time.
PACKED = "zstd"
PACKED_LEVEL = {"parquet.compression.codec.zstd.level": "1"}


def write_snapshot(df: DataFrame, path: str, *, mode: str = "overwrite", data_format: str = "parquet") -> None:
    writer = df.write.format(data_format).mode(mode)
    if data_format == "parquet":
        writer = writer.option("compression", PACKED).options(**PACKED_LEVEL)
    writer.save(path)


def gather_by(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bring the rows of an output partition together, so that it gets few files.

    REBALANCE lets adaptive execution split a partition that outgrows its advisory
    size and merge small ones, so a dominant store and month is written by many
    tasks. Sizes are only known at run time; the plan is the same for all of them.
    """
    return df.hint("rebalance", *(F.col(column) for column in columns))


def write_partitioned(
    df: DataFrame,
    path: str,
    columns: list[str],
    *,
    gather: bool = True,
    replace_touched: bool = False,
) -> None:
    """Parquet partitioned by columns; optionally only the touched partitions are replaced."""
    rows = gather_by(df, columns) if gather else df
    writer = rows.write.mode("overwrite").option("compression", PACKED).options(**PACKED_LEVEL).partitionBy(*columns)
    if replace_touched:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


# The characters that Spark writes as codes in the names of partition directories.
ESCAPED = frozenset('"#%\'*/:=?\\{[]^\x7f') | {chr(code) for code in range(32)}


def partition_folder(column: str, value: str) -> str:
    """The directory of a partition value, as Spark's own writers name it."""
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in value)


def epoch_millis(run_ts: dt.datetime) -> int:
    """Whole seconds of the run time, as milliseconds."""
    return int(as_utc(run_ts).timestamp()) * 1000


def epoch_millis_column(run_ts: Column) -> Column:
    """The same for a timestamp column."""
    return F.unix_seconds(run_ts) * F.lit(1000)


def publish_version(
    df: DataFrame,
    folder: str,
    run_ts: dt.datetime,
    partition_columns: list[str] | None = None,
    run_id: str = "run",
) -> str:
    """Write one run's output into its own directory; other runs stay as they are.

    Run times are whole seconds, so the run's id is part of the path: runs of one
    second are one version and stand side by side in it.
    """
    path = f"{folder}/run_epoch={epoch_millis(run_ts)}/{partition_folder('run_id', run_id)}"
    if partition_columns:
        write_partitioned(df, path, partition_columns)
    else:
        write_snapshot(df, path)
    return path


def latest_run(spark: SparkSession, folder: str) -> tuple[int, str]:
    """Run time and id of the newest published run, found by listing file names; of one second, the last by id."""
    epoch = F.nullif(F.regexp_extract("file_path", r"/run_epoch=(\d+)/", 1), F.lit("")).cast("bigint")
    run = F.regexp_extract("file_path", r"/run_id=([^/]+)/", 1)
    newest = file_inventory(spark, folder).agg(F.max(F.struct(epoch.alias("epoch"), run.alias("run_id"))).alias("run"))
    return tuple(newest.first()["run"])


def latest_version(spark: SparkSession, folder: str) -> int:
    return latest_run(spark, folder)[0]


def read_latest_version(spark: SparkSession, folder: str, schema=None) -> DataFrame:
    """What the newest run has published, and nothing of any other run, be it of the same second."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    epoch, run_id = latest_run(spark, folder)
    return reader.parquet(f"{folder}/run_epoch={epoch}/run_id={run_id}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], *, connections: int = 8) -> None:
    """Append to a database table; errors are raised, never swallowed.

    Months that may be appended again, as after a late file or a failed run, are to be ``tagged``.
    One connection per partition, so the number of partitions is limited first.
    """
    df.repartition(connections).write.jdbc(url, table, mode="append", properties=properties)


def tagged(df: DataFrame, month: str, run_id: str, moment: dt.datetime | None = None) -> DataFrame:
    """Months to be appended to a table that only takes appends, so that appending them again does no harm.

    Every row tells its run, its export and the number of rows that the export has of its
    month. ``newest_export`` finds a month's rows by these.
    """
    moment = as_utc(moment or dt.datetime.now(dt.UTC))
    sizes = df.groupBy(month).agg(F.count("*").alias("export_rows"))
    # A row per month.
    return join_on(df, F.broadcast(sizes), [month]).withColumns(
        {
            "run_id": F.lit(run_id),
            "export_id": F.lit(uuid.uuid4().hex),
            "exported_at": F.timestamp_micros(F.lit(int(moment.timestamp() * 1_000_000))),
        }
    )


def newest_export(rows: DataFrame, month: str) -> DataFrame:
    """Of a table of tagged rows the newest whole export of each month; one that broke off does not count."""
    exports = rows.groupBy(month, "export_id").agg(
        F.max("exported_at").alias("exported_at"), F.max("export_rows").alias("_wanted"), F.count("*").alias("_found")
    )
    whole = exports.filter(F.col("_wanted") == F.col("_found"))
    newest = whole.groupBy(month).agg(F.max(F.struct("exported_at", "export_id"))["export_id"].alias("export_id"))
    found = join_on(rows, newest, [month, "export_id"], "left_semi")
    return found.drop("export_rows", "run_id", "export_id", "exported_at")


def preview(df: DataFrame, order: list[str], rows: int = 20) -> DataFrame:
    """The first rows under a total order; the rest is never sorted as a whole."""
    return df.orderBy(*order).limit(rows)
