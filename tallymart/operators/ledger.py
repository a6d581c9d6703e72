"""File ledger: an append-only table of events, one per file and state change.

Nothing is updated in place. A file's state is its latest event, so two runs can
write at the same time and a lost run leaves its files visibly open.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tallymart.functions.columns import base_name
from tallymart.schemas import ACTIVE, INACTIVE, LEDGER_SCHEMA, REFUSED


def as_utc(moment: dt.datetime) -> dt.datetime:
    """Run times without a zone are UTC, whatever the zone of driver and session."""
    return moment if moment.tzinfo else moment.replace(tzinfo=dt.UTC)


def ledger_events(
    files: DataFrame, status: str | Column, event_ts: dt.datetime, run_id: str, attempt: int = 0
) -> DataFrame:
    """One event per file. The full path is the key: names repeat across folders."""
    return files.select(
        "file_path",
        base_name(F.col("file_path")).alias("file_name"),
        (F.lit(status) if isinstance(status, str) else status).alias("status"),
        F.timestamp_micros(F.lit(int(as_utc(event_ts).timestamp() * 1_000_000))).alias("event_ts"),
        F.lit(run_id).alias("run_id"),
        F.lit(attempt).cast("int").alias("attempt"),
    )


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All events; a ledger nobody has written yet is empty."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def latest_status(events: DataFrame) -> DataFrame:
    """Latest state per file. At equal times the closing event counts."""
    order = F.struct("event_ts", "status", "run_id")
    last = events.groupBy("file_path", "file_name").agg(F.max(order).alias("last"))
    return last.select("file_path", "file_name", "last.status", "last.event_ts", "last.run_id")


def open_files(files: DataFrame, events: DataFrame) -> DataFrame:
    """Present files that a run has started and not finished, with that run's id and time."""
    started = latest_status(events).filter(F.col("status") == ACTIVE).select(
        "file_path", "run_id", "event_ts"
    )
    return files.select("file_path", "file_name").join(started, "file_path").distinct()


def vanished_files(files: DataFrame, events: DataFrame) -> DataFrame:
    """Files that a run has started and not finished and that are no longer there."""
    started = latest_status(events).filter(F.col("status") == ACTIVE)
    return started.join(files.select("file_path"), "file_path", "left_anti").select("file_path", "run_id")


def pending_files(files: DataFrame, events: DataFrame) -> DataFrame:
    """Present files no run has finished, be it by taking them in or by refusing them."""
    finished = latest_status(events).filter(F.col("status").isin(INACTIVE, REFUSED)).select("file_path")
    return files.join(finished, "file_path", "left_anti")
