"""The queries the driver runs, each from the tables of one data directory."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from tallymart.functions.columns import fold_columns, full_name, incentive, month_of
from tallymart.operators import conform, ledger, sinks
from tallymart.operators.aggregates import attach_group_sum, sum_cost, with_month
from tallymart.operators.joins import add_dimension, enrich
from tallymart.plans import daily_run, marts
from tallymart.schemas import ACTIVE, FACT_COLUMNS, INACTIVE, MANDATORY_COLUMNS, REFUSED_SCHEMA
from tallymart.sources import files as raw_files
from tallymart.sources import standin
from tallymart.sources.dimensions import Dimension, Dimensions
from tallymart.sources.landing import landing_folder, resent_folder, stored_sales
from tallymart.sources.tables import read_parquet
from tallymart.streaming.feed import start_sales_stream
from tallymart.workspace import once, shared_folder

Query = Callable[[SparkSession, str], DataFrame]

FIRST_RUN = dt.datetime(2024, 3, 1, 6, 0, tzinfo=dt.UTC)
SECOND_RUN = dt.datetime(2024, 3, 2, 6, 0, tzinfo=dt.UTC)
FIRST_MONTH = "1998-07"

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_month(standin.sales(spark, sf_dir))


def _many_customers(spark: SparkSession, sf_dir: str) -> Dimensions:
    """The dimensions as they are treated when customers do not fit into a broadcast."""
    dimensions = standin.dimensions(spark, sf_dir)
    return replace(dimensions, customers=replace(dimensions.customers, small=False, small_keys=False))


# Monthly marts


@query
def sales_incentive_mart(spark, sf_dir):
    return marts.sales_incentive(_months(spark, sf_dir), standin.dimensions(spark, sf_dir))


@query
def customer_monthly_mart(spark, sf_dir):
    return marts.customer_monthly(_months(spark, sf_dir), standin.dimensions(spark, sf_dir))


@query
def sales_incentive_mart_many_customers(spark, sf_dir):
    return marts.sales_incentive(with_month(stored_sales(spark, sf_dir)), _many_customers(spark, sf_dir))


@query
def customer_monthly_mart_many_customers(spark, sf_dir):
    return marts.customer_monthly(with_month(stored_sales(spark, sf_dir)), _many_customers(spark, sf_dir))


@query
def sales_monthly_total(spark, sf_dir):
    return sum_cost(_months(spark, sf_dir), ["store_id", "sales_person_id", "sales_month"], "total_sales")


@query
def customer_daily_purchases(spark, sf_dir):
    return marts.daily_purchases(standin.sales(spark, sf_dir), standin.dimensions(spark, sf_dir))


@query
def distinct_customer_month(spark, sf_dir):
    return marts.customers_by_month(_months(spark, sf_dir), standin.dimensions(spark, sf_dir))


@query
def distinct_salesperson_month(spark, sf_dir):
    return marts.sellers_by_month(_months(spark, sf_dir), standin.dimensions(spark, sf_dir))


# Group totals on every row, and ranks


@query
def window_customer_month_sum(spark, sf_dir):
    rows = with_month(stored_sales(spark, sf_dir)).select("customer_id", "sales_month", "total_cost")
    keys = ["customer_id", "sales_month"]
    return attach_group_sum(rows, keys, "total_sales_every_month_by_each_customer")


@query
def window_salesperson_month_sum(spark, sf_dir):
    keys = ["store_id", "sales_person_id", "sales_month"]
    rows = with_month(stored_sales(spark, sf_dir)).select(*keys, "total_cost")
    return attach_group_sum(rows, keys, "total_sales_every_month")


@query
def rank_salesperson(spark, sf_dir):
    return marts.rank_sellers(marts.seller_monthly(_months(spark, sf_dir), standin.dimensions(spark, sf_dir)))


# Dimensions and joins


@query
def dim_customer(spark, sf_dir):
    return standin.customers(spark, sf_dir)


@query
def dim_store(spark, sf_dir):
    return standin.stores(spark, sf_dir)


@query
def dim_sales_team(spark, sf_dir):
    return standin.sellers(spark, sf_dir)


@query
def dim_product(spark, sf_dir):
    return standin.products(spark, sf_dir)


def _joined(spark, sf_dir, pick: Callable[..., Dimension]) -> DataFrame:
    return add_dimension(standin.sales(spark, sf_dir), pick(standin.dimensions(spark, sf_dir)))


@query
def join_customer(spark, sf_dir):
    return _joined(spark, sf_dir, lambda dimensions: dimensions.customers)


@query
def join_store(spark, sf_dir):
    return _joined(spark, sf_dir, lambda dimensions: dimensions.stores)


@query
def join_sales_team(spark, sf_dir):
    return _joined(spark, sf_dir, lambda dimensions: dimensions.sellers)


@query
def enriched_sales(spark, sf_dir):
    return enrich(standin.sales(spark, sf_dir), standin.dimensions(spark, sf_dir))


@query
def enriched_sales_many_customers(spark, sf_dir):
    return enrich(stored_sales(spark, sf_dir), _many_customers(spark, sf_dir))


# Row-level marts and sinks, read back from what was written


@query
def customer_mart_rows(spark, sf_dir):
    rows = marts.customer_rows(standin.sales(spark, sf_dir), standin.dimensions(spark, sf_dir))
    path = shared_folder(spark, "customer-rows")
    sinks.write_snapshot(rows, path)
    return read_parquet(spark, path, rows.schema)


@query
def sales_mart_rows(spark, sf_dir):
    rows = marts.sales_rows(standin.sales(spark, sf_dir), standin.dimensions(spark, sf_dir))
    path = shared_folder(spark, "sales-rows")
    sinks.write_snapshot(rows, path)
    return read_parquet(spark, path, rows.schema)


@query
def mart_partition_read(spark, sf_dir):
    rows = marts.sales_rows(standin.sales(spark, sf_dir), standin.dimensions(spark, sf_dir))
    path = shared_folder(spark, "sales-by-month")
    sinks.write_partitioned(rows, path, ["sales_month", "store_id"])
    return read_parquet(spark, path, rows.schema)


@query
def versioned_publish(spark, sf_dir):
    """Two published runs, one of a month and one of all sales; a reader finds the second."""
    dimensions = standin.dimensions(spark, sf_dir)
    rows = marts.sales_rows(standin.sales(spark, sf_dir), dimensions)
    folder = shared_folder(spark, "published")
    columns = ["sales_month", "store_id"]
    of_month = rows.filter(F.col("sales_month") == FIRST_MONTH)
    sinks.publish_version(of_month, folder, FIRST_RUN, columns)
    sinks.publish_version(rows, folder, SECOND_RUN, columns)
    latest = sinks.read_latest_version(spark, folder, rows.schema)
    return latest.withColumn("run_epoch", F.lit(sinks.latest_version(spark, folder)).cast("bigint"))


@query
def versioned_publish_flat(spark, sf_dir):
    """The same for customers, whose versions are not partitioned further."""
    rows = marts.customer_rows(standin.sales(spark, sf_dir), standin.dimensions(spark, sf_dir))
    folder = shared_folder(spark, "published-flat")
    sinks.publish_version(rows.filter(month_of(F.col("sales_date")) == FIRST_MONTH), folder, FIRST_RUN)
    sinks.publish_version(rows, folder, SECOND_RUN)
    return sinks.read_latest_version(spark, folder, rows.schema)


@query
def incentive_report(spark, sf_dir):
    mart = marts.sales_incentive(_months(spark, sf_dir), standin.dimensions(spark, sf_dir))
    report = marts.incentive_report(mart)
    path = shared_folder(spark, "incentive-report")
    sinks.write_csv(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


@query
def preview_limit(spark, sf_dir):
    order = ["sales_date", "customer_id", "store_id", "sales_person_id", "total_cost"]
    rows = enriched_sales(spark, sf_dir).select(*order, "phone_number", "store_manager_name")
    return sinks.preview(rows, order)


# Scalar expressions over whole tables


@query
def expr_month(spark, sf_dir):
    lines = standin.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("sales_date"))
    return lines.select(
        "sales_date",
        month_of(F.col("sales_date")).alias("sales_month"),
        F.expr("date_format(sales_date, 'yyyy-MM')").alias("sales_month_sql"),
    )


@query
def expr_full_name(spark, sf_dir):
    return standin.customers(spark, sf_dir).select(
        "customer_id", full_name(F.col("first_name"), F.col("last_name")).alias("full_name")
    )


@query
def expr_concat_ws(spark, sf_dir):
    orders = standin.table(spark, sf_dir, "orders")
    extra = [F.col("o_orderpriority"), F.nullif(F.col("o_orderstatus"), F.lit("P"))]
    return orders.select("o_orderkey", fold_columns(extra).alias("additional_column"))


@query
def expr_incentive(spark, sf_dir):
    """The incentive expression on every line, those without tax counting as top sales."""
    lines = standin.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_tax", "l_extendedprice")
    total = F.col("l_extendedprice").cast("decimal(18,2)")
    return lines.select(
        "l_orderkey",
        total.alias("total_sales"),
        incentive(total, F.col("l_tax") == 0).alias("incentive"),
    )


# Raw files: listing, gate, conformance, quarantine


def _feed(path: str):
    return F.regexp_extract(path, r"/feed=([a-z]+)/", 1).alias("feed")


def _year(path: str):
    return F.regexp_extract(path, r"/sales_year=(\d+)/", 1).cast("int").alias("sales_year")


def _sales_files(spark: SparkSession, sf_dir: str, landing: Callable[..., str] = landing_folder) -> DataFrame:
    """Data files of a landing folder; Spark's own marker files are left out."""
    return raw_files.file_inventory(spark, landing(spark, sf_dir)).filter(~F.col("file_name").startswith("_"))


def _groups(
    spark: SparkSession, sf_dir: str, landing: Callable[..., str] = landing_folder
) -> list[conform.HeaderGroup]:
    files = _sales_files(spark, sf_dir, landing).filter("is_csv")
    return conform.header_groups(conform.gate_headers(conform.read_headers(spark, files)))


@query
def file_inventory(spark, sf_dir):
    """Bytes of content per feed and year: those of the files less their header lines."""
    files = _sales_files(spark, sf_dir)
    raw_files.require_files(files)
    header = F.coalesce(F.length("header_line") + 1, F.lit(0))
    headers = conform.read_headers(spark, files.filter("is_csv"))
    return files.join(headers, "file_path", "left").groupBy(_feed("file_path"), _year("file_path"), "is_csv").agg(
        F.sum(F.col("size_bytes") - header).alias("content_bytes")
    )


@query
def schema_gate(spark, sf_dir):
    files = _sales_files(spark, sf_dir).filter("is_csv")
    gated = conform.gate_headers(conform.read_headers(spark, files))
    return gated.select(
        _feed("file_path"),
        _year("file_path"),
        F.array_join("columns", "|").alias("columns"),
        F.array_join("missing_columns", "|").alias("missing_columns"),
        F.coalesce("reason", F.lit("accepted")).alias("verdict"),
    ).distinct()


@query
def union_files(spark, sf_dir):
    """All accepted files as one bag of typed rows, failed fields NULL."""
    return conform.union_groups(spark, _groups(spark, sf_dir)).select(*FACT_COLUMNS)


@query
def ingest_sales(spark, sf_dir):
    """Every sale of the accepted files that can be read, those that came torn from the line sent again."""
    folder = shared_folder(spark, "ingest")
    daily_run.ingest(spark, _groups(spark, sf_dir, resent_folder), folder)
    return daily_run.read_stored(spark, folder, daily_run.ACCEPTED).select(*FACT_COLUMNS)


@query
def quarantine_rows(spark, sf_dir):
    """Rows with a field that could not be read, and every line of the refused files."""
    folder = shared_folder(spark, "quarantine")
    groups = _groups(spark, sf_dir)
    daily_run.ingest(spark, groups, f"{folder}/rows")
    daily_run.refuse(spark, groups, f"{folder}/files")
    rows = daily_run.read_stored(spark, f"{folder}/rows", daily_run.REJECTED).select(
        _feed("file_path"),
        F.lit("unreadable_fields").alias("reason"),
        F.array_join("failed_columns", "|").alias("columns"),
        F.col("raw_row").alias("raw"),
    )
    header = ",".join(name for name in MANDATORY_COLUMNS if name != "store_id") + ",payment_mode"
    lines = (
        read_parquet(spark, f"{folder}/files", REFUSED_SCHEMA)
        .filter(F.col("raw_line") != header)
        .select(
            _feed("file_path"),
            "reason",
            F.array_join("missing_columns", "|").alias("columns"),
            F.col("raw_line").alias("raw"),
        )
    )
    return rows.unionByName(lines)


# File ledger. The first run finished the plain and reversed feeds and died on the
# extended one; the partial feed has never been started.


def _ledger(spark: SparkSession, files: DataFrame) -> DataFrame:
    path = shared_folder(spark, "ledger")
    started = files.filter(_feed("file_path").isin("plain", "reversed", "extended"))
    ledger.append_events(ledger.ledger_events(started, ACTIVE, FIRST_RUN, "run-1"), path)
    finished = files.filter(_feed("file_path").isin("plain", "reversed"))
    ledger.append_events(ledger.ledger_events(finished, INACTIVE, SECOND_RUN, "run-1"), path)
    return ledger.read_ledger(spark, path)


@query
def ledger_latest(spark, sf_dir):
    files = _sales_files(spark, sf_dir).filter("is_csv")
    latest = ledger.latest_status(_ledger(spark, files))
    return latest.select(_feed("file_path"), _year("file_path"), "status", "run_id").distinct()


@query
def ledger_open_files(spark, sf_dir):
    files = _sales_files(spark, sf_dir).filter("is_csv")
    found = ledger.open_files(files, _ledger(spark, files))
    return found.select(_feed("file_path"), _year("file_path"), "run_id").distinct()


@query
def ledger_pending_files(spark, sf_dir):
    files = _sales_files(spark, sf_dir).filter("is_csv")
    found = ledger.pending_files(files, _ledger(spark, files))
    return found.select(_feed("file_path"), _year("file_path")).distinct()


# Whole runs: once in batch, once as a stream of files


@query
def batch_run_sales_mart(spark, sf_dir):
    store = daily_run.Store(shared_folder(spark, "batch-run"))
    daily_run.daily_run(
        spark,
        landing_folder(spark, sf_dir),
        store,
        lambda: standin.dimensions(spark, sf_dir),
        "run-1",
        FIRST_RUN,
    )
    return daily_run.read_sales_incentive(spark, store)


def _run_stream(spark: SparkSession, sf_dir: str, landing: str, root: str) -> None:
    stream = start_sales_stream(
        spark,
        landing,
        daily_run.Store(f"{root}/store"),
        lambda: standin.dimensions(spark, sf_dir),
        f"{root}/checkpoint",
        files_per_batch=20,
    )
    stream.awaitTermination()


@query
def broken_stream_sales_mart(spark, sf_dir):
    """A stream dies in its first batch and loses its checkpoint; the next one finishes what it had entered."""
    root = shared_folder(spark, "broken-stream")

    def unreachable():
        raise ConnectionError("the dimensions cannot be read")

    landing, store = landing_folder(spark, sf_dir), daily_run.Store(f"{root}/store")
    dying = start_sales_stream(spark, landing, store, unreachable, f"{root}/lost", name="dying", files_per_batch=20)
    try:
        dying.awaitTermination()
    except StreamingQueryException:
        pass
    dimensions = standin.dimensions(spark, sf_dir)
    start_sales_stream(spark, landing, store, lambda: dimensions, f"{root}/next", files_per_batch=40).awaitTermination()
    return daily_run.read_sales_incentive(spark, store)


def _streamed(spark: SparkSession, sf_dir: str) -> daily_run.Store:
    """The store a stream over the whole landing folder has filled, once per session."""
    landing = landing_folder(spark, sf_dir)
    root = once(spark, f"stream {sf_dir}", lambda root: _run_stream(spark, sf_dir, landing, root))
    return daily_run.Store(f"{root}/store")


def _streamed_whole(spark: SparkSession, sf_dir: str) -> daily_run.Store:
    """The same of the folder in which torn lines are sent again."""
    landing = resent_folder(spark, sf_dir)
    root = once(spark, f"stream-resent {sf_dir}", lambda root: _run_stream(spark, sf_dir, landing, root))
    return daily_run.Store(f"{root}/store")


@query
def stream_ingest(spark, sf_dir):
    return daily_run.read_facts(spark, _streamed(spark, sf_dir))


@query
def stream_sales_mart(spark, sf_dir):
    return daily_run.read_sales_incentive(spark, _streamed(spark, sf_dir))


@query
def stream_customer_mart(spark, sf_dir):
    """Every readable sale counts, those that came torn from the line sent again."""
    return daily_run.read_customer_monthly(spark, _streamed_whole(spark, sf_dir))
