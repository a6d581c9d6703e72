"""Stored sales and a landing folder of raw files, written from the driver's order tables.

Feeds differ in their header, as the shops that send them do. Together they carry
every order line once:

* ``plain``     returned flag A, line status O: the mandatory columns in order
* ``reversed``  A, F: the same columns the other way round
* ``extended``  N: two further columns, one of them sometimes empty
* ``partial``   R: no ``store_id``, so these files are to be refused
* ``notes``     customer names as ``.txt``: not sales at all

In ``reversed``, lines without tax say ``n/a`` for their total, and in ``plain`` lines of the
highest tax have a line break within the product, so that such a row is torn in two. Both
must end in quarantine. In a second folder the shops have noticed what was torn: there ``plain`` carries
each such line once more, whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators.sinks import write_snapshot
from tallymart.schemas import MANDATORY_COLUMNS
from tallymart.sources import standin
from tallymart.sources.tables import read_parquet
from tallymart.workspace import once

# The tax of order lines whose row is torn.
TORN_TAX = 0.08

def stored_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales of the order tables as one table, for queries that read them repeatedly."""
    sales = standin.sales(spark, sf_dir)
    path = once(spark, f"sales {sf_dir}", lambda path: write_snapshot(sales, path))
    return read_parquet(spark, path, sales.schema)


def landing_folder(spark: SparkSession, sf_dir: str) -> str:
    return once(spark, f"landing {sf_dir}", lambda path: write_landing(spark, sf_dir, path))


def resent_folder(spark: SparkSession, sf_dir: str) -> str:
    """The same files, with torn lines sent again whole: no sale is lost but those refused or unreadable."""
    return once(spark, f"landing-resent {sf_dir}", lambda path: write_landing(spark, sf_dir, path, resent=True))


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = standin.sold_lines(
        spark,
        sf_dir,
        "l_partkey",
        "l_quantity",
        "l_returnflag",
        "l_linestatus",
        "l_tax",
        order_columns=("o_orderstatus", "o_orderpriority"),
    )
    return standin.add_product(lines, spark, sf_dir).select(
        *MANDATORY_COLUMNS,
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("payment_mode"),
        F.col("o_orderpriority").alias("channel"),
        F.year("sales_date").alias("sales_year"),
        F.col("l_tax").alias("tax"),
        F.when(F.col("l_returnflag") == "R", "partial")
        .when(F.col("l_returnflag") == "N", "extended")
        .when(F.col("l_linestatus") == "O", "plain")
        .otherwise("reversed")
        .alias("feed"),
    )


def _staged_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_sales(spark, sf_dir)
    path = once(spark, f"raw-sales {sf_dir}", lambda path: write_snapshot(rows, path))
    return read_parquet(spark, path, rows.schema)


def write_landing(spark: SparkSession, sf_dir: str, folder: str, *, resent: bool = False) -> None:
    staged = _staged_sales(spark, sf_dir)
    refused = F.when(F.col("tax") == 0, "n/a").otherwise(F.col("total_cost").cast("string"))
    # A line without a product has nothing to tear.
    is_torn = (F.col("tax") == TORN_TAX) & F.col("product_name").isNotNull()
    torn = F.when(is_torn, F.concat("product_name", F.lit("\nagain"))).otherwise(F.col("product_name"))
    plain = staged.withColumn("product_name", torn)
    if resent:
        plain = plain.unionByName(staged.filter(is_torn))
    feeds = {
        "plain": plain.select(*MANDATORY_COLUMNS, "sales_year", "feed"),
        "reversed": staged.withColumn("total_cost", refused).select(
            *reversed(MANDATORY_COLUMNS), "sales_year", "feed"
        ),
        "extended": staged.select("payment_mode", *MANDATORY_COLUMNS, "channel", "sales_year", "feed"),
        "partial": staged.select(
            *(name for name in MANDATORY_COLUMNS if name != "store_id"), "payment_mode", "sales_year", "feed"
        ),
    }
    for feed, rows in feeds.items():
        (
            rows.filter(F.col("feed") == feed)
            .drop("feed")
            .hint("rebalance", F.col("sales_year"))
            .write.partitionBy("sales_year")
            .option("header", True)
            .csv(f"{folder}/feed={feed}")
        )
    standin.table(spark, sf_dir, "customer").select("c_name").write.text(f"{folder}/feed=notes/sales_year=0")
