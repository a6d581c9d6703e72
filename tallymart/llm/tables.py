"""Reading the given tables, and tables that cut lineage between steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymart.workspace import shared_folder

# Bytes that are no part of a word once A-Z is in lower case: all of ASCII but letters and digits.
# Everything outside ASCII is part of a word.
NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    Later steps read files that every executor sees, so neither a lost executor
    nor a second use repeats the work behind them.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame) -> DataFrame:
    """``row``, all columns of each row as one, beside ``doc_id`` and ``text``; unpacked by ``row.*``.

    So whatever columns a table has, their names clash with none that an operator adds.
    """
    return docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"), "doc_id", "text")


def fold_number(key: str, folds: int) -> Column:
    """The CRC-32 of an id's text modulo ``folds``; a missing id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % folds


def sample_per_value(rows: DataFrame, key: str, value: str, per_value: int) -> DataFrame:
    """For each value the ``per_value`` rows with the smallest hash of their key.

    Values are counted first, and of a common value only rows whose hash lies below four
    times the share that is needed are put in order, so no task sees more than a few
    times ``per_value`` rows of a value. Values must be few: their counts are broadcast.
    """
    if per_value < 1:
        raise ValueError("per_value must be at least 1")
    place = F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string")), 11) / F.lit(float(2**53))
    counts = rows.groupBy(value).agg(F.count("*").alias("_rows"))
    low = rows.join(F.broadcast(counts), value).withColumn("_place", place)
    low = low.filter(F.col("_place") * F.col("_rows") < 4 * per_value)
    order = Window.partitionBy(value).orderBy("_place", key)
    ranked = low.withColumn("_nth", F.row_number().over(order)).filter(F.col("_nth") <= per_value)
    return ranked.drop("_nth", "_place", "_rows")
