"""Table reads: Parquet, and JDBC split over several connections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Connections a table is read over, where it can be split.
CONNECTIONS = 8


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A Parquet table; a schema fixes the types of its partition columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    *,
    split_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = CONNECTIONS,
) -> DataFrame:
    """A database table. With a split column Spark reads key ranges over several connections.

    The bounds only place the cuts; rows outside them are still read. Where they are not
    given, the database is asked for the smallest and the largest key first.
    """
    if split_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if bounds is None:
        asked = f"(SELECT min({split_column}) AS low, max({split_column}) AS high FROM {table}) key_range"
        found = spark.read.jdbc(url, asked, properties=properties).first()
        if found["low"] is None:
            # No row has a key: there is nothing to split.
            return spark.read.jdbc(url, table, properties=properties)
        bounds = (found["low"], found["high"])
    return spark.read.jdbc(
        url,
        table,
        column=split_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=properties,
    )


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write a table to Parquet and read it back.

    A JDBC table has no size Spark can plan with, and would be queried again by
    every action; the staged copy has both a size and a stable content.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
