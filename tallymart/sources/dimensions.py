"""Customer, store and sales-team tables, checked before anything is joined to them."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallymart.sources import storage
from tallymart.sources.tables import read_parquet, stage

# Up to this many bytes a dimension is shipped to every executor. Its rows count with
# their text; where only the keys are needed, each counts as an entry of a hash table.
BROADCAST_BYTES = 64 * 1024 * 1024
BYTES_PER_KEY = 24


class DuplicateKey(Exception):
    """A dimension key occurs twice; joining would multiply sales."""


@dataclass(frozen=True, eq=False)
class Dimension:
    """One dimension under unique column names, keyed like the fact column it extends.

    ``small`` and ``small_keys`` tell whether its rows, or at least its keys, have been
    found to fit into a broadcast.
    """

    key: str
    rows: DataFrame
    small: bool
    small_keys: bool

    def keys(self) -> DataFrame:
        return self.rows.select(self.key)


@dataclass(frozen=True)
class Dimensions:
    customers: Dimension
    stores: Dimension
    sellers: Dimension

    def all(self) -> tuple[Dimension, Dimension, Dimension]:
        return self.customers, self.stores, self.sellers


def fingerprint(dimensions: Dimensions) -> str:
    """Equal for dimensions of equal rows, whatever their order; one pass over the three tables."""
    hashed = [
        dimension.rows.select(F.xxhash64(F.lit(dimension.key), F.to_json(F.struct("*"))).cast("decimal(38,0)").alias("row"))
        for dimension in dimensions.all()
    ]
    rows = hashed[0].unionByName(hashed[1]).unionByName(hashed[2])
    found = rows.agg(F.count("*").alias("rows"), F.sum("row").alias("hash")).first()
    return f"{found['rows']}-{found['hash']}"


def customer_columns(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        F.col("first_name").alias("customer_first_name"),
        F.col("last_name").alias("customer_last_name"),
        F.col("address").alias("customer_address"),
        F.col("pincode").alias("customer_pincode"),
        "phone_number",
    )


def store_columns(stores: DataFrame) -> DataFrame:
    return stores.select(
        F.col("id").alias("store_id"),
        F.col("address").alias("store_address"),
        "store_manager_name",
    )


def seller_columns(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        F.col("id").alias("sales_person_id"),
        F.col("first_name").alias("sales_person_first_name"),
        F.col("last_name").alias("sales_person_last_name"),
        "manager_id",
        "is_manager",
        F.col("address").alias("sales_person_address"),
        F.col("pincode").alias("sales_person_pincode"),
    )


@dataclass(frozen=True)
class Measure:
    """What one dimension was found to hold: keys, and bytes of its rows with their text."""

    keys: int
    bytes: int


def keyed_tables(customers: DataFrame, stores: DataFrame, sellers: DataFrame) -> dict[str, DataFrame]:
    """The three dimensions under unique column names, without rows that have no key."""
    tables = {
        "customer_id": customer_columns(customers),
        "store_id": store_columns(stores),
        "sales_person_id": seller_columns(sellers),
    }
    return {key: rows.filter(F.col(key).isNotNull()) for key, rows in tables.items()}


def measured(tables: dict[str, DataFrame]) -> dict[str, Measure]:
    """Refuse repeated keys and measure sizes, in one job over all tables.

    Sizes are counted, not estimated, so no table is broadcast merely because its
    source reports no statistics.
    """
    keyed = None
    for key, rows in tables.items():
        sized = rows.select(
            F.lit(key).alias("dimension"),
            F.col(key).cast("string").alias("key"),
            F.octet_length(F.to_json(F.struct("*"))).cast("bigint").alias("bytes"),
        )
        keyed = sized if keyed is None else keyed.unionByName(sized)
    per_key = keyed.groupBy("dimension", "key").agg(F.count("*").alias("copies"), F.sum("bytes").alias("bytes"))
    profile = per_key.groupBy("dimension").agg(
        F.count("*").alias("keys"),
        F.sum("bytes").alias("bytes"),
        F.max("copies").alias("copies"),
        F.max_by("key", "copies").alias("worst"),
    )
    found = {row["dimension"]: row for row in profile.collect()}
    for key, row in found.items():
        if row["copies"] > 1:
            raise DuplicateKey(f"{key} {row['worst']} occurs {row['copies']} times in its dimension")
    return {key: Measure(found[key]["keys"], found[key]["bytes"]) if key in found else Measure(0, 0) for key in tables}


def assembled(tables: dict[str, DataFrame], measures: dict[str, Measure], broadcast_bytes: int) -> Dimensions:
    return Dimensions(
        *(
            Dimension(
                key,
                tables[key],
                small=measures[key].bytes <= broadcast_bytes,
                small_keys=measures[key].keys * BYTES_PER_KEY <= broadcast_bytes,
            )
            for key in ("customer_id", "store_id", "sales_person_id")
        )
    )


def checked_dimensions(
    customers: DataFrame,
    stores: DataFrame,
    sellers: DataFrame,
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> Dimensions:
    """Refuse repeated keys, and measure which dimensions fit into a broadcast."""
    tables = keyed_tables(customers, stores, sellers)
    return assembled(tables, measured(tables), broadcast_bytes)


# Versions: dimensions that have not changed are not read again to be checked.


def file_fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Changes when a file of these tables does: names, sizes and times of change, not content."""
    listed = [(path, sorted(storage.files(spark, path).items())) for path in paths]
    return hashlib.sha256(json.dumps(listed).encode()).hexdigest()


def current_dimensions(
    spark: SparkSession,
    folder: str,
    fingerprint: str,
    load: Callable[[], tuple[DataFrame, DataFrame, DataFrame]],
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> Dimensions:
    """The dimensions as last checked, or, if the fingerprint of their sources is another, checked anew.

    ``load`` gives the customer, store and sales-team tables. A new version is written beside the
    old ones and described by a manifest: sizes and schemas, so that reading it takes no job at all.
    A version with a repeated key is refused and not kept. Of two processes that
    write the same version at once, one's copy is used by both.
    """
    path = f"{folder}/manifest-{hashlib.sha256(fingerprint.encode()).hexdigest()}.json"
    manifest = storage.read_json(spark, path)
    if manifest is None:
        tables = keyed_tables(*load())
        root = f"{folder}/version={uuid.uuid4().hex}"
        staged = {key: stage(rows, f"{root}/{key}") for key, rows in tables.items()}
        measures = measured(staged)
        described = {
            key: {"keys": m.keys, "bytes": m.bytes, "path": f"{root}/{key}", "schema": staged[key].schema.jsonValue()}
            for key, m in measures.items()
        }
        storage.create_new(spark, path, json.dumps(described))
        manifest = storage.read_json(spark, path)
    tables = {
        key: read_parquet(spark, entry["path"], StructType.fromJson(entry["schema"])) for key, entry in manifest.items()
    }
    measures = {key: Measure(entry["keys"], entry["bytes"]) for key, entry in manifest.items()}
    return assembled(tables, measures, broadcast_bytes)
