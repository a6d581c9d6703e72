"""Sharding by a permutation-filled lookup table.

Every shard has a preference order over the slots of a table of prime size: a
start and a step, both hashed from its name. The shards take turns; whose turn
it is claims the first slot on its list that is still free. All shards end up
with the same number of slots but one, and when a shard is taken away most slots
keep their owner. A row's slot is the hash of its key modulo the table size, and
a broadcast of the table (its size is a parameter, so it does not grow with the
data) tells the shard.

The table is filled on the driver, as turns are sequential and the table is small
by definition; rows are placed by built-in functions only, without a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = tuple(f"shard-{i:02d}" for i in range(16))
TABLE_SIZE = 2039
# A broadcast table of this many slots is below 10 MB.
MAX_TABLE_SIZE = 655_373


def name_number(name: str, purpose: str) -> int:
    """The first 60 bits of the MD5 of a shard's name and a purpose."""
    return int(hashlib.md5(f"{purpose}:{name}".encode()).hexdigest()[:15], 16)


def key_number(key: Column) -> Column:
    """The same number for a row's key; a missing key counts as the empty text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(F.lit("key:"), text).cast("binary")), 1, 15), 16, 10).cast("bigint")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % i for i in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], table_size: int) -> list[int]:
    """Owner of each slot, as an index into ``shards``."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if not is_prime(table_size) or not len(shards) <= table_size <= MAX_TABLE_SIZE:
        raise ValueError(f"table_size must be a prime between the number of shards and {MAX_TABLE_SIZE}")
    place = [name_number(name, "start") % table_size for name in shards]
    step = [name_number(name, "step") % (table_size - 1) + 1 for name in shards]
    owner = [-1] * table_size
    for turn in range(table_size):
        shard = turn % len(shards)
        while owner[place[shard]] >= 0:
            place[shard] = (place[shard] + step[shard]) % table_size
        owner[place[shard]] = shard
    return owner


def table_frame(spark: SparkSession, shards: Sequence[str], table_size: int) -> DataFrame:
    """The lookup table with columns ``slot`` and ``shard``."""
    listed = ",".join(map(str, fill_table(shards, table_size)))
    owners = spark.range(1).select(F.posexplode(F.split(F.lit(listed), ",")).alias("slot", "owner"))
    names = F.array(*(F.lit(name) for name in shards))
    return owners.select("slot", F.get(names, F.col("owner").cast("int")).alias("shard"))


def assign_shards(
    rows: DataFrame,
    key: str = "doc_id",
    shards: Sequence[str] = SHARDS,
    table_size: int = TABLE_SIZE,
) -> DataFrame:
    """All rows with the columns ``slot`` and ``shard`` added, in a single pass.

    Rows with a NULL key share the slot of the empty key. Rows with equal keys
    share a shard; an empty table stays empty. Columns named ``slot`` or ``shard``
    are replaced. Texts are not looked at, so their length does not matter.
    """
    rows = rows.drop("slot", "shard")
    slot = F.pmod(key_number(F.col(key)), F.lit(table_size)).cast("int")
    table = F.broadcast(table_frame(rows.sparkSession, shards, table_size))
    # A left join, although every slot has an owner: no row may go missing.
    return rows.withColumn("slot", slot).join(table, "slot", "left").select(*rows.columns, "slot", "shard")


ORACLE = f"""
WITH RECURSIVE shards AS (
  SELECT i, 'shard-' || lpad(CAST(i AS VARCHAR), 2, '0') AS name FROM range({len(SHARDS)}) t(i)
), numbers AS (
  SELECT i, CAST('0x' || substr(md5('start:' || name), 1, 15) AS BIGINT) % {TABLE_SIZE} AS start,
         CAST('0x' || substr(md5('step:' || name), 1, 15) AS BIGINT) % {TABLE_SIZE - 1} + 1 AS step
  FROM shards
), claims(turn, taken, slot, shard) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]), CAST(-1 AS BIGINT), CAST(-1 AS BIGINT)
  UNION ALL
  SELECT turn + 1, list_append(taken, free), free, n.i
  FROM (
    SELECT c.turn, c.taken, n.i,
           (list_filter(list_transform(range({TABLE_SIZE}), lambda j: (n.start + j * n.step) % {TABLE_SIZE}),
                        lambda s: NOT list_contains(c.taken, s)))[1] AS free
    FROM claims c JOIN numbers n ON n.i = c.turn % {len(SHARDS)}
    WHERE c.turn < {TABLE_SIZE}
  ) n
), owners AS (SELECT slot, shard FROM claims WHERE slot >= 0)
SELECT d.doc_id, CAST(o.slot AS INTEGER) AS slot, 'shard-' || lpad(CAST(o.shard AS VARCHAR), 2, '0') AS shard
FROM (
  SELECT doc_id, CAST('0x' || substr(md5('key:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT)
                 % {TABLE_SIZE} AS slot
  FROM documents
) d JOIN owners o USING (slot)
"""
