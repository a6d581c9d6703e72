"""Where intermediate tables go: the folder all executors share."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import SparkSession

from tallymart.sources import storage


@lru_cache(maxsize=1)
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tallymart-")


def shared_root(spark: SparkSession) -> str:
    """The folder below the cluster's ``spark.checkpoint.dir`` that holds all intermediate tables.

    Only a local session without that setting falls back to a temporary folder;
    on a cluster a machine-local folder would lose data with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        # Executors of local-cluster are processes of their own; local and local[n] have none.
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/tallymart"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def clean_shared(spark: SparkSession, seconds: float) -> int:
    """Remove intermediate tables that were written longer ago than any job takes; how many there were.

    A table is read as long as a result made from it is, so only their age tells that they are done with.
    """
    root, oldest = shared_root(spark), (time.time() - seconds) * 1000
    old = [name for name, changed in storage.entries(spark, root).items() if changed < oldest]
    for name in old:
        storage.delete(spark, f"{root}/{name}")
    return len(old)


_written: dict[tuple[str, str], str] = {}


def once(spark: SparkSession, name: str, write: Callable[[str], None]) -> str:
    """Path of something that is written once per session, however many queries ask for it."""
    key = (spark.conf.get("spark.app.id", ""), name)
    if key not in _written:
        path = shared_folder(spark, name.split()[0])
        write(path)
        _written[key] = path
    return _written[key]
