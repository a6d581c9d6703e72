"""Sales files as a stream: each micro-batch takes its new files through a run."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallymart.operators.snapshots import LEASE_SECONDS
from tallymart.plans.daily_run import Export, Store, finish_open_runs, process_files, process_pending
from tallymart.sources.dimensions import Dimensions
from tallymart.sources.files import LISTING_SCHEMA, NoSalesData, describe_files, file_inventory

# The file source forgets, and then skips, files that are this much older than the newest one
# it has seen. The ledger does not forget: what the source skips is taken by the sweeps.
MAX_AGE_SECONDS = 7 * 24 * 3600
# Batches from one sweep to the next.
SWEEP_EVERY = 50


def new_files(
    spark: SparkSession,
    landing: str,
    *,
    files_per_batch: int = 1000,
    max_age: float = MAX_AGE_SECONDS,
    archive: str | None = None,
) -> DataFrame:
    """Stream of the files that arrive in a folder: names, not content.

    Streaming the names lets every batch look at its files' headers first; a CSV
    stream has one schema and would read reordered columns into wrong places.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", f"{int(max_age)}s")
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return describe_files(reader.load(landing))


def skipped_files(spark: SparkSession, landing: str, max_age: float) -> DataFrame:
    """Files so much older than the newest one that the source may have forgotten, or never seen, them."""
    listed = file_inventory(spark, landing)
    newest = listed.agg(F.unix_micros(F.max("modified_at")).alias("newest")).first()["newest"] or 0
    return listed.filter(F.unix_micros("modified_at") < newest - int(max_age * 1_000_000))


def start_sales_stream(
    spark: SparkSession,
    landing: str,
    store: Store,
    load_dimensions: Callable[[], Dimensions],
    checkpoint: str,
    *,
    name: str = "stream",
    files_per_batch: int = 1000,
    archive: str | None = None,
    publish: bool = False,
    export: Export | None = None,
    lease: float = LEASE_SECONDS,
    max_age: float = MAX_AGE_SECONDS,
    sweep_every: int = SWEEP_EVERY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep facts and marts up to date with the files that arrive.

    A batch may be delivered twice. Its number and its files name its run, and the
    checkpoint fixes its files, so the second delivery finishes the first, or finds nothing to
    do. Files that another run has entered are left out, so streams and batch runs can
    share a store. Runs that died, of this stream or any other writer, are finished before
    every batch; a run whose owner renews its lease of ``lease`` seconds is left to it.

    What the source remembers is bounded by ``max_age``. Files that come so late that it skips them
    are found by sweeps, at the start and every ``sweep_every`` batches: the folder is
    listed, and files older than that age which the ledger does not know are processed.
    """

    options = {"publish": publish, "export": export, "lease": lease}

    def sweep() -> None:
        now = dt.datetime.now(dt.UTC)
        late = skipped_files(spark, landing, max_age)
        with suppress(NoSalesData):
            process_pending(spark, late, store, load_dimensions, f"{name}-late-{now:%Y%m%dT%H%M%S%f}", now, **options)

    def run(batch: DataFrame, batch_id: int) -> None:
        run_ts = dt.datetime.now(dt.UTC)
        finish_open_runs(spark, store, load_dimensions, **options)
        if batch_id and batch_id % sweep_every == 0:
            sweep()
        # The sum does not depend on the order of the files.
        names = batch.select(F.xxhash64("file_path").cast("decimal(38,0)").alias("name"))
        total = names.agg(F.coalesce(F.sum("name"), F.lit(0))).first()[0]
        run_id = f"{name}-{batch_id:09d}-{int(total) % 2**64:016x}"
        try:
            process_files(spark, batch, store, load_dimensions, run_id, run_ts, **options)
        except NoSalesData:
            # All files of the batch were refused; their lines are kept, the stream goes on.
            return

    # What died may have been the last that came: nothing new need arrive for it to be finished.
    finish_open_runs(spark, store, load_dimensions, **options)
    sweep()
    files = new_files(spark, landing, files_per_batch=files_per_batch, max_age=max_age, archive=archive)
    return (
        files.select("file_path")
        .writeStream.queryName(name)
        .foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
