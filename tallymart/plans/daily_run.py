"""Runs over the files that wait in a landing folder, from raw CSV to marts.

A run enters its files, writes everything under its own name, and then makes files,
totals and months count in one step, by a new snapshot of the store. A run that died is finished
under its old id by whoever comes next: what its first attempt has written counts for nothing,
and should that attempt still be alive, its last step fails.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.functions.columns import month_of
from tallymart.operators import conform, ledger, sinks, snapshots
from tallymart.operators.aggregates import monthly_cube, sum_cost
from tallymart.operators.snapshots import LEASE_SECONDS, Entry, Month, Run, Snapshot
from tallymart.plans import marts
from tallymart.schemas import (
    ACTIVE,
    CUSTOMER_MONTH_SCHEMA,
    FACT_COLUMNS,
    INACTIVE,
    LEDGER_SCHEMA,
    REFUSED,
    REFUSED_SCHEMA,
    SALES_INCENTIVE_SCHEMA,
    STORED_SCHEMA,
    TOTALS_SCHEMA,
)
from tallymart.sources import storage
from tallymart.sources.dimensions import Dimensions, fingerprint
from tallymart.sources.files import CSV_SUFFIX, NoSalesData, file_inventory, require_files
from tallymart.sources.tables import read_parquet

# Takes the refreshed months of the customer and sales marts, those months, and the run's id.
Export = Callable[[DataFrame, DataFrame, list[str | None], str], None]

TOTALS_KEYS = ("customer_id", "store_id", "sales_person_id", "sales_month")

ACCEPTED = "accepted"
REJECTED = "rejected"

# Files an error names, and files of one run: their names pass through the driver, as they do in
# every reader. A larger backlog becomes several runs.
NAMED_FILES = 20
FILES_PER_RUN = 10_000
# Ledger entries of one level that become one of the next.
ENTRIES_PER_LEVEL = 16


class UnfinishedRun(Exception):
    """An earlier run started files it never finished."""


@dataclass(frozen=True)
class Store:
    """Folders of the sales store, all on the shared object store or file system."""

    root: str

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def facts(self) -> str:
        return f"{self.root}/facts"

    @property
    def refused_files(self) -> str:
        return f"{self.root}/refused_files"

    @property
    def run_totals(self) -> str:
        return f"{self.root}/run_totals"

    @property
    def totals(self) -> str:
        return f"{self.root}/monthly_totals"

    @property
    def customer_rows(self) -> str:
        return f"{self.root}/customer_rows"

    @property
    def sales_rows(self) -> str:
        return f"{self.root}/sales_rows"

    @property
    def sales_by_month_and_store(self) -> str:
        return f"{self.root}/sales_by_month_and_store"

    @property
    def customer_monthly(self) -> str:
        return f"{self.root}/customer_monthly"

    @property
    def sales_incentive(self) -> str:
        return f"{self.root}/sales_incentive"


def run_folder(folder: str, run_id: str, attempt: int) -> str:
    """Where one attempt of a run writes; no other attempt does."""
    return f"{folder}/{sinks.partition_folder('run_id', run_id)}/attempt={attempt}"


def read_events(spark: SparkSession, store: Store, snapshot: Snapshot | None = None) -> DataFrame:
    """The ledger's events as of a snapshot, the newest by default."""
    entries = (snapshot or snapshots.latest(spark, store.root)).ledger
    if not entries:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    paths = [f"{store.ledger}/change={entry.name}" for entry in entries]
    return spark.read.schema(LEDGER_SCHEMA).option("basePath", store.ledger).parquet(*paths).drop("change")


def _of_finished(spark: SparkSession, store: Store, rows: DataFrame, statuses: list[str]) -> DataFrame:
    """Rows that the attempt has written which finished its run."""
    finished = read_events(spark, store).filter(F.col("status").isin(statuses)).select("run_id", "attempt").distinct()
    return rows.join(finished, ["run_id", "attempt"], "left_semi")


def read_stored(spark: SparkSession, folder: str, status: str) -> DataFrame:
    """Rows of one status below a folder of facts; the condition is on a partition column."""
    return read_parquet(spark, folder, STORED_SCHEMA).filter(F.col("row_status") == status)


def read_facts(spark: SparkSession, store: Store, run_id: str | None = None) -> DataFrame:
    """Accepted facts of finished runs."""
    stored = read_stored(spark, store.facts, ACCEPTED)
    if run_id is not None:
        stored = stored.filter(F.col("run_id") == run_id)
    return _of_finished(spark, store, stored, [INACTIVE]).select(*FACT_COLUMNS)


REJECTED_COLUMNS = ("file_path", "failed_columns", "raw_row", "run_id")


def read_rejected_rows(spark: SparkSession, store: Store) -> DataFrame:
    """Rows of finished runs that could not be read."""
    return _of_finished(spark, store, read_stored(spark, store.facts, REJECTED), [INACTIVE]).select(*REJECTED_COLUMNS)


def read_refused_lines(spark: SparkSession, store: Store) -> DataFrame:
    """Lines of the files that finished runs have refused."""
    lines = read_parquet(spark, store.refused_files, f"{REFUSED_SCHEMA}, run_id string, attempt int")
    return _of_finished(spark, store, lines, [REFUSED]).drop("attempt")


def _by_parts(snapshot: Snapshot, mart: str) -> tuple[list[tuple[str | None, str | None]], ...]:
    """Months and directories of a mart: of months with one part, and of those with several."""
    whole = [(month, getattr(entry, mart)) for month, entry in snapshot.months.items() if not entry.older]
    split = [(month, entry) for month, entry in snapshot.months.items() if entry.older]
    return whole, [(month, getattr(part, mart)) for month, entry in split for part in entry.parts()]


def read_customer_monthly(spark: SparkSession, store: Store) -> DataFrame:
    """The customers' mart; what several parts of a month have of a customer is added up."""
    whole, parted = _by_parts(snapshots.latest(spark, store.root), "customers")

    def read(names: list[tuple[str | None, str | None]]) -> DataFrame:
        return snapshots.read_months(spark, store.customer_monthly, names, "sales_date_month", CUSTOMER_MONTH_SCHEMA)

    return read(whole).unionByName(marts.added_customers(read(parted))) if parted else read(whole)


def read_sales_incentive(spark: SparkSession, store: Store) -> DataFrame:
    """The sellers' mart; the best seller of a month of several parts is found by the sums of all."""
    whole, parted = _by_parts(snapshots.latest(spark, store.root), "sellers")

    def read(names: list[tuple[str | None, str | None]]) -> DataFrame:
        return snapshots.read_months(spark, store.sales_incentive, names, "sales_month", SALES_INCENTIVE_SCHEMA)

    return read(whole).unionByName(marts.added_sellers(read(parted))) if parted else read(whole)


def read_totals(spark: SparkSession, store: Store, snapshot: Snapshot, months: list[str | None]) -> DataFrame:
    """The additive totals of some months: few directories each, however many runs they come from."""
    known = [month for month in months if month in snapshot.months]
    names = [(month, part.totals) for month in known for part in snapshot.months[month].parts()]
    return snapshots.read_months(spark, store.totals, names, "sales_month", TOTALS_SCHEMA)


def ingest(spark: SparkSession, groups: list[conform.HeaderGroup], folder: str) -> None:
    """Accepted files to typed rows, sound and failed ones in one pass over the text.

    No shuffle: a daily file holds few months, so its tasks write few files.
    """
    conformed = conform.union_groups(spark, groups)
    rows = conformed.withColumns(
        {
            "row_status": F.when(F.size("failed_columns") == 0, ACCEPTED).otherwise(REJECTED),
            "sales_month": month_of(F.col("sales_date")),
        }
    )
    sinks.write_partitioned(rows, folder, ["row_status", "sales_month"], gather=False)


def refuse(spark: SparkSession, groups: list[conform.HeaderGroup], folder: str) -> None:
    sinks.write_partitioned(conform.refused_lines(spark, groups), folder, ["reason"], gather=False)


def publish_rows(
    facts: DataFrame, dimensions: Dimensions, store: Store, run_ts: dt.datetime, run_id: str
) -> None:
    """This run's row-level marts, each version in its own directory."""
    sinks.publish_version(marts.customer_rows(facts, dimensions), store.customer_rows, run_ts, run_id=run_id)
    sales = marts.sales_rows(facts, dimensions)
    written = sinks.publish_version(sales, store.sales_rows, run_ts, run_id=run_id)
    # The partitioned copy comes from the written one, so the joins run once.
    copy = read_parquet(facts.sparkSession, written, sales.schema)
    columns = ["sales_month", "store_id"]
    sinks.publish_version(copy, store.sales_by_month_and_store, run_ts, columns, run_id)


def in_months(column: str, months: list[str | None]) -> Column:
    """A condition on partition values only, with sales of no date as a month of their own."""
    named = F.col(column).isin([month for month in months if month is not None])
    return named | F.col(column).isNull() if None in months else named


def write_marts(
    spark: SparkSession, store: Store, dimensions: Dimensions, totals: DataFrame, name: str
) -> tuple[set[str | None], set[str | None]]:
    """Both monthly marts of some totals as new directories; the months that have rows in each."""
    spent = marts.customer_totals(totals, dimensions)
    if dimensions.customers.small:
        # Names come by a broadcast: the sums are gathered without them, as names are most of a row.
        customers = marts.named_customers(sinks.gather_by(spent, ["sales_month"]), dimensions)
    else:
        customers = sinks.gather_by(marts.named_customers(spent, dimensions), ["sales_date_month"])
    sellers = sinks.gather_by(marts.sales_incentive(totals, dimensions), ["sales_month"])
    return (
        set(snapshots.write_months(customers, store.customer_monthly, name, "sales_date_month")),
        set(snapshots.write_months(sellers, store.sales_incentive, name, "sales_month")),
    )


def refresh_months(
    spark: SparkSession,
    store: Store,
    dimensions: Dimensions,
    months: list[str | None] | None = None,
) -> None:
    """Recompute both monthly marts for some months, or all, as after a change of the dimensions.

    The new months take the place of the old ones in one step. A month whose totals
    another run has changed meanwhile is computed again. Months of several parts become one.
    """
    made_by = fingerprint(dimensions)
    while True:
        base = snapshots.latest(spark, store.root)
        chosen = [month for month in base.months if months is None or month in months]
        if not chosen:
            return
        name = snapshots.new_name()
        parted = [month for month in chosen if base.months[month].older]
        rows = {month: base.months[month].rows for month in chosen}
        if parted:
            sums = sum_cost(read_totals(spark, store, base, parted), TOTALS_KEYS, "total_cost")
            rows |= snapshots.write_months(
                sinks.gather_by(sums, ["sales_month"]), store.totals, name, "sales_month"
            )
        names = {month: name if month in parted else base.months[month].totals for month in chosen}
        totals = snapshots.read_months(spark, store.totals, list(names.items()), "sales_month", TOTALS_SCHEMA)
        customers, sellers = write_marts(spark, store, dimensions, totals, name)
        new = {
            month: Month(
                names[month],
                name if month in customers else None,
                name if month in sellers else None,
                rows[month],
                made_by,
            )
            for month in chosen
        }
        if _committed(spark, store, base, chosen, lambda now, new=new: replace(now, months=now.months | new)):
            return


def _committed(
    spark: SparkSession,
    store: Store,
    base: Snapshot,
    months: list[str | None],
    update: Callable[[Snapshot], Snapshot],
) -> bool:
    """Apply an update that was computed from ``base``; False if its months have changed since."""
    now = base
    while True:
        if any(now.months.get(month) != base.months.get(month) for month in months):
            return False
        if snapshots.commit(spark, store.root, now, update(now)):
            return True
        now = snapshots.latest(spark, store.root)


@dataclass(frozen=True)
class Claim:
    """An attempt at a run, which no other process has."""

    run_id: str
    attempt: int
    started: dt.datetime

    def version(self) -> str:
        """The name its published rows stand under; a later attempt's is the newer version, and its own."""
        return f"{self.run_id}~{self.attempt}" if self.attempt else self.run_id


def write_events(events: DataFrame, store: Store) -> Entry:
    """Events as a directory of its own, which counts once a snapshot names it."""
    entry = Entry(snapshots.new_name())
    events.write.parquet(f"{store.ledger}/change={entry.name}")
    return entry


def not_entered(files: DataFrame, events: DataFrame) -> DataFrame:
    """Files that have no event.

    Paths of a batch lie close to each other, as their folders are named by days. Merged entries of
    the ledger are in order of paths, so what lies outside the batch's range is not read.
    """
    span = files.agg(F.min("file_path").alias("low"), F.max("file_path").alias("high")).first()
    if span["low"] is None:
        return files
    entered = events.filter(F.col("file_path").between(span["low"], span["high"])).select("file_path")
    return files.join(entered, "file_path", "left_anti")


def enter(
    spark: SparkSession, store: Store, files: DataFrame, run_id: str, run_ts: dt.datetime
) -> Claim | None:
    """Enter files for a new run; None if there are none that are not entered yet.

    Files that any run has entered, be it a batch or a stream, are that run's and are left out.
    Of two processes that want the same files, one sees what the other has entered.
    """
    started = ledger.as_utc(run_ts)
    claim = Claim(run_id, 0, started)
    while True:
        base = snapshots.latest(spark, store.root)
        mine = not_entered(files, read_events(spark, store, base)).select("file_path").distinct()
        entry = write_events(ledger.ledger_events(mine, ACTIVE, started, run_id), store)
        written = spark.read.schema(LEDGER_SCHEMA).parquet(f"{store.ledger}/change={entry.name}")
        if written.isEmpty():
            return None
        if run_id in base.runs:
            raise UnfinishedRun(f"run {run_id} has not finished")
        run = Run(0, int(started.timestamp() * 1_000_000))
        snapshots.sign(spark, store.root, run_id, 0)
        new = replace(base, ledger=[*base.ledger, entry], runs=base.runs | {run_id: run})
        if snapshots.commit(spark, store.root, base, new):
            return claim


def take_over(spark: SparkSession, store: Store, run_id: str) -> Claim | None:
    """The next attempt at a run that is open and whose owner gives no sign of life, else None."""
    while True:
        base = snapshots.latest(spark, store.root)
        run = base.runs.get(run_id)
        if run is None or snapshots.is_alive(spark, store.root, run_id, run.attempt):
            return None
        new = replace(base, runs=base.runs | {run_id: replace(run, attempt=run.attempt + 1)})
        snapshots.sign(spark, store.root, run_id, run.attempt + 1)
        if snapshots.commit(spark, store.root, base, new):
            started = dt.datetime.fromtimestamp(run.started_us / 1_000_000, dt.UTC)
            return Claim(run_id, run.attempt + 1, started)


def compact_ledger(spark: SparkSession, store: Store) -> None:
    """Make one entry of many, in order of paths, so that the ledger is read from few directories however
    many runs there were, and only where the paths asked for lie."""
    while True:
        base = snapshots.latest(spark, store.root)
        levels = {entry.level for entry in base.ledger}
        full = [level for level in levels if sum(e.level == level for e in base.ledger) >= ENTRIES_PER_LEVEL]
        if not full:
            return
        level = min(full)
        merged = [entry for entry in base.ledger if entry.level == level]
        events = read_events(spark, store, replace(base, ledger=merged))
        ordered = events.repartitionByRange("file_path").sortWithinPartitions("file_path")
        entry = replace(write_events(ordered, store), level=level + 1)
        rest = [e for e in base.ledger if e.level != level]
        if not snapshots.commit(spark, store.root, base, replace(base, ledger=[*rest, entry])):
            continue


def _finished_events(files: DataFrame, claim: Claim, statuses: Column) -> DataFrame:
    """Closing events carry the time of closing, which is not before the start."""
    now = max(dt.datetime.now(dt.UTC), claim.started)
    return ledger.ledger_events(files, statuses, now, claim.run_id, claim.attempt)


def _added_totals(before: DataFrame, totals: DataFrame, known: list[str | None]) -> DataFrame:
    """A run's totals, added to those of the parts they are merged with; gathered by month.

    Months without such parts take the run's rows as they are, which are summed and gathered already.
    """
    if not known:
        return totals
    had = F.coalesce(in_months("sales_month", known), F.lit(False))
    sums = sum_cost(before.unionByName(totals.filter(had)), TOTALS_KEYS, "total_cost")
    return sinks.gather_by(sums, ["sales_month"]).unionByName(totals.filter(~had))


def count_run(
    spark: SparkSession, store: Store, claim: Claim, totals: DataFrame, dimensions: Dimensions, events: DataFrame
) -> list[str | None]:
    """Add a run's totals to its months, as new parts of them, and finish its files, in one step.

    Months are partition names, no more than the calendar has. If another run has changed one
    of them since they were read, they are read and computed again. Which earlier parts of a month the
    new one takes in depends on their sizes, so that many runs do not write a month as many times.
    """
    counts = totals.groupBy("sales_month").agg(F.count("*").alias("rows")).collect()
    added_rows = {row["sales_month"]: row["rows"] for row in counts}
    months, made_by = list(added_rows), fingerprint(dimensions)
    entry = write_events(events, store)
    while True:
        base = snapshots.latest(spark, store.root)
        snapshots.own_run(base, claim.run_id, claim.attempt)
        name = snapshots.new_name()
        known = [month for month in months if month in base.months]
        kept = {month: base.months[month].kept(added_rows[month], made_by) for month in known}
        merged = [
            (month, part.totals) for month in known for part in base.months[month].parts()[len(kept[month]) :]
        ]
        before = snapshots.read_months(spark, store.totals, merged, "sales_month", TOTALS_SCHEMA)
        added = _added_totals(before, totals, list(dict.fromkeys(month for month, _ in merged)))
        rows = snapshots.write_months(added, store.totals, name, "sales_month")
        names = [(month, name) for month in months]
        written = snapshots.read_months(spark, store.totals, names, "sales_month", TOTALS_SCHEMA)
        customers, sellers = write_marts(spark, store, dimensions, written, name) if months else (set(), set())
        new = {
            month: Month(
                name,
                name if month in customers else None,
                name if month in sellers else None,
                rows[month],
                made_by,
                kept.get(month, []),
            )
            for month in months
        }

        def counted(now: Snapshot, new=new) -> Snapshot:
            run = snapshots.own_run(now, claim.run_id, claim.attempt)
            runs = now.runs | {claim.run_id: replace(run, months=months)}
            return replace(now, months=now.months | new, ledger=[*now.ledger, entry], runs=runs)

        if _committed(spark, store, base, months, counted):
            return months


def work_off(
    spark: SparkSession,
    store: Store,
    claim: Claim,
    load_dimensions: Callable[[], Dimensions],
    *,
    publish: bool = True,
    export: Export | None = None,
    lease: float = LEASE_SECONDS,
) -> None:
    """Take the files of a run through all steps. A run that counts already is only exported."""

    def close(now: Snapshot) -> Snapshot:
        snapshots.own_run(now, claim.run_id, claim.attempt)
        return replace(now, runs={name: run for name, run in now.runs.items() if name != claim.run_id})

    with snapshots.alive(spark, store.root, claim.run_id, claim.attempt, lease):
        run = snapshots.own_run(snapshots.latest(spark, store.root), claim.run_id, claim.attempt)
        months = run.months
        if months is None:
            months = _count_files(spark, store, claim, load_dimensions, publish)
        if months is None:
            snapshots.change(spark, store.root, close)
            raise NoSalesData("every file was refused")
        if export is not None and months:
            export(
                read_customer_monthly(spark, store).filter(in_months("sales_date_month", months)),
                read_sales_incentive(spark, store).filter(in_months("sales_month", months)),
                months,
                claim.run_id,
            )
        snapshots.change(spark, store.root, close)
    compact_ledger(spark, store)


def _count_files(
    spark: SparkSession, store: Store, claim: Claim, load_dimensions: Callable[[], Dimensions], publish: bool
) -> list[str | None] | None:
    """Make the files of a run count; the months it has touched, or None if all its files were refused."""
    events = read_events(spark, store)
    files = events.filter((F.col("run_id") == claim.run_id) & (F.col("status") == ACTIVE)).select("file_path")
    csv = F.col("file_path").endswith(CSV_SUFFIX)
    gated = conform.stored_headers(conform.gate_headers(conform.read_headers(spark, files.filter(csv))))
    groups = conform.header_groups(gated)
    status = F.when(F.col("reason").isNull(), F.lit(INACTIVE)).otherwise(F.lit(REFUSED))
    named = gated.select("file_path", status.alias("status"))
    others = files.filter(~csv).select("file_path", F.lit(REFUSED).alias("status"))
    closing = _finished_events(named.unionByName(others), claim, F.col("status"))
    if any(group.reason is not None for group in groups):
        refuse(spark, groups, run_folder(store.refused_files, claim.run_id, claim.attempt))
    if all(group.reason is not None for group in groups):
        entry = write_events(closing, store)
        snapshots.change(spark, store.root, lambda now: replace(now, ledger=[*now.ledger, entry]))
        return None
    facts_folder = run_folder(store.facts, claim.run_id, claim.attempt)
    ingest(spark, groups, facts_folder)
    dimensions = load_dimensions()
    facts = read_stored(spark, facts_folder, ACCEPTED).select(*FACT_COLUMNS)
    if publish:
        publish_rows(facts, dimensions, store, claim.started, claim.version())
    path = run_folder(store.run_totals, claim.run_id, claim.attempt)
    sinks.write_partitioned(monthly_cube(facts), path, ["sales_month"])
    return count_run(spark, store, claim, read_parquet(spark, path, TOTALS_SCHEMA), dimensions, closing)


def process_files(
    spark: SparkSession,
    files: DataFrame,
    store: Store,
    load_dimensions: Callable[[], Dimensions],
    run_id: str,
    run_ts: dt.datetime,
    **options,
) -> bool:
    """Take files through a whole run; False if none is left to be entered.

    The set is fixed when it is entered: files that arrive later belong to the next run.
    A run of this id that is open and has no live owner is finished with the files it has.
    """
    again = take_over(spark, store, run_id)
    if again is not None:
        work_off(spark, store, again, load_dimensions, **options)
    claim = None if again is not None else enter(spark, store, files, run_id, run_ts)
    if claim is not None:
        work_off(spark, store, claim, load_dimensions, **options)
    return again is not None or claim is not None


def finish_open_runs(
    spark: SparkSession,
    store: Store,
    load_dimensions: Callable[[], Dimensions],
    *,
    resume: bool = True,
    **options,
) -> None:
    """Finish runs that died, oldest first; those of live owners are left to them.

    With ``resume=False`` a run that died is an error.
    """
    runs = snapshots.latest(spark, store.root).runs
    for run_id in sorted(runs, key=lambda name: (runs[name].started_us, name)):
        if not resume and not snapshots.is_alive(spark, store.root, run_id, runs[run_id].attempt):
            raise UnfinishedRun(f"run {run_id} did not finish")
        claim = take_over(spark, store, run_id)
        if claim is None:
            continue
        try:
            work_off(spark, store, claim, load_dimensions, **options)
        except NoSalesData:
            # Refusing its files finishes it, too; the error was the run's own.
            continue


def require_open_files(spark: SparkSession, store: Store, inventory: DataFrame) -> None:
    """Files of runs that do not count yet must still be there: a repeated run would lack their rows."""
    base = snapshots.latest(spark, store.root)
    uncounted = [name for name, run in base.runs.items() if run.months is None]
    events = read_events(spark, store, base).filter(F.col("run_id").isin(uncounted))
    gone = ledger.vanished_files(inventory, events).limit(NAMED_FILES).collect()
    if gone:
        named = ", ".join(f"{row['file_path']} of run {row['run_id']}" for row in gone)
        raise UnfinishedRun(f"files of an unfinished run have gone: {named}")


def daily_run(
    spark: SparkSession,
    landing: str,
    store: Store,
    load_dimensions: Callable[[], Dimensions],
    run_id: str,
    run_ts: dt.datetime,
    *,
    resume: bool = True,
    files_per_run: int = FILES_PER_RUN,
    **options,
) -> None:
    """Finish what died, then process the files not yet entered; ``options`` as for ``work_off``.

    A backlog of more than ``files_per_run`` files becomes several runs, named by number behind
    the first; none is left out. Files that are not CSV are entered and refused. ``export`` gets the
    refreshed months; if it fails, the run stays open and the next one exports it again.
    """
    inventory = file_inventory(spark, landing)
    require_files(inventory)
    require_open_files(spark, store, inventory)
    finish_open_runs(spark, store, load_dimensions, resume=resume, **options)
    process_pending(spark, inventory, store, load_dimensions, run_id, run_ts, files_per_run, **options)


def process_pending(
    spark: SparkSession,
    files: DataFrame,
    store: Store,
    load_dimensions: Callable[[], Dimensions],
    run_id: str,
    run_ts: dt.datetime,
    files_per_run: int = FILES_PER_RUN,
    **options,
) -> None:
    """Process all files that are not entered yet, in runs of at most ``files_per_run`` files."""
    part, refused = 0, False
    while True:
        pending = not_entered(files, read_events(spark, store)).limit(files_per_run)
        name = f"{run_id}-{part:05d}" if part else run_id
        try:
            if not process_files(spark, pending, store, load_dimensions, name, run_ts, **options):
                break
            refused = False
        except NoSalesData:
            refused = refused or part == 0
        part += 1
    if refused:
        raise NoSalesData("every file was refused")


def clean(spark: SparkSession, store: Store, seconds: float = snapshots.KEPT_SECONDS) -> list[str]:
    """Remove directories that no kept snapshot names, such as those of months since replaced.

    A run's own totals are needed until they count, so those of finished runs go as well.
    """
    folders = {
        "ledger": store.ledger,
        "totals": store.totals,
        "customers": store.customer_monthly,
        "sellers": store.sales_incentive,
    }
    removed = snapshots.clean(spark, store.root, folders, seconds)
    needed = {sinks.partition_folder("run_id", name) for name in snapshots.latest(spark, store.root).runs}
    oldest = (time.time() - seconds) * 1000
    for name, changed in storage.entries(spark, store.run_totals).items():
        if changed < oldest and name not in needed:
            storage.delete(spark, f"{store.run_totals}/{name}")
            removed.append(f"{store.run_totals}/{name}")
    return removed
