"""Claims, atomic months and compaction: writers that die, overlap, or come too late."""

import datetime as dt
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from decimal import Decimal

import pytest
from fixtures import HEADER, bag, dimensions
from test_files import write
from test_runs import DAY, csv, mart, sale, stream
from test_runs import run as run_and_publish

from tallymart.operators import ledger, sinks, snapshots
from tallymart.plans import daily_run
from tallymart.plans.daily_run import Store
from tallymart.schemas import ACTIVE, TOTALS_SCHEMA
from tallymart.sources import storage
from tallymart.sources.files import file_inventory
from tallymart.streaming.feed import start_sales_stream


class Died(Exception):
    pass


def run(*args, **options):
    """A run that publishes no rows, unless it is told to."""
    run_and_publish(*args, **({"publish": False} | options))


def no_dimensions():
    raise Died


def one_seller(total, seller=1):
    return [(121, seller, "2024-03", Decimal(total), (Decimal(total) / 100).quantize(Decimal("0.01")))]


def test_only_one_of_many_creates_a_file(spark, tmp_path):
    for root in (f"{tmp_path}/with blank%20s", f"file://{tmp_path}/uri"):
        path = f"{root}/new.json"
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda n, path=path: storage.create_new(spark, path, str(n)), range(8)))
        assert sum(won) == 1
        assert storage.read_text(spark, path) == str(won.index(True))
        assert list(storage.entries(spark, root)) == ["new.json"]
    assert storage.read_text(spark, f"{tmp_path}/none") is None
    assert storage.entries(spark, f"{tmp_path}/none") == {}


def test_stores_that_rename_create_exclusively_too(spark, tmp_path):
    """A file system that is not local to Hadoop, as HDFS is not; both ways of naming a file lead to one."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.claims.link./in", f"file://{tmp_path}")
    assert storage.create_new(spark, "viewfs://claims/in/deep/a.json", "one")
    assert not storage.create_new(spark, "viewfs://claims/in/deep/a.json", "two")
    assert storage.read_text(spark, f"{tmp_path}/deep/a.json") == "one"
    assert list(storage.entries(spark, f"{tmp_path}/deep")) == ["a.json"]


def test_snapshot_survives_its_json():
    months = {None: snapshots.Month("a", None, "b"), "2024-03": snapshots.Month("c", "c", None)}
    runs = {"r/1": snapshots.Run(2, 5), "r2": snapshots.Run(0, 6, [None, "2024-03"])}
    full = snapshots.Snapshot(7, [snapshots.Entry("x", 1)], months, runs)
    assert snapshots.Snapshot.from_json(full.to_json()) == full


def test_stream_with_a_new_checkpoint_finishes_what_died(spark, tmp_path):
    write(tmp_path / "landing", {"a.csv": csv(sale(1, 10))})
    store = Store(str(tmp_path / "store"))
    failing = start_sales_stream(spark, str(tmp_path / "landing"), store, no_dimensions, str(tmp_path / "lost"))
    with pytest.raises(Exception, match="Died"):
        failing.awaitTermination()
    assert daily_run.read_sales_incentive(spark, store).isEmpty()
    write(tmp_path / "landing", {"b.csv": csv(sale(1, 5))})
    stream(spark, tmp_path, store)
    assert mart(spark, store) == one_seller("15.00")
    assert daily_run.read_facts(spark, store).count() == 2
    latest = ledger.latest_status(daily_run.read_events(spark, store))
    assert bag(latest, "file_name", "status") == [("a.csv", "I"), ("b.csv", "I")]
    assert not snapshots.latest(spark, store.root).runs


def test_stream_finishes_what_died_without_a_new_file(spark, tmp_path):
    landing = write(tmp_path / "landing", {"a.csv": csv(sale(1, 10)), "note.txt": "hello"})
    store = Store(str(tmp_path / "store"))
    with pytest.raises(Died):
        daily_run.daily_run(spark, landing, store, no_dimensions, "run-1", DAY)
    stream(spark, tmp_path, store)
    assert mart(spark, store) == one_seller("10.00")
    latest = ledger.latest_status(daily_run.read_events(spark, store))
    assert bag(latest, "file_name", "status") == [("a.csv", "I"), ("note.txt", "E")]


def test_two_writers_share_a_folder(spark, tmp_path):
    """Both see the same files at the same time; each file counts once, whoever takes it."""
    files = {f"{day:02d}.csv": csv(sale(1, 10, f"2024-03-{day:02d}")) for day in range(1, 5)}
    landing = write(tmp_path / "landing", files)
    store = Store(str(tmp_path / "store"))
    start = threading.Barrier(2)

    def writer(number):
        start.wait()
        run(spark, landing, store, f"run-{number}", files_per_run=2)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(writer, range(2)))
    # What one had entered when the other looked is finished by its owner.
    assert mart(spark, store) == one_seller("40.00")
    assert daily_run.read_facts(spark, store).count() == 4
    events = daily_run.read_events(spark, store)
    assert events.filter("status = 'I'").count() == 4
    assert events.filter("status = 'A'").select("file_path").distinct().count() == 4


def totals(spark, *rows):
    return spark.createDataFrame([(1, 121, seller, Decimal(total), month) for seller, total, month in rows], TOTALS_SCHEMA)


def files_named(spark, *names):
    return spark.createDataFrame([(f"file:///in/{name}",) for name in names], "file_path string")


def closing(files, claim):
    return ledger.ledger_events(files, "I", DAY + dt.timedelta(hours=1), claim.run_id, claim.attempt)


def counted(spark, store, run_id, *rows):
    files = files_named(spark, f"{run_id}.csv")
    claim = daily_run.enter(spark, store, files, run_id, DAY)
    daily_run.count_run(spark, store, claim, totals(spark, *rows), dimensions(spark), closing(files, claim))
    return claim


def test_a_month_another_run_has_changed_is_computed_again(spark, tmp_path, monkeypatch):
    """Between reading a month and replacing it, another run replaces it; a third changes another month."""
    store = Store(str(tmp_path / "store"))
    commit, others = snapshots.commit, iter([(1, "5.00", "2024-03"), (1, "2.00", "2024-04")])
    refused = []

    def overtaken(session, root, base, changed):
        if changed.months != base.months:
            monkeypatch.setattr(snapshots, "commit", commit)
            row = next(others, None)
            if row is not None:
                counted(spark, store, f"other-{row[2]}", row)
                monkeypatch.setattr(snapshots, "commit", overtaken)
        done = commit(session, root, base, changed)
        refused.extend([base.version] * (not done))
        return done

    monkeypatch.setattr(snapshots, "commit", overtaken)
    counted(spark, store, "mine", (1, "10.00", "2024-03"))
    assert len(refused) == 2
    assert [(row[2], row[3]) for row in mart(spark, store)] == [("2024-03", Decimal("15.00")), ("2024-04", Decimal("2.00"))]


@pytest.mark.parametrize("step", ["totals", "customers", "sellers", "commit"])
def test_months_stay_readable_whatever_step_fails(spark, tmp_path, monkeypatch, step):
    landing = write(tmp_path / "landing", {"a.csv": csv(sale(1, 10))})
    store = Store(str(tmp_path / "store"))
    run(spark, landing, store)
    write(tmp_path / "landing", {"b.csv": csv(sale(1, 5))})
    real = {"write": snapshots.write_months, "commit": snapshots.commit}
    folders = {"totals": store.totals, "customers": store.customer_monthly, "sellers": store.sales_incentive}

    def write_half(rows, folder, name, month):
        done = real["write"](rows, folder, name, month)
        if folder == folders.get(step):
            raise Died
        return done

    def commit(session, root, base, changed):
        if step == "commit" and changed.months != base.months:
            raise Died
        return real["commit"](session, root, base, changed)

    monkeypatch.setattr(snapshots, "write_months", write_half)
    monkeypatch.setattr(snapshots, "commit", commit)
    with pytest.raises(Died):
        run(spark, landing, store, "run-2", DAY + dt.timedelta(days=1))
    monkeypatch.undo()
    assert mart(spark, store) == one_seller("10.00")
    assert bag(daily_run.read_customer_monthly(spark, store), "total_sales") == [(Decimal("10.00"),)]
    assert daily_run.read_facts(spark, store).count() == 1
    run(spark, landing, store, "run-3", DAY + dt.timedelta(days=2))
    assert mart(spark, store) == one_seller("15.00")
    assert daily_run.read_facts(spark, store).count() == 2


def test_an_attempt_that_was_taken_over_counts_for_nothing(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    files = files_named(spark, "a.csv")
    slow = daily_run.enter(spark, store, files, "run-1", DAY)
    assert daily_run.take_over(spark, store, "run-1") is None  # it has just given a sign of life
    storage.delete(spark, snapshots._lease(store.root, "run-1", 0))
    fast = daily_run.take_over(spark, store, "run-1")
    assert fast.attempt == 1 and fast.started == slow.started
    rows = totals(spark, (1, "10.00", "2024-03"))
    daily_run.count_run(spark, store, fast, rows, dimensions(spark), closing(files, fast))
    with pytest.raises(snapshots.LostClaim):
        daily_run.count_run(spark, store, slow, rows, dimensions(spark), closing(files, slow))
    assert mart(spark, store) == one_seller("10.00")


def test_rows_published_by_an_attempt_that_died_are_no_version(spark, tmp_path, monkeypatch):
    landing = write(tmp_path / "landing", {"a.csv": csv(sale(1, 10))})
    store = Store(str(tmp_path / "store"))

    def died(*_):
        raise Died

    monkeypatch.setattr(daily_run, "count_run", died)
    with pytest.raises(Died):
        run(spark, landing, store, publish=True)
    monkeypatch.undo()
    first = sinks.latest_run(spark, store.customer_rows)
    run(spark, landing, store, "run-2", publish=True)
    for folder in (store.customer_rows, store.sales_rows, store.sales_by_month_and_store):
        assert sinks.latest_run(spark, folder) == (first[0], "run-1~1")
        assert sinks.read_latest_version(spark, folder).count() == 1


def test_a_lease_is_renewed_and_runs_out(spark, tmp_path):
    root = str(tmp_path)
    with snapshots.alive(spark, root, "r/ü", 0, seconds=1.5):
        time.sleep(2.5)
        assert snapshots.is_alive(spark, root, "r/ü", 0)
    assert not snapshots.is_alive(spark, root, "r/ü", 0)
    snapshots.sign(spark, root, "r", 0, seconds=0.1)
    time.sleep(0.2)
    assert not snapshots.is_alive(spark, root, "r", 0)


def test_live_runs_are_left_to_their_owner(spark, tmp_path):
    landing = write(tmp_path / "landing", {"a.csv": csv(sale(1, 10)), "b.csv": csv(sale(1, 5))})
    store = Store(str(tmp_path / "store"))
    files = file_inventory(spark, landing).filter("file_name = 'a.csv'")
    claim = daily_run.enter(spark, store, files, "mine", DAY)
    run(spark, landing, store, "other", resume=False)
    assert mart(spark, store) == one_seller("5.00")
    daily_run.work_off(spark, store, claim, lambda: dimensions(spark))
    assert mart(spark, store) == one_seller("15.00")


def test_refreshes_open_as_many_files_after_many_runs(spark, tmp_path, monkeypatch):
    """A month's totals stay one directory, and the ledger a few, however many runs there were."""
    monkeypatch.setattr(daily_run, "ENTRIES_PER_LEVEL", 3)
    store = Store(str(tmp_path / "store"))
    opened, listed = [], []
    for number in range(9):
        counted(spark, store, f"run-{number}", (1, "1.00", "2024-03"), (2, "0.50", f"2024-{4 + number % 2:02d}"))
        daily_run.compact_ledger(spark, store)
        now = snapshots.latest(spark, store.root)
        opened.append(len(daily_run.read_totals(spark, store, now, ["2024-03"]).inputFiles()))
        listed.append(len(now.ledger))
    assert opened == [1] * 9
    assert max(listed) <= 2 * 3
    assert mart(spark, store)[0] == one_seller("9.00")[0]
    events = daily_run.read_events(spark, store)
    assert events.count() == 18 and events.filter(f"status = '{ACTIVE}'").count() == 9


def test_the_ledger_is_read_where_the_files_lie(spark, tmp_path, monkeypatch):
    """Merged entries are in order of paths, and the range of a batch reaches the scan."""
    monkeypatch.setattr(daily_run, "ENTRIES_PER_LEVEL", 4)
    store = Store(str(tmp_path / "store"))
    for day in range(4):
        files = files_named(spark, *(f"2024-03-{day:02d}/{n}.csv" for n in range(50)))
        assert daily_run.enter(spark, store, files, f"run-{day}", DAY) is not None
    daily_run.compact_ledger(spark, store)
    events = daily_run.read_events(spark, store)
    (entry,) = snapshots.latest(spark, store.root).ledger
    assert entry.level == 1
    paths = [row["file_path"] for row in events.collect()]
    assert len(paths) == 200 and paths == sorted(paths)
    batch = files_named(spark, "2024-03-02/7.csv", "2024-03-02/new.csv", "2024-03-03/x.csv", "2024-03-03/x.csv")
    left = daily_run.not_entered(batch, events)
    assert sorted(row["file_path"][-6:] for row in left.collect()) == ["/x.csv", "/x.csv", "ew.csv"]
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(file_path,file:///in/2024-03-02/7.csv)" in plan
    assert daily_run.not_entered(batch.limit(0), events).isEmpty()


def test_only_touched_months_are_opened(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    counted(spark, store, "run-1", (1, "1.00", "2024-03"), (1, "2.00", "2024-04"), (1, "4.00", None))
    now = snapshots.latest(spark, store.root)
    for month in ("2024-04", None):
        read = daily_run.read_totals(spark, store, now, [month])
        folder = snapshots.month_folder("", now.months[month].totals, "sales_month", month)
        assert all(folder in path for path in read.inputFiles())
        assert bag(read, "sales_month", "total_cost") == [(month, Decimal("2.00" if month else "4.00"))]


def test_cleaning_keeps_what_a_snapshot_names(spark, tmp_path, monkeypatch):
    store = Store(str(tmp_path / "store"))
    for number in range(3):
        counted(spark, store, f"run-{number}", (1, "1.00", "2024-03"))
    assert daily_run.clean(spark, store) == []
    reader = daily_run.read_sales_incentive(spark, store)
    assert daily_run.clean(spark, store, seconds=0) == []  # old snapshots still name all of it
    monkeypatch.setattr(snapshots, "KEPT", 1)
    monkeypatch.setattr(snapshots, "KEPT_SECONDS", 0)
    time.sleep(0.01)
    snapshots.change(spark, store.root, lambda now: replace(now))
    removed = daily_run.clean(spark, store, seconds=0)
    assert sum(store.totals in path for path in removed) == 2
    assert bag(reader, "total_sales") == [(Decimal("3.00"),)] and mart(spark, store) == one_seller("3.00")
    assert daily_run.read_events(spark, store).count() == 6


def test_cleaning_takes_the_totals_of_finished_runs(spark, tmp_path):
    landing = write(tmp_path / "landing", {"a.csv": csv(sale(1, 10))})
    store = Store(str(tmp_path / "store"))
    run(spark, landing, store, "run/1 ü")
    write(tmp_path / "landing", {"b.csv": csv(sale(1, 5))})

    def down(*_):
        raise Died

    with pytest.raises(Died):
        run(spark, landing, store, "run-2", publish=False, export=down)
    assert len(storage.entries(spark, store.run_totals)) == 2
    daily_run.clean(spark, store, seconds=0)
    assert list(storage.entries(spark, store.run_totals)) == ["run_id=run-2"]
    run(spark, landing, store, "run-3")
    assert mart(spark, store) == one_seller("15.00")
    assert daily_run.read_facts(spark, store).count() == 2


def test_a_commit_on_a_snapshot_cleaned_long_ago_fails(spark, tmp_path):
    root = str(tmp_path)
    old = snapshots.change(spark, root, lambda now: now)
    for _ in range(2):
        snapshots.change(spark, root, lambda now: now)
    for version in (1, 2):
        storage.delete(spark, snapshots._path(root, version))
    assert not snapshots.commit(spark, root, old, old)
    assert snapshots.latest(spark, root).version == 3


def test_a_backlog_becomes_several_runs(spark, tmp_path):
    landing = write(tmp_path / "landing", {f"{n}.csv": csv(sale(1, 1)) for n in range(5)})
    store = Store(str(tmp_path / "store"))
    run(spark, landing, store, files_per_run=2)
    assert mart(spark, store) == one_seller("5.00")
    events = daily_run.read_events(spark, store).filter("status = 'I'")
    assert bag(events.groupBy("run_id").count()) == [("run-1", 2), ("run-1-00001", 2), ("run-1-00002", 1)]


def test_twenty_thousand_small_files(spark, tmp_path):
    """More files than one run takes, with three kinds of header and some that are no sales."""
    folder = tmp_path / "landing"
    folder.mkdir()
    turned = ",".join(reversed(HEADER.split(",")))
    for n in range(20_000):
        row = sale(1 + n % 2, 1, f"2024-0{1 + n % 3}-01")
        text = csv(row) if n % 4 else csv(",".join(reversed(row.split(","))), header=turned)
        if n % 1000 == 999:
            text = csv("1,sugar", header="customer_id,product_name")
        (folder / f"{n:05d}.{'txt' if n % 1000 == 500 else 'csv'}").write_text(text)
    store = Store(str(tmp_path / "store"))
    run(spark, str(folder), store)
    refused = 40
    assert sum(row[3] for row in mart(spark, store)) == 20_000 - refused
    events = daily_run.read_events(spark, store)
    assert bag(events.groupBy("status").count()) == [("A", 20_000), ("E", refused), ("I", 20_000 - refused)]
    assert events.select("run_id").distinct().count() == 2
    run(spark, str(folder), store, "run-2")
    assert daily_run.read_events(spark, store).count() == events.count()


def test_totals_of_new_months_are_not_moved_again(spark, tmp_path, monkeypatch):
    """They are stored as the run has written them; months that had totals are summed, others beside them are not."""
    store = Store(str(tmp_path / "store"))
    plans, write_months = [], snapshots.write_months

    def planned(rows, folder, name, month):
        if folder == store.totals:
            plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return write_months(rows, folder, name, month)

    monkeypatch.setattr(snapshots, "write_months", planned)
    counted(spark, store, "run-1", (1, "1.00", "2024-03"), (1, "2.00", None))
    counted(spark, store, "run-2", (1, "4.00", "2024-03"), (1, "8.00", "2024-04"))
    counted(spark, store, "run-3", (1, "16.00", "2024-05"), (1, "32.00", None), (2, "64.00", "2024-04"))
    assert ["Aggregate" in plan or "Rebalance" in plan for plan in plans] == [False, True, True]
    now = snapshots.latest(spark, store.root)
    months = ["2024-03", "2024-04", "2024-05", None]
    assert bag(daily_run.read_totals(spark, store, now, months), "sales_month", "sales_person_id", "total_cost") == sorted(
        [
            ("2024-03", 1, Decimal("5.00")),
            ("2024-04", 1, Decimal("8.00")),
            ("2024-04", 2, Decimal("64.00")),
            ("2024-05", 1, Decimal("16.00")),
            (None, 1, Decimal("34.00")),
        ],
        key=repr,
    )


@pytest.mark.parametrize("small", [True, False])
def test_customers_are_gathered_by_month_before_they_are_named(spark, tmp_path, monkeypatch, small):
    store = Store(str(tmp_path / "store"))
    plans, write_months = [], snapshots.write_months

    def planned(rows, folder, name, month):
        if folder == store.customer_monthly:
            plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return write_months(rows, folder, name, month)

    monkeypatch.setattr(snapshots, "write_months", planned)
    found = dimensions(spark)
    found = replace(found, customers=replace(found.customers, small=small))
    daily_run.write_marts(spark, store, found, totals(spark, (1, "1.00", "2024-03"), (2, "2.00", "2024-03")), "x")
    (plan,) = plans
    assert (plan.index("Join") < plan.index("RebalancePartitions")) == small
    written = spark.read.parquet(store.customer_monthly)
    assert bag(written, "full_name", "total_sales") == [("Ann1 Bell", Decimal("3.00"))]
