import datetime as dt
from decimal import Decimal

import pytest
from fixtures import HEADER, bag, customers, dimensions
from test_files import write

from tallymart.operators import ledger
from tallymart.operators.snapshots import latest
from tallymart.plans import daily_run
from tallymart.plans.daily_run import Store
from tallymart.schemas import ACTIVE, INACTIVE
from tallymart.sources.files import NoSalesData, file_inventory
from tallymart.streaming.feed import start_sales_stream

DAY = dt.datetime(2024, 3, 31, 6, 0)
MART = ("store_id", "sales_person_id", "sales_month", "total_sales", "incentive")


def csv(*rows, header=HEADER):
    return "\n".join([header, *rows]) + "\n"


def sale(seller, total, day="2024-03-03", customer=1, store=121):
    return f"{customer},{store},sugar,{day},{seller},50,1,{total}"


def run(spark, landing, store, run_id="run-1", run_ts=DAY, **options):
    daily_run.daily_run(spark, landing, store, lambda: dimensions(spark), run_id, run_ts, **options)


def mart(spark, store):
    return bag(daily_run.read_sales_incentive(spark, store), *MART)


def test_run_end_to_end(spark, tmp_path):
    landing = write(
        tmp_path / "landing",
        {
            "a/x.csv": csv(sale(1, 10), sale(2, 20)),
            "b/x.csv": csv(sale(1, 15), sale(3, "bad")),
            "less.csv": csv("1,sugar", header="customer_id,product_name"),
            "note.txt": "hello",
        },
    )
    store = Store(str(tmp_path / "store"))
    run(spark, landing, store)
    assert mart(spark, store) == [
        (121, 1, "2024-03", Decimal("25.00"), Decimal("0.25")),
        (121, 2, "2024-03", Decimal("20.00"), Decimal("0.00")),
    ]
    assert bag(daily_run.read_customer_monthly(spark, store), "customer_id", "sales_date_month", "total_sales") == [
        (1, "2024-03", Decimal("45.00"))
    ]
    assert daily_run.read_facts(spark, store).count() == 3
    assert bag(daily_run.read_rejected_rows(spark, store), "failed_columns") == [(["total_cost"],)]
    assert bag(daily_run.read_refused_lines(spark, store), "raw_line") == [("1,sugar",), ("customer_id,product_name",)]
    latest = ledger.latest_status(daily_run.read_events(spark, store))
    assert bag(latest, "file_name", "status") == [
        ("less.csv", "E"), ("note.txt", "E"), ("x.csv", "I"), ("x.csv", "I"),
    ]
    started = daily_run.read_events(spark, store).filter("status = 'A'").select("event_ts").distinct().collect()
    assert [row["event_ts"] for row in started] == [DAY]
    assert all(row["event_ts"] > DAY for row in latest.collect())
    published = spark.read.parquet(store.sales_by_month_and_store)
    assert bag(published, "run_epoch", "sales_month", "store_id", "sales_person_id") == [
        (1711864800000, "2024-03", 121, 1),
        (1711864800000, "2024-03", 121, 1),
        (1711864800000, "2024-03", 121, 2),
    ]


def test_late_file_replaces_its_month_only(spark, tmp_path):
    landing = write(
        tmp_path / "landing", {"mar.csv": csv(sale(1, 10), sale(2, 20)), "apr.csv": csv(sale(3, 5, "2024-04-01"))}
    )
    store = Store(str(tmp_path / "store"))
    run(spark, landing, store)
    before = latest(spark, store.root).months["2024-04"]
    write(tmp_path / "landing", {"late.csv": csv(sale(1, 15, "2024-03-31"))})
    run(spark, landing, store, "run-2", DAY + dt.timedelta(days=1))
    assert mart(spark, store) == [
        (121, 1, "2024-03", Decimal("25.00"), Decimal("0.25")),
        (121, 2, "2024-03", Decimal("20.00"), Decimal("0.00")),
        (121, 3, "2024-04", Decimal("5.00"), Decimal("0.05")),
    ]
    assert latest(spark, store.root).months["2024-04"] == before


def test_export_gets_the_touched_months_and_can_fail_the_run(spark, tmp_path):
    landing = write(
        tmp_path / "landing", {"mar.csv": csv(sale(1, 10)), "apr.csv": csv(sale(3, 5, "2024-04-01"))}
    )
    store = Store(str(tmp_path / "store"))
    run(spark, landing, store)
    write(tmp_path / "landing", {"late.csv": csv(sale(2, 30))})

    def down(customers, sales, months, run_id):
        raise ConnectionError("database is down")

    later = DAY + dt.timedelta(days=1)
    with pytest.raises(ConnectionError):
        run(spark, landing, store, "run-2", later, export=down)
    seen = []
    tries = []

    def export(customers, sales, months, run_id):
        tries.append((run_id, months))
        seen.extend([bag(customers), bag(sales)])

    run(spark, landing, store, "run-3", later, export=export)
    assert tries == [("run-2", ["2024-03"])]
    assert seen == [
        [(1, "Ann1 Bell", "Town", "911", Decimal("40.00"), "2024-03")],
        [
            (121, 1, "Sam1 Till", Decimal("10.00"), Decimal("0.00"), "2024-03"),
            (121, 2, "Sam2 Till", Decimal("30.00"), Decimal("0.30"), "2024-03"),
        ],
    ]
    assert daily_run.read_facts(spark, store).count() == 3


def test_processed_files_are_not_taken_again(spark, tmp_path):
    landing = write(tmp_path / "landing", {"mar.csv": csv(sale(1, 10)), "less.csv": "a\n1\n"})
    store = Store(str(tmp_path / "store"))
    run(spark, landing, store)
    events = daily_run.read_events(spark, store).count()
    first = mart(spark, store)
    run(spark, landing, store, "run-2")
    assert mart(spark, store) == first
    assert daily_run.read_refused_lines(spark, store).count() == 2
    assert daily_run.read_events(spark, store).count() == events


def test_broken_run_is_repeated_under_its_own_id(spark, tmp_path):
    landing = write(tmp_path / "landing", {"mar.csv": csv(sale(1, 10)), "less.csv": "a\n1\n"})
    store = Store(str(tmp_path / "store"))

    def unreachable():
        raise ConnectionError("no dimensions today")

    with pytest.raises(ConnectionError):
        daily_run.daily_run(spark, landing, store, unreachable, "run-1", DAY)
    write(tmp_path / "landing", {"new.csv": csv(sale(2, 30))})
    later = DAY + dt.timedelta(days=1)
    with pytest.raises(daily_run.UnfinishedRun, match="run-1"):
        run(spark, landing, store, "run-2", later, resume=False)
    run(spark, landing, store, "run-2", later)
    assert mart(spark, store) == [
        (121, 1, "2024-03", Decimal("10.00"), Decimal("0.00")),
        (121, 2, "2024-03", Decimal("30.00"), Decimal("0.30")),
    ]
    assert daily_run.read_facts(spark, store, "run-1").count() == 1
    assert daily_run.read_facts(spark, store, "run-2").count() == 1
    assert daily_run.read_refused_lines(spark, store).count() == 2
    files = file_inventory(spark, landing)
    assert ledger.open_files(files, daily_run.read_events(spark, store)).isEmpty()
    assert spark.read.parquet(store.customer_rows).select("run_epoch").distinct().count() == 2


def test_nothing_acceptable_is_an_error(spark, tmp_path):
    landing = write(tmp_path / "landing", {"less.csv": "a\n1\n"})
    with pytest.raises(NoSalesData, match="refused"):
        run(spark, landing, Store(str(tmp_path / "store")))


def test_rows_without_a_date_are_refreshed_too(spark, tmp_path):
    landing = write(tmp_path / "landing", {"a.csv": csv(sale(1, 10, day=""), sale(1, 5))})
    store = Store(str(tmp_path / "store"))
    run(spark, landing, store)
    write(tmp_path / "landing", {"b.csv": csv(sale(1, 7, day=""))})
    run(spark, landing, store, "run-2", DAY + dt.timedelta(days=1))
    assert mart(spark, store) == [
        (121, 1, "2024-03", Decimal("5.00"), Decimal("0.05")),
        (121, 1, None, Decimal("17.00"), Decimal("0.17")),
    ]


def test_rebuild_follows_the_dimensions(spark, tmp_path):
    landing = write(
        tmp_path / "landing", {"a.csv": csv(sale(1, 10), sale(2, 20, "2024-04-01", customer=77))}
    )
    store = Store(str(tmp_path / "store"))
    run(spark, landing, store)
    assert [row[1:3] for row in mart(spark, store)] == [(1, "2024-03")]
    later = dimensions(spark, customers=customers(spark, ids=(77,)))
    daily_run.refresh_months(spark, store, later)
    assert [row[1:3] for row in mart(spark, store)] == [(2, "2024-04")]


def test_ledger_states(spark, tmp_path):
    files = spark.createDataFrame(
        [(f"file:///in/{name}", name) for name in ("a.csv", "b.csv", "c.csv")], "file_path string, file_name string"
    )
    path = str(tmp_path / "ledger")
    assert ledger.read_ledger(spark, path).isEmpty()
    assert ledger.pending_files(files, ledger.read_ledger(spark, path)).count() == 3
    two = files.filter("file_name < 'c'")
    ledger.append_events(ledger.ledger_events(two, ACTIVE, DAY, "run-1"), path)
    one = files.filter("file_name = 'a.csv'")
    ledger.append_events(ledger.ledger_events(one, INACTIVE, DAY, "run-1"), path)
    events = ledger.read_ledger(spark, path)
    assert bag(ledger.latest_status(events), "file_name", "status") == [("a.csv", "I"), ("b.csv", "A")]
    assert bag(ledger.open_files(files, events), "file_name", "run_id") == [("b.csv", "run-1")]
    assert bag(ledger.pending_files(files, events), "file_name") == [("b.csv",), ("c.csv",)]


def stream(spark, tmp_path, store, **options):
    query = start_sales_stream(
        spark,
        str(tmp_path / "landing"),
        store,
        lambda: dimensions(spark),
        str(tmp_path / "checkpoint"),
        **options,
    )
    query.awaitTermination()


def test_stream_follows_late_files_and_reprocesses_nothing(spark, tmp_path):
    write(tmp_path / "landing", {"a.csv": csv(sale(1, 10), sale(2, 20)), "b.csv": csv(sale(3, 5, "2024-04-01"))})
    store = Store(str(tmp_path / "store"))
    stream(spark, tmp_path, store, files_per_batch=1)
    write(
        tmp_path / "landing",
        {
            "late.csv": csv(sale(1, 15), sale(1, "bad")),
            "less.csv": "a,b\n1,2\n",
            "turned.csv": csv(
                ",".join(reversed(sale(2, 1).split(","))), header=",".join(reversed(HEADER.split(",")))
            ),
        },
    )
    stream(spark, tmp_path, store)
    expected = [
        (121, 1, "2024-03", Decimal("25.00"), Decimal("0.25")),
        (121, 2, "2024-03", Decimal("21.00"), Decimal("0.00")),
        (121, 3, "2024-04", Decimal("5.00"), Decimal("0.05")),
    ]
    assert mart(spark, store) == expected
    events = daily_run.read_events(spark, store).count()
    stream(spark, tmp_path, store)
    assert mart(spark, store) == expected
    assert daily_run.read_events(spark, store).count() == events
    assert daily_run.read_refused_lines(spark, store).count() == 2

    batch = Store(str(tmp_path / "batch"))
    run(spark, str(tmp_path / "landing"), batch)
    assert mart(spark, batch) == expected
    columns = ("customer_id", "full_name", "sales_date_month", "total_sales")
    assert bag(daily_run.read_customer_monthly(spark, batch), *columns) == bag(
        daily_run.read_customer_monthly(spark, store), *columns
    )


def test_repeated_batch_replaces_itself(spark, tmp_path):
    landing = write(tmp_path / "landing", {"a.csv": csv(sale(1, 10))})
    store = Store(str(tmp_path / "store"))
    files = file_inventory(spark, landing)
    for _ in range(2):
        daily_run.process_files(spark, files, store, lambda: dimensions(spark), "stream-000000000", DAY)
    assert mart(spark, store) == [(121, 1, "2024-03", Decimal("10.00"), Decimal("0.10"))]


def test_stream_of_refused_files_only_goes_on(spark, tmp_path):
    write(tmp_path / "landing", {"less.csv": "a,b\n1,2\n"})
    store = Store(str(tmp_path / "store"))
    stream(spark, tmp_path, store)
    write(tmp_path / "landing", {"a.csv": csv(sale(1, 10))})
    stream(spark, tmp_path, store)
    assert mart(spark, store) == [(121, 1, "2024-03", Decimal("10.00"), Decimal("0.10"))]


def test_stream_leaves_what_a_batch_has_taken(spark, tmp_path):
    landing = write(tmp_path / "landing", {"a.csv": csv(sale(1, 10))})
    store = Store(str(tmp_path / "store"))
    run(spark, landing, store)
    stream(spark, tmp_path, store)
    assert mart(spark, store) == [(121, 1, "2024-03", Decimal("10.00"), Decimal("0.10"))]


def test_new_checkpoint_keeps_the_facts_of_the_old(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    for name in ("one", "two"):
        write(tmp_path / name / "landing", {f"{name}.csv": csv(sale(1, 10))})
        stream(spark, tmp_path / name, store)
    assert daily_run.read_facts(spark, store).count() == 2
    assert mart(spark, store) == [(121, 1, "2024-03", Decimal("20.00"), Decimal("0.20"))]


def test_month_that_becomes_empty_goes(spark, tmp_path):
    landing = write(tmp_path / "landing", {"a.csv": csv(sale(1, 10))})
    store = Store(str(tmp_path / "store"))
    run(spark, landing, store)
    later = dimensions(spark, customers=customers(spark, ids=(77,)))
    daily_run.refresh_months(spark, store, later, ["2024-03"])
    assert daily_run.read_customer_monthly(spark, store).isEmpty()


def test_vanished_file_of_an_open_run_is_an_error(spark, tmp_path):
    landing = write(tmp_path / "landing", {"a.csv": csv(sale(1, 10)), "b.csv": csv(sale(2, 10))})
    store = Store(str(tmp_path / "store"))

    def unreachable():
        raise ConnectionError("no dimensions today")

    with pytest.raises(ConnectionError):
        daily_run.daily_run(spark, landing, store, unreachable, "run-1", DAY)
    (tmp_path / "landing/b.csv").unlink()
    with pytest.raises(daily_run.UnfinishedRun, match="b.csv"):
        run(spark, landing, store, "run-2")
    assert daily_run.read_facts(spark, store).count() == 0
