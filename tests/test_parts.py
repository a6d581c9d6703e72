"""Months of several parts: a run writes what it adds, not what its months had before."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from fixtures import bag, customers, dimensions
from pyspark.sql import functions as F
from test_claims import closing, files_named, totals

from tallymart.functions.columns import canonical_path
from tallymart.operators import sinks, snapshots
from tallymart.plans import daily_run
from tallymart.plans.daily_run import Store
from tallymart.sources.dimensions import fingerprint

MART = ("sales_person_id", "sales_month", "total_sales", "incentive")


def counted(spark, store, run_id, *rows, found=None):
    files = files_named(spark, f"{run_id}.csv")
    claim = daily_run.enter(spark, store, files, run_id, dt.datetime(2024, 3, 31))
    found = found or dimensions(spark)
    daily_run.count_run(spark, store, claim, totals(spark, *rows), found, closing(files, claim))


@pytest.fixture
def large(monkeypatch):
    """Every part counts as one that need not be merged."""
    monkeypatch.setattr(snapshots, "SMALL_PART", 1)


def month(spark, store, name="2024-03"):
    return snapshots.latest(spark, store.root).months[name]


def sellers(spark, store):
    return bag(daily_run.read_sales_incentive(spark, store), *MART)


def spent(spark, store):
    return bag(daily_run.read_customer_monthly(spark, store), "customer_id", "sales_date_month", "total_sales")


def test_a_run_writes_only_what_it_adds(spark, tmp_path, large):
    store = Store(str(tmp_path / "store"))
    counted(spark, store, "run-0", (1, "10.00", "2024-03"), (2, "8.00", "2024-03"), (1, "1.00", None))
    for number in range(1, 3):
        counted(spark, store, f"run-{number}", (2, "2.00", "2024-03"), (1, "1.00", None))
    for folder in (store.totals, store.customer_monthly, store.sales_incentive):
        for part in month(spark, store).parts()[1:]:
            assert spark.read.parquet(f"{folder}/change={part.totals}").count() == 2
    assert len(month(spark, store).parts()) == 3
    # The seller who was second in the first part is the best of all.
    assert sellers(spark, store) == [
        (1, "2024-03", Decimal("10.00"), Decimal("0.00")),
        (1, None, Decimal("3.00"), Decimal("0.03")),
        (2, "2024-03", Decimal("12.00"), Decimal("0.12")),
    ]
    assert spent(spark, store) == [(1, "2024-03", Decimal("22.00")), (1, None, Decimal("3.00"))]


def test_parts_of_one_size_become_one(large, monkeypatch):
    monkeypatch.setattr(snapshots, "PARTS_PER_LEVEL", 3)
    parts, seen = [], []
    for _ in range(9):
        now = snapshots.Month("newest", None, None, parts[-1].rows, "dims", parts[:-1]) if parts else None
        kept = now.kept(1, "dims") if now else []
        parts = [*kept, snapshots.Part("new", None, None, 1 + sum(part.rows for part in parts[len(kept) :]))]
        seen.append([part.rows for part in parts])
    assert seen == [[1], [1, 1], [3], [3, 1], [3, 1, 1], [3, 3], [3, 3, 1], [3, 3, 1, 1], [9]]


def test_small_parts_are_merged(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    for number in range(2):
        counted(spark, store, f"run-{number}", (1, "1.00", "2024-03"))
    assert month(spark, store).older == [] and month(spark, store).rows == 1


@pytest.mark.parametrize("refresh", [False, True])
def test_other_dimensions_make_all_parts_again(spark, tmp_path, large, refresh):
    """A customer who was not known when the first parts came counts with all sales, as in one part."""
    store, strangers = Store(str(tmp_path / "store")), dimensions(spark, customers=customers(spark, ids=(77,)))
    for number in range(2):
        counted(spark, store, f"run-{number}", (1, "1.00", "2024-03"), found=strangers)
    assert len(month(spark, store).parts()) == 2 and spent(spark, store) == []
    if refresh:
        daily_run.refresh_months(spark, store, dimensions(spark))
    else:
        counted(spark, store, "run-2", (1, "1.00", "2024-03"))
    assert len(month(spark, store).parts()) == 1
    assert spent(spark, store) == [(1, "2024-03", Decimal("2.00" if refresh else "3.00"))]
    counted(spark, store, "run-3", (1, "5.00", "2024-03"))
    assert spent(spark, store) == [(1, "2024-03", Decimal("7.00" if refresh else "8.00"))]


def test_cleaning_keeps_all_parts(spark, tmp_path, large, monkeypatch):
    store = Store(str(tmp_path / "store"))
    for number in range(3):
        counted(spark, store, f"run-{number}", (1, "1.00", "2024-03"))
    monkeypatch.setattr(snapshots, "KEPT", 1)
    monkeypatch.setattr(snapshots, "KEPT_SECONDS", 0)
    snapshots.change(spark, store.root, lambda now: replace(now))
    daily_run.clean(spark, store, seconds=0)
    assert spent(spark, store) == [(1, "2024-03", Decimal("3.00"))]
    assert sellers(spark, store) == [(1, "2024-03", Decimal("3.00"), Decimal("0.03"))]


def test_the_fingerprint_tells_rows_and_not_their_order(spark):
    one = fingerprint(dimensions(spark, customers=customers(spark, ids=(1, 2))))
    assert one == fingerprint(dimensions(spark, customers=customers(spark, ids=(2, 1))))
    assert one != fingerprint(dimensions(spark, customers=customers(spark, ids=(1, 3))))
    names = [(1, None, "x", "T", "1", "9")], [(1, "x", None, "T", "1", "9")]
    first, last = (dimensions(spark, customers=customers(spark, ids=(), extra=rows)) for rows in names)
    assert fingerprint(first) != fingerprint(last)


def test_tables_are_written_packed(spark, tmp_path):
    rows = dimensions(spark).customers.rows
    sinks.write_snapshot(rows, str(tmp_path / "one"))
    sinks.write_partitioned(rows, str(tmp_path / "many"), ["customer_id"])
    names = [path.name for path in tmp_path.rglob("part-*.parquet")]
    assert names and all(".zstd." in name for name in names)


def test_tables_are_packed_by_the_level_that_takes_least_time(spark, tmp_path):
    def size(folder):
        return sum(path.stat().st_size for path in (tmp_path / folder).rglob("part-*.parquet"))

    rows = spark.range(0, 20_000, 1, 1).select(F.hex(F.xxhash64("id")).alias("text"), F.lit(1).alias("one"))
    for level in ("1", "3"):
        writer = rows.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", level)
        writer.parquet(str(tmp_path / level))
    assert size("1") != size("3")
    sinks.write_snapshot(rows, str(tmp_path / "one"))
    assert size("one") == size("1")
    partitioned = {}
    for name, level in (("many", "1"), ("other", "3")):
        options = {"compression": "zstd", "parquet.compression.codec.zstd.level": level}
        rows.write.options(**options).partitionBy("one").parquet(str(tmp_path / name))
        partitioned[level] = size(name)
    sinks.write_partitioned(rows, str(tmp_path / "parts"), ["one"], gather=False)
    assert size("parts") == partitioned["1"] != partitioned["3"]


def test_paths_are_spelled_one_way_and_seldom_by_a_pattern(spark):
    paths = ["file:/a", "file:///a", "file:////a", "file://a", "file:", "s3a://b/file:/a", "/a", "file:///", None]
    rows = spark.createDataFrame([(path,) for path in paths], "path string")
    pattern = F.regexp_replace("path", "^file:/+", "file:///")
    found = rows.select(canonical_path(F.col("path")).alias("one"), pattern.alias("all")).collect()
    assert all(row["one"] == row["all"] for row in found)
    # The pattern stands behind a condition.
    plan = rows.select(canonical_path(F.col("path")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CASE WHEN") < plan.index("regexp_replace")
