"""Dimensions that are checked once per version, and files that come too late for the source."""

import os

import pytest
from fixtures import bag, customers, sellers, stores
from test_claims import one_seller
from test_files import write
from test_runs import csv, mart, sale, stream

from tallymart.plans import daily_run
from tallymart.plans.daily_run import Store
from tallymart.sources import storage
from tallymart.sources.dimensions import DuplicateKey, checked_dimensions, current_dimensions, file_fingerprint
from tallymart.streaming import feed


def jobs_of(spark, work):
    """The result of some work, and how many Spark jobs it took."""
    group = f"group-{os.urandom(4).hex()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        return work(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unchanged_dimensions_take_no_job(spark, tmp_path):
    tables = {"customers": customers(spark), "stores": stores(spark), "sellers": sellers(spark)}
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/source/{name}")
    paths = [f"{tmp_path}/source/{name}" for name in tables]

    def current():
        return current_dimensions(
            spark,
            f"{tmp_path}/dims",
            file_fingerprint(spark, paths),
            lambda: tuple(spark.read.schema(rows.schema).parquet(path) for path, rows in zip(paths, tables.values(), strict=True)),
        )

    first, jobs = jobs_of(spark, current)
    assert jobs > 0
    again, jobs = jobs_of(spark, current)
    assert jobs == 0
    plain = checked_dimensions(*tables.values())
    for found in (first, again):
        for mine, other in zip(found.all(), plain.all(), strict=True):
            assert (mine.key, mine.small, mine.small_keys) == (other.key, other.small, other.small_keys)
            assert bag(mine.rows) == bag(other.rows)
    customers(spark, ids=(4, 5)).write.mode("append").parquet(paths[0])
    changed, jobs = jobs_of(spark, current)
    assert jobs > 0 and bag(changed.customers.keys()) == [(1,), (2,), (3,), (4,), (5,)]


def test_a_version_with_repeated_keys_is_not_kept(spark, tmp_path):
    folder = str(tmp_path / "dims")
    twice = customers(spark, extra=[(1, "Ann", "Again", "Town", "1", "9")])
    for _ in range(2):
        with pytest.raises(DuplicateKey, match="customer_id 1"):
            current_dimensions(spark, folder, "one", lambda: (twice, stores(spark), sellers(spark)))
    assert not [name for name in storage.entries(spark, folder) if name.startswith("manifest")]
    sound = current_dimensions(spark, folder, "two", lambda: (customers(spark), stores(spark), sellers(spark)))
    assert sound.customers.keys().count() == 3


def test_large_dimensions_stay_large(spark, tmp_path):
    found = current_dimensions(
        spark, str(tmp_path), "v", lambda: (customers(spark), stores(spark), sellers(spark)), broadcast_bytes=60
    )
    assert not found.customers.small and not found.customers.small_keys
    assert found.stores.small_keys


def test_a_file_older_than_the_age_counts_once(spark, tmp_path):
    landing = tmp_path / "landing"
    write(landing, {"a.csv": csv(sale(1, 10))})
    store = Store(str(tmp_path / "store"))
    stream(spark, tmp_path, store, max_age=3600)
    write(landing, {"late.csv": csv(sale(1, 5))})
    old = os.stat(landing / "a.csv").st_mtime - 86400
    os.utime(landing / "late.csv", (old, old))
    for _ in range(2):
        stream(spark, tmp_path, store, max_age=3600)
        assert mart(spark, store) == one_seller("15.00")
    write(landing, {"later.csv": csv(sale(1, 2)), "new.csv": csv(sale(1, 1))})
    os.utime(landing / "later.csv", (old, old))
    stream(spark, tmp_path, store, max_age=3600)
    assert mart(spark, store) == one_seller("18.00")
    assert daily_run.read_facts(spark, store).count() == 4
    events = daily_run.read_events(spark, store).filter("status = 'I'")
    assert events.count() == events.select("file_path").distinct().count() == 4


def test_sweeps_come_with_batches_too(spark, tmp_path, monkeypatch):
    """A file that is too old when the stream runs already is taken by a later batch."""
    landing = tmp_path / "landing"
    write(landing, {f"{n}.csv": csv(sale(1, 1)) for n in range(3)})
    store = Store(str(tmp_path / "store"))
    real, seen = feed.skipped_files, []

    def skipped(session, folder, age):
        if len(seen) == 1:
            write(landing, {"late.csv": csv(sale(1, 5))})
            os.utime(landing / "late.csv", (1_000_000_000, 1_000_000_000))
        seen.append(age)
        return real(session, folder, age)

    monkeypatch.setattr(feed, "skipped_files", skipped)
    stream(spark, tmp_path, store, files_per_batch=1, sweep_every=2)
    assert len(seen) == 2
    assert mart(spark, store) == one_seller("8.00")
