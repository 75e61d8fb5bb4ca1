import datetime as dt

import pytest

from haulmark.operators import staging
from haulmark.session import run_dir
from haulmark.sources.versioned import VersionedTable

NOW = "2024-01-01 12:00:00"


@pytest.fixture(scope="module")
def staged(spark):
    data = [(1, dt.datetime(2024, 1, 1, 11, 30, 0, 250), None), (2, dt.datetime(2024, 1, 1, 11, 31), 5.5)]
    t = spark.createDataFrame(data, "vehicle_id long, timestamp timestamp, speed double")
    d = spark.createDataFrame([("A",)], "driver_id string")
    return staging.stage(t, "telemetry", ["vehicle_id", "timestamp"], NOW, staging.FACT_TTL).unionAll(
        staging.stage(d, "drivers", ["driver_id"], NOW, staging.DIMENSION_TTL)
    )


def test_keys_and_payload(staged, rows):
    assert rows(staged, "key") == [("staging:drivers:A",), ("staging:telemetry:1:2024-01-01T11:30:00.000250",),
                                   ("staging:telemetry:2:2024-01-01T11:31:00.000000",)]
    back = staging.get_staged(staged, "telemetry", NOW, "vehicle_id long, timestamp string, speed double")
    assert rows(back, "vehicle_id", "speed") == [(1, None), (2, 5.5)]


def test_expiry(staged, rows):
    counts = staging.staging_counts(staged, ["telemetry", "drivers", "customers"], "2024-01-01 12:30:00")
    assert rows(counts) == [("customers", 0, False), ("drivers", 1, True), ("telemetry", 0, False)]


def test_clear(staged, rows):
    left, removed = staging.clear_staging(staged, ("staging:telemetry", "cache:"))
    assert rows(left, "key") == [("staging:drivers:A",)]
    assert rows(removed) == [("staging:telemetry", 2)]


def test_partitioned_store(spark, staged, tmp_path):
    path = str(tmp_path / "staged")
    staging.write_staged(staged, path)
    assert spark.read.parquet(path).filter("entity = 'telemetry'").count() == 2


def test_staging_a_key_again_replaces_it(spark, rows):
    text = "delivery_id long, status string"
    parts = [
        staging.stage(spark.createDataFrame([(1, status), (2, status)], text), "deliveries", ["delivery_id"], when, 3600)
        for status, when in (("Open", "2024-01-01 11:30:00"), ("Done", "2024-01-01 11:45:00"))
    ]
    both = parts[1].unionAll(parts[0])
    assert rows(staging.get_staged(both, "deliveries", NOW, text), "delivery_id", "status") == [(1, "Done"), (2, "Done")]
    assert rows(staging.staging_counts(both, ["deliveries"], NOW), "records") == [(2,)]
    assert rows(staging.clear_staging(both, ("staging:",))[1]) == [("staging:", 2)]


def test_a_stored_clear_is_seen_elsewhere_and_happens_once(spark, staged, rows):
    store = VersionedTable(spark, f"{run_dir(spark, 't-clear')}/records")
    store.append(staged, "stage-1")
    held = store.read()
    assert rows(staging.clear_stored(store, "clear-1", ("staging:telemetry", "cache:"))) == [("cache:", 0), ("staging:telemetry", 2)]
    assert rows(VersionedTable(spark.newSession(), store.root).read(), "key") == [("staging:drivers:A",)]
    assert held.count() == 3  # a reader that began before
    store.append(staged, "stage-2")
    assert rows(staging.clear_stored(store, "clear-1", ("staging:telemetry",))) == [("staging:telemetry", 0)]
    assert rows(staging.clear_stored(store, "clear-2", ("staging:",)), "removed") == [(3,)]
    assert VersionedTable(spark.newSession(), store.root).read().count() == 0


def test_a_clear_starts_over_when_rows_arrive(spark, staged, rows, monkeypatch):
    store = VersionedTable(spark, f"{run_dir(spark, 't-clear')}/records")
    store.append(staged, "stage-1")
    write, arrived = VersionedTable.write, []

    def slow(self, df, by_bucket=False):
        commit = write(self, df, by_bucket)
        if not arrived:
            arrived.append(True)
            VersionedTable(spark, store.root).append(staged.filter("entity = 'drivers'"), "stage-2")
        return commit

    monkeypatch.setattr(VersionedTable, "write", slow)
    assert rows(staging.clear_stored(store, "clear-1", ("staging:telemetry",)), "removed") == [(2,)]
    assert rows(store.read(), "entity") == [("drivers",), ("drivers",)]
