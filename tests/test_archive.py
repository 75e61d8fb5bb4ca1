import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from haulmark.functions.timing import at
from haulmark.operators import archive, checks

KEYS = ["event_id"]
CUT = "2024-02-02 12:00:00"


def telemetry(spark, ids, start=dt.datetime(2024, 1, 31), hours=6):
    data = [(i, 1, start + dt.timedelta(hours=hours * n), float(i)) for n, i in enumerate(ids)]
    return spark.createDataFrame(data, "event_id long, vehicle_id long, timestamp timestamp, speed double")


def ids(df):
    return sorted(r.event_id for r in df.select("event_id").collect())


def test_move_and_keep(spark, tmp_path):
    root = str(tmp_path / "warm")
    df = telemetry(spark, range(16)).unionAll(
        spark.createDataFrame([(99, 1, None, 1.0)], "event_id long, vehicle_id long, timestamp timestamp, speed double")
    )
    kept = archive.hot_to_warm(df, root, at(CUT), KEYS)
    assert ids(kept) == [*range(10, 16), 99]
    assert ids(spark.read.parquet(root)) == list(range(10))
    assert ids(archive.warm_scan(spark, root, 2024, 2, 1)) == [4, 5, 6, 7]
    assert ids(archive.warm_scan(spark, root, 2024, 1)) == [0, 1, 2, 3]


def test_repeated_and_later_runs_neither_lose_nor_double(spark, tmp_path):
    root = str(tmp_path / "warm")
    df = telemetry(spark, range(16))
    for cut in (CUT, CUT, "2024-02-02 18:00:00"):
        archive.archive_warm(df, root, at(cut), KEYS)
    assert ids(spark.read.parquet(root)) == list(range(11))
    # A straggler for a day that is long archived.
    late = telemetry(spark, [50], dt.datetime(2024, 1, 31, 1))
    archive.archive_warm(late, root, at(CUT), KEYS)
    assert ids(spark.read.parquet(root)) == [*range(11), 50]


def test_nothing_is_dropped_unless_archived(spark, tmp_path):
    root = str(tmp_path / "warm")
    df = telemetry(spark, range(16))
    archive.archive_warm(df.filter("event_id <> 3"), root, at(CUT), KEYS)
    with pytest.raises(ValueError, match="missing in the archive"):
        archive.retain_hot(df, spark.read.parquet(root), at(CUT), KEYS)


def test_nothing_due(spark, tmp_path):
    root = str(tmp_path / "warm")
    df = telemetry(spark, range(4))
    archive.archive_warm(df, root, at(CUT), KEYS)
    young = telemetry(spark, [9], dt.datetime(2024, 3, 1))
    assert ids(archive.hot_to_warm(young, root, at(CUT), KEYS)) == [9]


def test_cold_round_trip(spark, tmp_path, capsys):
    warm, cold = str(tmp_path / "warm"), str(tmp_path / "cold")
    df = telemetry(spark, range(16))
    kept = archive.hot_to_warm(df, warm, at(CUT), KEYS)
    for _ in range(2):
        archive.archive_cold(spark, warm, cold, at("2024-02-01"), KEYS)
    stored = spark.read.orc(cold)
    assert ids(stored) == [0, 1, 2, 3]
    stored.filter("month = 1").explain("formatted")
    assert "PartitionFilters: [isnotnull(month" in capsys.readouterr().out
    rest = spark.read.parquet(warm).filter(F.col("timestamp") >= at("2024-02-01"))
    everything = archive.tiered_read(kept, rest, stored)
    assert ids(everything) == list(range(16))
    assert {r.tier for r in everything.select("tier").distinct().collect()} == {"hot", "warm", "cold"}


def test_inventory(spark, tmp_path, rows):
    root = str(tmp_path / "warm")
    archive.archive_warm(telemetry(spark, range(16)), root, at(CUT), KEYS)
    out = archive.tier_inventory(spark.read.parquet(root), archive.DAY_PARTS)
    assert rows(out, "month", "day", "rows") == [(1, 31, 4), (2, 1, 4), (2, 2, 2)]
    assert out.filter("bytes <= 0").count() == 0


def test_external_table(spark, tmp_path):
    root, name = str(tmp_path / "warm"), f"warm_{uuid.uuid4().hex}"
    archive.archive_warm(telemetry(spark, range(16)), root, at(CUT), KEYS)
    archive.register_warm_table(spark, name, root, ["speed", "vehicle_id"])
    try:
        assert spark.table(name).filter("month = 2").count() == 6
        stats = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {name} speed").collect()}
        assert (stats["min"], stats["max"], stats["distinct_count"]) == ("0.0", "9.0", "10")
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_the_catalog_follows_the_archive(spark, tmp_path, rows):
    root, name = str(tmp_path / "warm"), f"warm_{uuid.uuid4().hex}"
    df = telemetry(spark, range(40))
    everything = [(r["day"], r["count"]) for r in df.groupBy(F.dayofmonth("timestamp").alias("day")).count().collect()]
    try:
        kept = archive.archive_to_catalog(df, name, root, at("2024-02-03 12:00:00"), KEYS, ["speed"])
        assert rows(archive.catalog_partitions(spark, name), "month", "day", "rows") == [(1, 31, 4), (2, 1, 4), (2, 2, 4), (2, 3, 2)]
        for _ in range(2):  # a repeated run changes nothing
            kept = archive.archive_to_catalog(kept, name, root, at("2030-01-01 00:00:00"), KEYS, ["speed"])
        found = archive.catalog_partitions(spark, name)
        assert sorted(rows(found, "day", "rows")) == sorted(everything)
        assert kept.count() == 0
        exact = archive.column_stats(spark.table(name), ["speed"]).select("column", "min_value", "max_value", "nulls")
        assert rows(archive.catalog_columns(spark, name, ["speed"]), *exact.columns) == rows(exact)
        assert "PartitionFilters" in spark.table(name).filter("day = 31")._jdf.queryExecution().toString()
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_tier_of_a_row(spark):
    df = telemetry(spark, range(3), hours=24).withColumn(
        "tier", checks.tier(F.col("timestamp"), at("2024-02-02"), at("2024-02-01"))
    )
    assert [r.tier for r in df.orderBy("event_id").collect()] == ["cold", "warm", "hot"]


def test_missing_keys_and_corrected_rows(spark, tmp_path):
    root = str(tmp_path / "warm")
    text = "event_id long, vehicle_id long, timestamp timestamp, speed double"
    old = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(None, 1, old, 1.0), (2, None, old, 2.0)], text)
    for _ in range(2):
        archive.archive_warm(df, root, at(CUT), KEYS)
    assert spark.read.parquet(root).count() == 2
    assert archive.retain_hot(df, spark.read.parquet(root), at(CUT), KEYS).count() == 0
    corrected = spark.createDataFrame([(2, None, old, 3.0)], text)
    with pytest.raises(ValueError, match="missing in the archive"):
        archive.retain_hot(corrected, spark.read.parquet(root), at(CUT), KEYS)
    archive.archive_warm(corrected, root, at(CUT), KEYS)
    assert sorted(r.speed for r in spark.read.parquet(root).collect()) == [1.0, 2.0, 3.0]


def test_a_row_without_time_is_hot(spark):
    df = spark.createDataFrame([(None,)], "timestamp timestamp")
    assert df.select(checks.tier(F.col("timestamp"), at(CUT), at(CUT))).first()[0] == "hot"


def test_cooled_rows_leave_the_warm_tier(spark, tmp_path):
    warm, cold = str(tmp_path / "warm"), str(tmp_path / "cold")
    df = telemetry(spark, range(16))
    archive.archive_warm(df, warm, at("2024-03-01 00:00:00"), KEYS)
    assert ids(archive.warm_rows(spark, warm)) == list(range(16))
    for cut, left in ((CUT, 10), ("2024-02-01 00:00:00", 10), ("2024-02-03 00:00:00", 12)):
        archive.warm_to_cold(spark, warm, cold, at(cut), KEYS)
        assert ids(archive.warm_rows(spark, warm)) == list(range(left, 16))
        assert ids(spark.read.orc(cold)) == list(range(left))
