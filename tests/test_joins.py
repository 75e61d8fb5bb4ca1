import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from haulmark.operators import joins

START = dt.datetime(2024, 1, 1)
HOUR = dt.timedelta(hours=1)


@pytest.fixture(scope="module")
def driven(spark):
    """A third of all readings and incidents belong to driver 1; some times lie exactly one hour apart."""
    rnd = random.Random(11)
    moment = lambda: START + dt.timedelta(minutes=rnd.randrange(0, 600, 5))
    who = lambda i: 1 if i % 3 == 0 else rnd.choice([2, 3, None])
    readings = [(i, who(i), moment(), i * 0.5) for i in range(400)]
    incidents = [(i, who(i), moment()) for i in range(150)]
    return (
        readings,
        incidents,
        spark.createDataFrame(readings, "event_id long, driver_id long, timestamp timestamp, speed double"),
        spark.createDataFrame(incidents, "incident_id long, driver_id long, timestamp timestamp"),
    )


def test_interval_counts(driven, rows):
    readings, incidents, left, right = driven
    out = joins.interval_counts(left, right, columns=["speed"])
    wanted = [
        (e, s, sum(1 for _, d2, t2 in incidents if d is not None and d2 == d and t - HOUR <= t2 <= t))
        for e, d, t, s in readings
    ]
    assert rows(out, "event_id", "speed", "incidents") == sorted(wanted, key=repr)


def test_interval_counts_by_other_span(driven, rows):
    readings, incidents, left, right = driven
    out = joins.interval_counts(left, right, seconds=600)
    span = dt.timedelta(minutes=10)
    wanted = [
        (e, sum(1 for _, d2, t2 in incidents if d is not None and d2 == d and t - span <= t2 <= t))
        for e, d, t, _ in readings
    ]
    assert rows(out, "event_id", "incidents") == sorted(wanted, key=repr)


def test_join_per_key_keeps_every_row(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    stats = df.groupBy("k").agg(F.max("v").alias("top"))
    out = joins.join_per_key(df, stats, "k", F.col("v"), parts=4)
    assert out.count() == 1000
    assert out.filter(F.col("top") != F.col("k") + 998).count() == 0


def test_orphans_include_missing_keys(spark, rows):
    fact = spark.createDataFrame([(1,), (2,), (2,), (None,)], "vehicle_id long")
    dim = spark.createDataFrame([(1,)], "vehicle_id long")
    assert rows(joins.orphans(fact, dim, "vehicle_id")) == [(2, 2), (None, 1)]
    assert rows(joins.with_activity(dim, fact, "vehicle_id")) == [(1,)]


def test_merge_partial(spark, rows):
    base = spark.createDataFrame([("a", "Open", 1.0), ("b", "Open", 2.0)], "id string, status string, km double")
    # The completion of "a" arrives before its older update; NULL never overwrites.
    delta = spark.createDataFrame(
        [("a", "Done", None, 9), ("a", "Moving", 5.0, 3), ("c", None, 4.0, 1)], "id string, status string, km double, at int"
    )
    out = joins.merge_partial(base, delta, ["id"], ["at"])
    assert rows(out) == [("a", "Done", 5.0), ("b", "Open", 2.0), ("c", None, 4.0)]


def test_dedup(spark, rows):
    df = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 1)], "id int, v string, at int")
    assert rows(joins.dedup(df, ["id"], ["at"])) == [(1, "y", 2), (2, "z", 1)]
    assert joins.dedup(df.unionAll(df), None, []).count() == 3


def test_vehicle_day_weights(spark, rows):
    d = spark.createDataFrame(
        [(1, START, 7), (1, START + 2 * HOUR, 7), (1, START + 30 * HOUR, 8), (2, START, 99)],
        "vehicle_id long, pickup_time timestamp, warehouse_id int",
    )
    w = spark.createDataFrame([(7, "A"), (8, "B")], "warehouse_id int, city string")
    out = joins.deliveries_by_vehicle_day(d, w).select("vehicle_id", "origin_city", "matches")
    assert rows(out) == [(1, "A", 2), (1, "B", 1), (2, None, 1)]


def test_interval_counts_without_times(spark, rows):
    left = spark.createDataFrame([(1, 7, None), (2, 7, START)], "event_id long, driver_id long, timestamp timestamp")
    right = spark.createDataFrame([(1, 7, None), (2, 7, START)], "incident_id long, driver_id long, timestamp timestamp")
    assert rows(joins.interval_counts(left, right), "event_id", "incidents") == [(1, 0), (2, 1)]
