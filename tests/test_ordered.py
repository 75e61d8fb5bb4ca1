"""Row order across slices, against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from haulmark.operators import models, ordered

START = dt.datetime(2024, 1, 1)
SCHEMA = "event_id long, vehicle_id long, timestamp timestamp, speed double, fuel_level double, engine_temp double, segment string"


@pytest.fixture(scope="module")
def readings(spark):
    """One vehicle holds a third of the rows, with equal times, gaps of days and a vehicle without id."""
    rnd = random.Random(7)
    out = []
    for i in range(900):
        vehicle = 1 if i % 3 == 0 else rnd.choice([2, 3, 4, None])
        hours = rnd.choice([0, 0, 1, 2, 30, 31, 100])
        t = START + dt.timedelta(hours=hours, seconds=rnd.randrange(0, 3600, 60))
        out.append((i, vehicle, t, float(rnd.randrange(0, 12000)) / 100, float(rnd.randrange(100)),
                    float(rnd.randrange(30, 130)), rnd.choice(["highway", "urban"])))
    return out


@pytest.fixture(scope="module")
def frame(spark, readings):
    return spark.createDataFrame(readings, SCHEMA).repartition(7)


def by_vehicle(readings):
    groups = {}
    for r in sorted(readings, key=lambda r: (r[2], r[0])):
        groups.setdefault(r[1], []).append(r)
    return groups


@pytest.mark.parametrize("ranges", [1, 2, 7, 60])
def test_previous_reading(frame, readings, rows, ranges):
    found = ordered.previous_reading(frame, ["speed"], ranges=ranges)
    wanted = []
    for group in by_vehicle(readings).values():
        before = None
        for r in group:
            wanted.append((r[0], before))
            before = r[3]
    assert rows(found, "event_id", "prev_speed") == sorted(wanted, key=repr)


def test_previous_keeps_null_values(spark, rows):
    t = [START + dt.timedelta(hours=h) for h in range(3)]
    df = spark.createDataFrame([(i, 1, t[i], v) for i, v in enumerate([5.0, None, 7.0])],
                               "event_id long, vehicle_id long, timestamp timestamp, speed double")
    assert rows(ordered.previous_reading(df, ["speed"]), "event_id", "prev_speed") == [(0, None), (1, 5.0), (2, None)]


def test_speed_jump(frame, readings, rows):
    wanted = []
    for group in by_vehicle(readings).values():
        for a, b in zip(group, group[1:]):
            change = round(b[3] - a[3], 6)
            if abs(change) > 15:
                wanted.append((b[0], change, round(a[3] + (15 if change > 0 else -15), 2)))
    assert rows(ordered.speed_jump(frame), "event_id", "change", "allowed_speed") == sorted(wanted, key=repr)


def test_transition_shares_sum_to_one(frame):
    out = ordered.transition_matrix(frame, "segment", models.route_moves())
    sums = {r[0]: r[1] for r in out.groupBy("from_state").agg(F.sum("observed")).collect()}
    assert set(sums) == {"highway", "urban"}
    assert all(abs(v - 1) < 1e-3 for v in sums.values())


def test_arrival_order(spark, rows):
    data = [(i, 1, START + dt.timedelta(minutes=m)) for i, m in enumerate([0, 5, 3, 4, 9])]
    df = spark.createDataFrame(data, "event_id long, vehicle_id long, timestamp timestamp")
    assert rows(ordered.ts_monotonic(df, ranges=4)) == [(1, 5, 1, False)]


def test_fuel_rises_are_refuels(spark, rows):
    data = [(i, 1, START + dt.timedelta(hours=i), f) for i, f in enumerate([50.0, 40.0, 40.0, 90.0])]
    df = spark.createDataFrame(data, "event_id long, vehicle_id long, timestamp timestamp, fuel_level double")
    assert rows(ordered.fuel_monotonic(df)) == [(1, 1, 1, 1, False)]


def test_ar1_of_a_constant_and_a_line(spark):
    data = [(i, 1, START + dt.timedelta(minutes=40 * i), 85.0) for i in range(6)]
    data += [(10 + i, 2, START + dt.timedelta(minutes=40 * i), 80.0 + i) for i in range(6)]
    df = spark.createDataFrame(data, "event_id long, vehicle_id long, timestamp timestamp, engine_temp double")
    out = {r.vehicle_id: r for r in ordered.ar1_check(df).collect()}
    assert out[1].lag1_autocorrelation is None and not out[1].ar1_property_holds
    assert out[2].lag1_autocorrelation == 1.0 and out[2].ar1_property_holds
    assert out[2].theoretical_variance == 256.41


def test_latest_per_key(frame, readings, rows):
    out = ordered.latest_per_key(frame, "vehicle_id", ["timestamp", "event_id"], ["event_id", "speed"])
    wanted = [(v, g[-1][0], g[-1][3]) for v, g in by_vehicle(readings).items()]
    assert rows(out) == sorted(wanted, key=repr)


def test_one_scan_one_row_shuffle_and_few_markers(spark, frame):
    plan = ordered.previous_reading(frame.select("vehicle_id", "timestamp", "event_id", "speed"), ["speed"], ranges=50)
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    shuffles = [line for line in text.splitlines() if "Exchange" in line and "Broadcast" not in line]
    rows = [line for line in shuffles if "Reused" not in line and "SinglePartition" not in line]
    # the frame's own repartition, then one of the rows; the borders read the same one
    assert len(rows) == 2 and sum("Reused" in line for line in shuffles) == 1, text


def test_ranges_are_even_whatever_the_keys(spark):
    hot = spark.range(20_000).selectExpr(
        "if(id % 3 = 0, id, 7) vehicle_id", "timestamp_seconds(id div 50) timestamp", "id event_id", "0.0D speed"
    )
    place = ["vehicle_id", "timestamp", "event_id"]
    cuts = ordered.range_cuts(hot, place, 20)
    sizes = [r["count"] for r in hot.groupBy(ordered.range_of(hot, place, cuts).alias("r")).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 3 * 20_000 / 20


def test_equal_places_and_empty_tables(spark, rows):
    schema = "event_id long, vehicle_id long, timestamp timestamp, speed double"
    same = spark.createDataFrame([(1, 1, START, float(v)) for v in range(9)] + [(None, None, None, None)] * 3, schema)
    for ranges in (1, 5, 40):
        found = ordered.previous_reading(same, ["speed"], ranges=ranges)
        assert rows(found.filter("vehicle_id = 1"), "speed", "prev_speed") == sorted(
            [(float(v), float(v - 1) if v else None) for v in range(9)], key=repr
        )
    assert ordered.previous_reading(same.limit(0), ["speed"]).count() == 0


def test_hours_with_incidents_only(spark, rows):
    readings = spark.createDataFrame(
        [(1, 1, START, 10.0, 24.0, 67.0, 50.0)],
        "event_id long, vehicle_id long, timestamp timestamp, speed double, latitude double, longitude double, fuel_level double",
    )
    late = START + dt.timedelta(hours=5)
    incidents = spark.createDataFrame([(1, START), (1, late), (2, late), (2, late)], "vehicle_id long, timestamp timestamp")
    out = ordered.hourly_aggregations(readings, incidents)
    assert rows(out) == sorted(
        [(1, START, 10.0, 10.0, 0.0, 0.0, 1), (1, late, None, None, 0.0, 0.0, 1), (2, late, None, None, 0.0, 0.0, 2)], key=repr
    )
