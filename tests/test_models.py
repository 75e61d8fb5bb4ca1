import math

import pytest
from pyspark.sql import functions as F

from haulmark.functions import geo, labels, numeric, timing
from haulmark.operators import models


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_risk_rate_closed_form(spark):
    known = dict(experience="Novice", weather="rain", traffic="heavy", time_of_day="evening_rush", behaviour="aggressive")
    rate = one(spark, models.risk_rate(**{k: F.lit(v) for k, v in known.items()}))
    assert math.isclose(rate, 4.08)
    assert math.isclose(one(spark, models.risk_rate(weather=F.lit("hail"), experience=F.lit(None).cast("string"))), 0.1)
    assert math.isclose(one(spark, models.risk_rate(behaviour=F.lit("cautious"))), 0.07)


@pytest.mark.parametrize("speed, rpm", [(0, 800), (19, 1560), (20, 1500), (60, 2500), (100, 3100), (500, 4500)])
def test_rpm(spark, speed, rpm):
    assert one(spark, models.rpm_from_speed(F.lit(float(speed)))) == rpm


def test_fuel_rate_is_bounded(spark):
    rate = lambda *v: one(spark, models.fuel_rate(*[F.lit(float(x)) for x in v]))
    assert rate(100, 2000, 50, 85) == 14.0
    assert rate(100, 2000, 50, 65) == 15.0
    assert rate(1000, 4500, 100, 20) == 30.0
    assert rate(0, 0, -10000, 90) == 2.0


def test_driver_state(spark):
    df = spark.createDataFrame([(0.0, 700.0), (15.0, 500.0), (-5.0, 1200.0), (1e6, 1e6), (None, 1.0)],
                               "speed_deviation double, reaction_time_ms double")
    out = models.driver_state(df).collect()
    assert [r.state for r in out[:3]] == ["normal", "aggressive", "tired"]
    assert all(abs(r.p_normal + r.p_aggressive + r.p_tired - 1) < 1e-5 for r in out[:4])
    assert out[4].state is None
    # Plain likelihoods of the first row.
    pdf = lambda x, m, s: math.exp(-((x - m) ** 2) / (2 * s * s)) / math.sqrt(2 * math.pi * s * s)
    likes = [pdf(0, *d) * pdf(700, *r) for d, r in models.DRIVER_STATES.values()]
    assert abs(out[0].p_normal - likes[0] / sum(likes)) < 1e-6
    assert math.isclose(one(spark, models.state_likelihood(F.lit(3.0), "tired", 0)), pdf(3, -5, 5))


def test_configured_moves_are_stochastic():
    for row in models.ROUTE_MOVES.values():
        assert math.isclose(sum(row.values()), 1.0)


def test_haversine(spark):
    km = one(spark, geo.haversine_km(*[F.lit(x) for x in (24.8607, 67.0011, 24.9, 67.1)]))
    p = [math.radians(x) for x in (24.8607, 67.0011, 24.9, 67.1)]
    a = math.sin((p[2] - p[0]) / 2) ** 2 + math.cos(p[0]) * math.cos(p[2]) * math.sin((p[3] - p[1]) / 2) ** 2
    assert math.isclose(km, 2 * 6371 * math.atan2(math.sqrt(a), math.sqrt(1 - a)), rel_tol=1e-12)
    assert one(spark, geo.haversine_km(*[F.lit(5.0)] * 4)) == 0.0


@pytest.mark.parametrize("text, wanted", [
    ("2025-12-14T10:30:00Z", "2025-12-14 10:30:00"), ("2025-12-14T10:30:00.123456", "2025-12-14 10:30:00.123456"),
    ("garbage", None)])
def test_parse(spark, text, wanted):
    found = one(spark, timing.parse_ts(F.lit(text)).cast("string"))
    assert found == wanted
    assert one(spark, timing.parse_or(F.lit(text), timing.at("2020-01-01")).cast("string")) == (wanted or "2020-01-01 00:00:00")


@pytest.mark.parametrize("hour, label", [(6, "night"), (7, "morning_rush"), (9, "morning_rush"), (10, "midday"),
                                         (16, "midday"), (17, "evening_rush"), (19, "evening_rush"), (20, "night")])
def test_time_of_day(spark, hour, label):
    assert one(spark, timing.time_of_day(timing.at(f"2024-01-01 {hour:02}:59:59"))) == label


def test_whole_minutes_over_days(spark):
    span = timing.minutes_between(timing.at("2024-01-01 00:00:30"), timing.at("2024-01-03 00:02:29"))
    assert one(spark, span) == 2881


def test_text_forms(spark):
    assert one(spark, labels.title_text(F.lit("harsh_braking"))) == "Harsh Braking"
    assert one(spark, labels.title_text(F.lit(None).cast("string"))) == "N/A"
    assert one(spark, labels.capital_text(F.lit("hIGH"))) == "High"
    assert one(spark, labels.padded_id("VEH-", F.lit(7), 5)) == "VEH-00007"
    assert one(spark, labels.padded_id("VEH-", F.lit(1234567), 5)) == "VEH-1234567"


def test_buckets_and_lookup(spark):
    level = lambda y: one(spark, labels.bucket(F.lit(y).cast("int"), labels.EXPERIENCE_4))
    assert level(4) == "Novice (0-5 years)" and level(15) == "Expert (15+ years)" and level(None) == "Expert (15+ years)"
    assert one(spark, labels.bucket(F.lit(None).cast("int"), labels.EXPERIENCE_3, "Unknown")) == "Unknown"
    assert one(spark, labels.road_type(F.lit("moon"))) == "urban"


def test_numbers(spark):
    assert one(spark, numeric.ratio(F.lit(1), F.lit(0))) == 0.0
    assert one(spark, numeric.clip(F.lit(500.0), 10, 140)) == 140.0
    assert one(spark, numeric.clip(F.lit(None).cast("double"), 10, 140)) is None
