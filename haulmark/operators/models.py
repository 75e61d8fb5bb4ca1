"""Risk, speed, fuel and driver-state models as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions.labels import bucket, lookup
from haulmark.functions.numeric import clip, gaussian_pdf, steady_avg, steady_sum

# Multipliers of the incident rate.
BASE_RATE = 0.1
RISK = {
    "experience": {"Novice": 3.0, "Intermediate": 1.5, "Expert": 1.0, "Master": 0.6},
    "weather": {"clear": 1.0, "rain": 2.0, "fog": 2.5, "dust": 1.8},
    "traffic": {"light": 0.8, "moderate": 1.0, "heavy": 1.7, "congested": 2.2},
    "time_of_day": {"morning_rush": 1.5, "midday": 1.0, "evening_rush": 1.6, "night": 1.3},
    "behaviour": {"aggressive": 2.5, "cautious": 0.7},
}

# Speed model per road and condition.
SPEED_MEAN = {"highway": 90.0, "urban": 45.0, "rural": 70.0}
SPEED_STD = {"highway": 15.0, "urban": 10.0, "rural": 12.0}
SPEED_TIME = {"morning_rush": 0.7, "midday": 1.0, "evening_rush": 0.65, "night": 1.1}
SPEED_WEATHER = {"clear": 1.0, "rain": 0.8, "fog": 0.6, "dust": 0.7}
SPEED_DRIVER = {"cautious": 0.85, "normal": 1.0, "aggressive": 1.25}
RUSH_SPREAD = 1.3

# Mean and std of speed deviation and reaction time per driver state.
DRIVER_STATES = {
    "normal": ((0.0, 5.0), (700.0, 100.0)),
    "aggressive": ((15.0, 8.0), (500.0, 80.0)),
    "tired": ((-5.0, 5.0), (1200.0, 200.0)),
}

# Configured changes of the driver state.
DRIVER_MOVES = {
    "normal": {"normal": 0.85, "aggressive": 0.1, "tired": 0.05},
    "aggressive": {"normal": 0.3, "aggressive": 0.6, "tired": 0.1},
    "tired": {"normal": 0.2, "aggressive": 0.05, "tired": 0.75},
}

# Configured route changes.
ROUTE_MOVES = {
    "warehouse": {"warehouse": 0.0, "highway": 0.7, "urban": 0.2, "customer": 0.1},
    "highway": {"warehouse": 0.0, "highway": 0.6, "urban": 0.3, "customer": 0.1},
    "urban": {"warehouse": 0.0, "highway": 0.2, "urban": 0.6, "customer": 0.2},
    "customer": {"warehouse": 0.5, "highway": 0.3, "urban": 0.2, "customer": 0.0},
}

# Experience class of the risk model by years.
RISK_EXPERIENCE = ((5, "Novice"), (10, "Intermediate"), (15, "Expert"), (None, "Master"))


def pairs_of(moves: dict[str, dict[str, float]]) -> dict[tuple[str, str], float]:
    return {(a, b): p for a, row in moves.items() for b, p in row.items()}


def route_moves() -> dict[tuple[str, str], float]:
    return pairs_of(ROUTE_MOVES)


def risk_rate(base: float = BASE_RATE, **factors: Column) -> Column:
    """Incidents per hour: the base rate times one multiplier per factor, unknown values count 1."""
    rate = F.lit(float(base))
    for name in RISK:
        if name in factors:
            rate = rate * lookup(factors[name], RISK[name], 1.0)
    return rate


def with_risk(readings: DataFrame, drivers: DataFrame) -> DataFrame:
    """Readings, which carry weather, traffic, behaviour and time_of_day, with driver experience and incident rate."""
    years = drivers.select("driver_id", bucket(F.col("experience_years"), RISK_EXPERIENCE).alias("experience"))
    factors = {name: F.col(name) for name in RISK}
    return readings.join(years, "driver_id", "left").withColumn("rate", F.round(risk_rate(**factors), 6))


def expected_speed(road: Column, when: Column, weather: Column, behaviour: Column) -> Column:
    base = lookup(road, SPEED_MEAN, SPEED_MEAN["urban"])
    return (
        base * lookup(when, SPEED_TIME, 1.0) * lookup(weather, SPEED_WEATHER, 1.0) * lookup(behaviour, SPEED_DRIVER, 1.0)
    )


def speed_std(road: Column, when: Column) -> Column:
    base = lookup(road, SPEED_STD, SPEED_STD["urban"])
    return base * F.when(when.isin("morning_rush", "evening_rush"), RUSH_SPREAD).otherwise(1.0)


def speed_zscore(readings: DataFrame) -> DataFrame:
    """Distance of each reading, with road type, time of day, weather and behaviour, from the expected speed in standard deviations."""
    road, when = F.col("road_type"), F.col("time_of_day")
    mean = expected_speed(road, when, F.col("weather"), F.col("behaviour"))
    return readings.select(
        "event_id",
        "vehicle_id",
        "speed",
        F.round(mean, 4).alias("expected_speed"),
        F.round(speed_std(road, when), 4).alias("expected_std"),
        F.round((F.col("speed") - mean) / speed_std(road, when), 4).alias("z_score"),
    )


def rpm_from_speed(speed: Column) -> Column:
    """Engine speed in three gear bands, at most 4500."""
    rpm = (
        F.when(speed < 20, speed * 40 + 800)
        .when(speed < 60, (speed - 20) * 25 + 1500)
        .otherwise((speed - 60) * 15 + 2500)
    )
    return F.when(speed.isNotNull(), F.least(F.floor(rpm), F.lit(4500))).cast("int")


def fuel_rate(speed: Column, rpm: Column, throttle: Column, temp: Column, mean_temp: float = 85.0) -> Column:
    """Litres per hour from speed, engine speed, throttle and a cold-engine penalty, within 2-30."""
    air = (speed / 100.0) * (speed / 100.0) * 3.0
    cold = F.when(temp < mean_temp, (F.lit(mean_temp) - temp) * 0.05).otherwise(0.0)
    total = F.lit(8.0) + air + (rpm / 1000.0) * 0.5 + (throttle / 100.0) * 4.0 + cold
    return F.round(clip(total, 2.0, 30.0), 2)


def driver_state(df: DataFrame, deviation: str = "speed_deviation", reaction: str = "reaction_time_ms") -> DataFrame:
    """Probability of each driver state from two observations.

    Log likelihoods are shifted by their largest value before they are turned
    back, so far-out readings do not divide zero by zero.
    """
    def log_pdf(x: Column, mean: float, std: float) -> Column:
        return F.lit(-0.5) * ((x - mean) / std) * ((x - mean) / std) - F.log(F.lit(std))

    logs = {
        state: log_pdf(F.col(deviation), *dev) + log_pdf(F.col(reaction), *rea)
        for state, (dev, rea) in DRIVER_STATES.items()
    }
    out = df.withColumns({f"_log_{s}": c for s, c in logs.items()})
    top = F.greatest(*[F.col(f"_log_{s}") for s in logs])
    out = out.withColumns({f"_w_{s}": F.exp(F.col(f"_log_{s}") - top) for s in logs})
    total = sum([F.col(f"_w_{s}") for s in logs], F.lit(0.0))
    out = out.withColumns({f"p_{s}": F.round(F.col(f"_w_{s}") / total, 6) for s in logs})
    best = F.when(
        (F.col("p_normal") >= F.col("p_aggressive")) & (F.col("p_normal") >= F.col("p_tired")), "normal"
    ).when(F.col("p_aggressive") >= F.col("p_tired"), "aggressive").otherwise("tired")
    return out.withColumn("state", F.when(total.isNotNull(), best)).drop(
        *[f"_log_{s}" for s in logs], *[f"_w_{s}" for s in logs]
    )


def state_likelihood(x: Column, state: str, feature: int) -> Column:
    """Normal density of one observation under a driver state (0 deviation, 1 reaction time)."""
    mean, std = DRIVER_STATES[state][feature]
    return gaussian_pdf(x, F.lit(mean), F.lit(std))


def risk_expected(readings: DataFrame, drivers: DataFrame, incidents: DataFrame) -> DataFrame:
    """Expected incidents per driver (rate times hours) beside the observed ones.

    Each clock hour in which a driver reports counts as one hour at the mean
    rate of its readings.
    """
    hour = F.date_trunc("hour", F.col("timestamp"))
    hourly = (
        with_risk(readings, drivers).groupBy("driver_id", hour.alias("hour")).agg(steady_avg(F.col("rate")).alias("rate"))
    )
    expected = hourly.groupBy("driver_id").agg(
        F.count("*").alias("hours"), F.round(steady_sum(F.col("rate")), 4).alias("expected")
    )
    seen = incidents.groupBy("driver_id").agg(F.count("*").alias("n"))
    return expected.join(seen, "driver_id", "left").select(
        "driver_id", "hours", "expected", F.coalesce("n", F.lit(0)).alias("observed")
    )
