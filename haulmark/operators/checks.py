"""Row rules: validation, anomaly tags and tier by age. All work on batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Anomaly limits and their tags, first match wins.
THRESHOLDS = {
    "speed_max": 140.0,
    "speed_min": 0.0,
    "engine_temp_max": 110.0,
    "engine_temp_min": 40.0,
    "fuel_level_min": 5.0,
}


def _present(*columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(c).isNotNull()
    return out


def validate(df: DataFrame, entity: str, speed_max: float = 200, fuel_max: float = 100) -> DataFrame:
    """Keep rows with the required fields and plausible measures; unknown entities pass."""
    if entity == "telemetry":
        in_range = F.col("speed").between(0, speed_max) & F.col("fuel_level").between(0, fuel_max)
        return df.filter(_present("vehicle_id", "timestamp", "speed") & in_range)
    if entity == "delivery":
        return df.filter(_present("delivery_id", "vehicle_id", "status"))
    if entity == "incident":
        return df.filter(_present("incident_id", "vehicle_id", "incident_type"))
    return df


def _anomaly_rules(limits: dict[str, float]) -> list[tuple[Column, str]]:
    speed, temp, fuel = F.col("speed"), F.col("engine_temp"), F.col("fuel_level")
    return [
        (speed > limits["speed_max"], "OVER_SPEED"),
        (speed < limits["speed_min"], "INVALID_SPEED"),
        (temp > limits["engine_temp_max"], "OVERHEATING"),
        (temp < limits["engine_temp_min"], "ENGINE_COLD"),
        (fuel < limits["fuel_level_min"], "LOW_FUEL"),
    ]


def anomaly_filter(df: DataFrame, **limits: float) -> DataFrame:
    """Rows breaking at least one limit."""
    hit = F.lit(False)
    for rule, _ in _anomaly_rules(THRESHOLDS | limits):
        hit = hit | rule
    return df.filter(hit)


def anomaly_type(**limits: float) -> Column:
    rules = _anomaly_rules(THRESHOLDS | limits)
    out = F.when(*rules[0])
    for rule, tag in rules[1:]:
        out = out.when(rule, tag)
    return out.otherwise("UNKNOWN")


def anomalies(df: DataFrame, **limits: float) -> DataFrame:
    return anomaly_filter(df, **limits).withColumn("anomaly_type", anomaly_type(**limits))


def tier(ts: Column, hot_from: Column, warm_from: Column) -> Column:
    """hot within the short window, warm within the long one, cold beyond; a row without time stays hot."""
    return F.when(ts.isNull() | (ts >= hot_from), "hot").when(ts >= warm_from, "warm").otherwise("cold")
