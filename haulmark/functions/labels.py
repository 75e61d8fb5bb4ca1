"""CASE expressions and text forms shared by reports and row operators."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket labels and limits as used in the reports.
EXPERIENCE_4 = (
    (5, "Novice (0-5 years)"),
    (10, "Intermediate (5-10 years)"),
    (15, "Experienced (10-15 years)"),
    (None, "Expert (15+ years)"),
)
EXPERIENCE_3 = ((5, "Novice"), (10, "Intermediate"), (None, "Expert"))
EXPERIENCE_3_SHORT = ((2, "Novice"), (5, "Intermediate"), (None, "Expert"))
CAPACITY = (
    (1000, "Small (<1000kg)"),
    (2000, "Medium (1000-2000kg)"),
    (3000, "Large (2000-3000kg)"),
    (None, "Extra Large (3000kg+)"),
)
# Incident types above 100, above 60 and up to 60.
SPEED_BANDS = (
    ("speeding", "harsh_acceleration", "sharp_turn"),
    ("harsh_braking", "sharp_turn", "sudden_lane_change", "speeding"),
    ("harsh_braking", "harsh_acceleration", "sudden_lane_change"),
)
ROAD_TYPES = {"warehouse": "urban", "highway": "highway", "urban": "urban", "customer": "urban"}
SEVERITY_SCORES = {"high": 3, "medium": 2, "low": 1}


def bucket(c: Column, levels, unknown: str | None = None) -> Column:
    """First level whose limit is above the value.

    A missing value lands in the open last level, as SQL CASE ... ELSE does,
    unless a label for unknown values is given.
    """
    out = None
    if unknown is not None:
        out = F.when(c.isNull(), F.lit(unknown))
    for limit, label in levels:
        if limit is None:
            return out.otherwise(F.lit(label))
        out = F.when(c < limit, label) if out is None else out.when(c < limit, label)
    return out


def lookup(c: Column, table: dict, default) -> Column:
    """Value of a small fixed table, or the default for unknown keys."""
    pairs = F.create_map(*[F.lit(v) for v in chain.from_iterable(table.items())])
    return F.coalesce(F.try_element_at(pairs, c), F.lit(default))


def road_type(state: Column) -> Column:
    return lookup(state, ROAD_TYPES, "urban")


def motion_status(speed: Column, moving_above: float = 5) -> Column:
    return F.when(speed > moving_above, "Moving").otherwise("Idle")


def speed_band(speed: Column) -> Column:
    """Incident types a reading of this speed can lead to, as an array."""
    fast, medium, slow = (F.array(*[F.lit(kind) for kind in band]) for band in SPEED_BANDS)
    return F.when(speed > 100, fast).when(speed > 60, medium).otherwise(slow)


def temp_zone(temp: Column) -> Column:
    """Engine temperature zone; outside 75-120 degrees there is none."""
    return (
        F.when((temp >= 75) & (temp < 95), "normal")
        .when((temp >= 95) & (temp < 105), "warning")
        .when((temp >= 105) & (temp <= 120), "critical")
    )


def severity_score(severity: Column) -> Column:
    s = F.lower(severity)
    out = None
    for name, score in SEVERITY_SCORES.items():
        out = F.when(s == name, score) if out is None else out.when(s == name, score)
    return out


def title_text(c: Column) -> Column:
    """snake_case to Title Case, N/A when missing."""
    return F.coalesce(F.initcap(F.replace(c, F.lit("_"), F.lit(" "))), F.lit("N/A"))


def capital_text(c: Column) -> Column:
    """First letter upper, rest lower, N/A when missing."""
    text = F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1_000_000)))
    return F.coalesce(text, F.lit("N/A"))


def padded_id(prefix: str, c: Column, width: int) -> Column:
    """Prefix and zero-padded number; longer numbers are kept whole."""
    text = c.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0")))
