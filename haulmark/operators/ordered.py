"""Operators over ordered readings.

A window per vehicle would put every row of one vehicle in one task. Here all
rows are cut into ranges of (vehicle, order) of about equal size, so a vehicle
with a third of all rows fills a third of the ranges. Rows are ordered inside
each range, and a table of one row per range carries the last row on to the
next range.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from haulmark.functions.geo import haversine_km
from haulmark.functions.numeric import ratio, sample_corr, steady_avg, steady_sum

SAMPLED = 20  # rows that the cuts are chosen from, for each range
MOST_SAMPLED = 1_000_000
FEW = 32  # cuts that are compared one by one instead of by binary search


def _comparable(df: DataFrame, name: str) -> Column:
    return F.unix_micros(name) if isinstance(df.schema[name].dataType, TimestampType) else F.col(name)


def range_cuts(df: DataFrame, columns: list[str], ranges: int) -> list[tuple]:
    """Values of the columns that cut the rows into ranges of about equal size, from a bounded sample by hash."""
    wanted = min(MOST_SAMPLED, SAMPLED * ranges)
    values = df.select(*[_comparable(df, c).alias(c) for c in columns])
    sample = values.orderBy(F.xxhash64(*columns)).limit(wanted).collect() if ranges > 1 else []
    rows = sorted((tuple(r) for r in sample), key=lambda r: [(v is not None, v) for v in r])
    cuts = [rows[i * len(rows) // ranges] for i in range(1, ranges)] if rows else []
    return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]


def range_of(df: DataFrame, columns: list[str], cuts: list[tuple]) -> Column:
    """Number of cuts at or below a row, by binary search in a constant array; missing values come first."""
    if not cuts:
        return F.lit(0)
    place = [_comparable(df, c) for c in columns]
    kinds = [t.dataType for t in df.select(*place).schema]
    here = F.struct(*[p.alias(c) for c, p in zip(columns, place, strict=True)])
    bounds = [F.struct(*[F.lit(v).cast(k).alias(c) for c, v, k in zip(columns, cut, kinds, strict=True)]) for cut in cuts]
    if len(bounds) <= FEW:  # stays inside generated code
        return reduce(add, [(bound <= here).cast("int") for bound in bounds])
    array = F.array(*bounds)
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= F.lit(len(cuts))) & (F.get(array, F.least(at + step, F.lit(len(cuts))) - 1) <= here), at + step
        ).otherwise(at),
    )


def with_previous(df: DataFrame, key: str, order: list[str], columns: list[str], ranges: int | None = None) -> DataFrame:
    """Adds ``prev_<column>`` from the preceding row of the same key.

    The rows are shuffled once, by range; the last rows of the ranges come from
    the same shuffle. There are as many ranges as shuffle partitions.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = [key, *order]
    placed = df.withColumn("_range", range_of(df, place, range_cuts(df, place, ranges))).repartitionById(ranges, "_range")
    row = F.struct(key, *columns)
    # Rows in the same place are told apart by their values, so that both sides agree on the last one.
    rest = [c for c in columns if c not in place]
    inside = Window.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_first() for c in (*place, *rest)])
    # All columns are named, so that both sides read one exchange.
    last = F.max_by(F.struct(*df.columns), F.struct(*place, *rest)).alias("_last")
    borders = placed.groupBy("_range").agg(last)
    next_range = F.lead("_range").over(Window.orderBy("_range"))  # of one row per range
    borders = borders.select(next_range.alias("_range"), "_last").filter(F.col("_range").isNotNull())
    linked = placed.withColumn("_before", F.lag(row).over(inside)).join(F.broadcast(borders), "_range", "left")

    def previous(c: str) -> Column:
        in_range = F.when(F.col(f"_before.{key}").eqNullSafe(F.col(key)), F.col(f"_before.{c}"))
        across = F.when(F.col("_last").isNotNull() & F.col(f"_last.{key}").eqNullSafe(F.col(key)), F.col(f"_last.{c}"))
        return F.when(F.col("_before").isNotNull(), in_range).otherwise(across)

    return linked.withColumns({f"prev_{c}": previous(c) for c in columns}).drop("_range", "_before", "_last")


def previous_reading(df: DataFrame, columns: list[str], key: str = "vehicle_id", ranges: int | None = None) -> DataFrame:
    return with_previous(df, key, ["timestamp", "event_id"], columns, ranges)


def hourly_aggregations(readings: DataFrame, incidents: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Per vehicle and hour with readings or incidents: mean and top speed, distance, fuel used and incidents.

    Distance and fuel belong to the hour of the later reading; a rise of the
    fuel level is a refuel and uses none.
    """
    columns = ["latitude", "longitude", "fuel_level"]
    steps = previous_reading(readings.select(key, "timestamp", "event_id", "speed", *columns), columns, key)
    km = haversine_km(F.col("prev_latitude"), F.col("prev_longitude"), F.col("latitude"), F.col("longitude"))
    used = F.greatest(F.col("prev_fuel_level") - F.col("fuel_level"), F.lit(0.0))
    used = F.when(F.col("prev_fuel_level").isNotNull() & F.col("fuel_level").isNotNull(), used)
    hour = F.date_trunc("hour", "timestamp").alias("time_bucket")
    hours = steps.groupBy(key, hour).agg(
        F.round(steady_avg(F.col("speed")), 2).alias("avg_speed"),
        F.round(F.max("speed"), 2).alias("max_speed"),
        F.coalesce(F.round(steady_sum(km), 3), F.lit(0.0)).alias("distance_km"),
        F.coalesce(F.round(steady_sum(used), 2), F.lit(0.0)).alias("fuel_used"),
    )
    seen = incidents.groupBy(key, hour).agg(F.count("*").alias("n"))
    # Both sides are one row per vehicle and hour; a union and a second aggregate keep the hours of either.
    measures = ["avg_speed", "max_speed", "distance_km", "fuel_used"]
    both = hours.withColumn("n", F.lit(0).cast("bigint")).unionByName(seen, allowMissingColumns=True)
    return both.groupBy(key, "time_bucket").agg(
        *[F.max(c).alias(c) for c in measures[:2]],
        *[F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in measures[2:]],
        F.sum("n").alias("incident_count"),
    )


def route_distance(df: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Kilometres along the GPS points of each vehicle."""
    place = ["latitude", "longitude"]
    steps = previous_reading(df.select(key, "timestamp", "event_id", *place), place, key)
    km = haversine_km(F.col("prev_latitude"), F.col("prev_longitude"), F.col("latitude"), F.col("longitude"))
    return steps.groupBy(key).agg(
        F.count("*").alias("points"), F.coalesce(F.round(steady_sum(km), 3), F.lit(0.0)).alias("distance_km")
    )


def ar1_check(
    df: DataFrame, column: str = "engine_temp", phi: float = 0.95, mean: float = 85, sigma: float = 5, key: str = "vehicle_id"
) -> DataFrame:
    """Sample moments and lag-1 correlation per vehicle against the AR(1) parameters."""
    pairs = previous_reading(df.select(key, "timestamp", "event_id", column), [column], key)
    x, before = F.col(column), F.col(f"prev_{column}")
    found = pairs.groupBy(key).agg(
        F.count("*").alias("readings"),
        F.round(steady_avg(x), 2).alias("sample_mean"),
        F.round(F.var_pop(x), 2).alias("sample_variance"),
        sample_corr(before, x).alias("corr"),
    )
    return found.select(
        key,
        "readings",
        "sample_mean",
        F.lit(float(mean)).alias("theoretical_mean"),
        "sample_variance",
        F.lit(round(sigma**2 / (1 - phi**2), 2)).alias("theoretical_variance"),
        F.round(F.col("corr"), 3).alias("lag1_autocorrelation"),
        F.lit(float(phi)).alias("theoretical_phi"),
        F.coalesce(F.abs(F.col("corr") - phi) < 0.1, F.lit(False)).alias("ar1_property_holds"),
    )


def ar1_residual(
    df: DataFrame, column: str = "engine_temp", phi: float = 0.95, mean: float = 85, sigma: float = 5, key: str = "vehicle_id"
) -> DataFrame:
    """Readings further than 3 sigma from their AR(1) forecast."""
    pairs = previous_reading(df.select(key, "timestamp", "event_id", column), [column], key)
    forecast = (F.col(f"prev_{column}") - float(mean)) * phi + float(mean)
    return (
        pairs.withColumn("residual", F.round(F.col(column) - forecast, 6))
        .filter(F.abs("residual") > 3.0 * sigma)
        .select("event_id", key, "timestamp", column, "residual")
    )


def speed_jump(df: DataFrame, limit: float = 15, key: str = "vehicle_id") -> DataFrame:
    """Readings whose speed differs from the one before by more than the limit.

    ``allowed_speed`` is the previous speed moved by the limit in the same direction.
    """
    steps = previous_reading(df.select(key, "timestamp", "event_id", "speed"), ["speed"], key)
    change = F.col("speed") - F.col("prev_speed")
    return (
        steps.withColumn("change", F.round(change, 6))
        .filter(F.abs("change") > limit)
        .withColumn("allowed_speed", F.round(F.col("prev_speed") + F.signum("change") * limit, 2))
        .select("event_id", key, "timestamp", "speed", "prev_speed", "change", "allowed_speed")
    )


def ts_monotonic(df: DataFrame, key: str = "vehicle_id", ranges: int | None = None) -> DataFrame:
    """Per vehicle, readings that arrive with an earlier time than the one before."""
    steps = with_previous(df.select(key, "timestamp", "event_id"), key, ["event_id"], ["timestamp"], ranges)
    late = F.count_if(F.col("timestamp") < F.col("prev_timestamp"))
    return steps.groupBy(key).agg(
        F.count("*").alias("readings"), late.alias("out_of_order"), (late == 0).alias("passed")
    )


def fuel_monotonic(df: DataFrame, key: str = "vehicle_id") -> DataFrame:
    """Per vehicle, steps where fuel falls, stays or rises; a rise is a refuel."""
    steps = previous_reading(df.select(key, "timestamp", "event_id", "fuel_level"), ["fuel_level"], key)
    now, before = F.col("fuel_level"), F.col("prev_fuel_level")
    return steps.groupBy(key).agg(
        F.count_if(now < before).alias("falls"),
        F.count_if(now == before).alias("flat"),
        F.count_if(now > before).alias("refuels"),
        (F.count_if(now > before) == 0).alias("passed"),
    )


def transition_matrix(
    df: DataFrame, column: str, expected: dict[tuple[str, str], float], key: str = "vehicle_id"
) -> DataFrame:
    """Observed share of every state change, next to the configured one."""
    steps = previous_reading(df.select(key, "timestamp", "event_id", column), [column], key)
    moves = (
        steps.filter(F.col(f"prev_{column}").isNotNull())
        .groupBy(F.col(f"prev_{column}").alias("from_state"), F.col(column).alias("to_state"))
        .agg(F.count("*").alias("moves"))
    )
    # One row per pair of states from here on.
    of_state = F.sum("moves").over(Window.partitionBy("from_state"))
    target = F.lit(None).cast("double")
    for (a, b), p in expected.items():
        target = F.when((F.col("from_state") == a) & (F.col("to_state") == b), F.lit(float(p))).otherwise(target)
    return moves.select(
        "from_state",
        "to_state",
        "moves",
        F.round(ratio(F.col("moves"), of_state), 4).alias("observed"),
        target.alias("configured"),
    )


def latest_per_key(df: DataFrame, key: str, order: list[str], columns: list[str]) -> DataFrame:
    """Last row per key, found by an aggregate that combines before the shuffle."""
    newest = F.max_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(key).agg(newest.alias("_row")).select(key, "_row.*")
