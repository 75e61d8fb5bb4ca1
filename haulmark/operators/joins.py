"""Joins of facts with dimensions and with each other.

Dimensions carry no broadcast hint: Spark compares their size with
``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges larger ones,
splitting skewed partitions. Where a report only needs aggregates, facts are
aggregated by their foreign keys first, so a hot key shrinks to one row per
task before any shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR = 3600


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join in which a missing key matches a missing key, as in GROUP BY; still a hash or merge join."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, reduce(lambda a, b: a & b, same), how).drop(*[f"_r_{k}" for k in keys])


def join_per_key(df: DataFrame, stats: DataFrame, key: str, spread: Column, parts: int = 16) -> DataFrame:
    """Join rows to one-row-per-key figures with every key split over ``parts`` tasks."""
    salted = df.withColumn("_part", F.pmod(F.hash(spread), F.lit(parts)))
    copies = stats.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return join_same(salted, copies, [key, "_part"]).drop("_part")


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Foreign keys without a dimension row, with the rows that use them.

    NULL keys count as orphans.
    """
    dim_key = dim_key or key
    used = fact.groupBy(F.col(key).alias("fk")).agg(F.count("*").alias("rows"))
    return used.join(dim.select(F.col(dim_key).alias("fk")), "fk", "left_anti")


def with_activity(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Dimension rows whose key occurs in the facts."""
    return dim.join(fact.select(key).distinct(), key, "left_semi")


def interval_counts(
    readings: DataFrame,
    incidents: DataFrame,
    key: str = "driver_id",
    seconds: int = HOUR,
    reading_id: str = "event_id",
    columns: list[str] | None = None,
) -> DataFrame:
    """Incidents of the same key within ``seconds`` up to and including each reading.

    This is the left interval join, aggregated per reading, without building
    the pairs. Each incident opens (+1) at its own time and closes (-1) after
    ``seconds``. A running sum over these marks gives the count. Time is cut
    into slices as long as the interval: an incident is open in its own slice
    from its time on, and in the next slice from the start until it closes, so
    slices need nothing from each other and a hot key spreads over all of them.
    Incidents without time match nothing; readings without time count 0.
    """
    width = F.lit(seconds * 1_000_000)
    columns = columns or []
    us = F.unix_micros("timestamp")
    payload = F.struct(F.col(reading_id), F.col("timestamp"), *[F.col(c) for c in columns])
    asked = readings.select(
        F.col(key), us.alias("us"), F.lit(1).alias("step"), F.lit(0).alias("change"), payload.alias("row")
    ).withColumn("slice", F.floor(F.col("us") / width))
    marks = (
        incidents.filter(F.col(key).isNotNull() & F.col("timestamp").isNotNull())
        .select(F.col(key), us.alias("t"), F.floor(us / width).alias("s"))
        .select(
            key,
            F.inline(
                F.array(
                    _mark(F.col("t"), 0, 1, F.col("s")),
                    _mark(F.col("t"), 0, 1, F.col("s") + 1),
                    _mark(F.col("t") + width, 2, -1, F.col("s") + 1),
                )
            ),
        )
        # Equal marks merge before the shuffle.
        .groupBy(key, "us", "step", "slice")
        .agg(F.sum("change").cast("int").alias("change"))
        .withColumn("row", F.lit(None).cast(asked.schema["row"].dataType))
        .select(key, "us", "step", "change", "row", "slice")
    )
    order = Window.partitionBy(key, "slice").orderBy("us", "step")
    open_now = F.sum("change").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        asked.unionByName(marks)
        .withColumn("incidents", open_now)
        .filter(F.col("row").isNotNull())
        .select(key, "row.*", "incidents")
    )


def interval_pairs(
    readings: DataFrame, incidents: DataFrame, key: str = "driver_id", seconds: int = HOUR, delay: str = "10 minutes"
) -> DataFrame:
    """Readings with each incident of the same key within ``seconds`` up to and including them, and readings without any.

    Works on two tables and on two streams. On streams the watermarks of both
    sides and the width of the interval bound the state: an incident is kept
    until no reading within its interval can come, a reading without incident is
    given out once none can come for it. Rows later than ``delay`` are dropped.
    """
    right = incidents.select(F.col(key).alias("_key"), F.col("timestamp").alias("incident_time"), "incident_id")
    if readings.isStreaming:
        readings, right = readings.withWatermark("timestamp", delay), right.withWatermark("incident_time", delay)
    span = F.expr(f"INTERVAL {seconds} SECONDS")
    within = (F.col("incident_time") >= F.col("timestamp") - span) & (F.col("incident_time") <= F.col("timestamp"))
    return readings.join(right, (F.col(key) == F.col("_key")) & within, "left_outer").drop("_key")


def _mark(us: Column, step: int, change: int, slice: Column) -> Column:
    return F.struct(us.alias("us"), F.lit(step).alias("step"), F.lit(change).alias("change"), slice.alias("slice"))


def deliveries_by_vehicle_day(deliveries: DataFrame, warehouses: DataFrame | None = None) -> DataFrame:
    """Deliveries per vehicle, pickup day and, if warehouses are given, origin city."""
    keys = ["vehicle_id", F.to_date("pickup_time").alias("day")]
    if warehouses is None:
        return deliveries.groupBy(*keys).agg(F.count("*").alias("matches"))
    origin = warehouses.select("warehouse_id", F.col("city").alias("origin_city"))
    return deliveries.join(origin, "warehouse_id", "left").groupBy(*keys, "origin_city").agg(F.count("*").alias("matches"))


def merge_partial(base: DataFrame, delta: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Apply partial updates: per column the latest non-NULL value wins, NULL never overwrites.

    Updates of one batch are combined first (order columns decide), then merged
    with the stored rows by a full outer join on the key.
    """
    fields = [c for c in base.columns if c not in keys]
    newest = combine_updates(delta, keys, order, fields)
    merged = base.alias("old").join(newest.alias("new"), keys, "full")
    return merged.select(*keys, *[F.coalesce(F.col(f"new.{c}"), F.col(f"old.{c}")).alias(c) for c in fields])


def combine_updates(delta: DataFrame, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """One row per key with the last non-NULL value of every field."""
    rank = F.struct(*order)
    latest = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in fields]
    return delta.groupBy(*keys).agg(*latest)


def dedup(df: DataFrame, keys: list[str] | None, order: list[str]) -> DataFrame:
    """One row per key, the last by order; without a key, distinct rows."""
    if not keys:
        return df.distinct()
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*").select(*df.columns)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
