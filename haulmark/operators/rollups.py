"""Windowed rollups and minute series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions.numeric import avg_parts, merged_avg, parts_avg, steady_avg
from haulmark.functions.timing import at, before, minute_text


def sliding_rollup(
    df: DataFrame,
    window: str = "5 minutes",
    slide: str | None = "1 minute",
    watermark: str | None = "10 minutes",
    time: str = "timestamp",
) -> DataFrame:
    """Per vehicle and window: speed mean, max, min, mean fuel and temperature, count.

    ``slide=None`` gives tumbling windows. The watermark matters on streams only.
    """
    if df.isStreaming and watermark:
        df = df.withWatermark(time, watermark)
    frame = F.window(time, window, slide) if slide else F.window(time, window)
    return (
        df.groupBy(frame.alias("w"), "vehicle_id")
        .agg(
            F.round(steady_avg(F.col("speed")), 2).alias("avg_speed"),
            F.round(F.max("speed"), 2).alias("max_speed"),
            F.round(F.min("speed"), 2).alias("min_speed"),
            F.round(steady_avg(F.col("fuel_level")), 2).alias("avg_fuel_level"),
            F.round(steady_avg(F.col("engine_temp")), 2).alias("avg_engine_temp"),
            F.count("*").alias("record_count"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "vehicle_id",
            "avg_speed",
            "max_speed",
            "min_speed",
            "avg_fuel_level",
            "avg_engine_temp",
            "record_count",
        )
    )


def recent_rollup(df: DataFrame, as_of: str, minutes: int = 5) -> DataFrame:
    """Per vehicle means over the last minutes, stamped with the span they cover."""
    start = before(as_of, minutes=minutes)
    return (
        df.filter(F.col("timestamp") >= start)
        .groupBy("vehicle_id")
        .agg(
            F.round(steady_avg(F.col("speed")), 2).alias("avg_speed"),
            F.round(steady_avg(F.col("fuel_level")), 2).alias("avg_fuel"),
            F.count("*").alias("record_count"),
        )
        .withColumns({"window_start": start, "window_end": at(as_of)})
    )


def minute_series(df: DataFrame, column: str, cutoff: Column) -> DataFrame:
    """Mean of a measure per minute since the cutoff, in time order."""
    return _minute_means(df.filter(F.col("timestamp") >= cutoff), column).orderBy("minute")


def _minute_means(df: DataFrame, column: str) -> DataFrame:
    minutes = df.groupBy(F.date_trunc("minute", "timestamp").alias("minute")).agg(
        steady_avg(F.col(column)).alias(f"avg_{column}")
    )
    return minutes.withColumn("minute", minute_text(F.col("minute")))


def mean_of_minutes(df: DataFrame, columns: list[str], as_of: str, hours: int = 24) -> DataFrame:
    """Unweighted mean of minute means over the last hours, one row.

    With no reading in that span, the mean of all readings is used. Both come
    from one pass: readings are added up per minute of the span, all older ones
    together.
    """
    recent = F.col("timestamp") >= before(as_of, hours=hours)
    minutes = df.groupBy(F.when(recent, F.date_trunc("minute", "timestamp")).alias("minute")).agg(
        *[p for c in columns for p in avg_parts(c, F.col(c))]
    )
    inside = F.col("minute").isNotNull()
    return minutes.agg(
        *[
            F.when(F.max(inside), steady_avg(F.when(inside, parts_avg(c)))).otherwise(merged_avg(c)).alias(f"avg_{c}")
            for c in columns
        ]
    )
