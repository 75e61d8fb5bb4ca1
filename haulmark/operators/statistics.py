"""Counts, means, quantiles and distribution checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.functions.numeric import ratio, steady_avg
from haulmark.operators.joins import join_same, union_all
from haulmark.operators.quantiles import exact_quantiles


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, all tables in one job."""
    return union_all(
        [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("entity"), "rows") for name, df in tables.items()]
    )


def counts_by(df: DataFrame, column: str, entity: str) -> DataFrame:
    return df.groupBy(F.col(column).cast("string").alias("category")).agg(F.count("*").alias("rows")).select(
        F.lit(entity).alias("entity"), F.lit(column).alias("column"), "category", "rows"
    )


def daily_sketches(df: DataFrame, columns: list[str], keys: list[str], time: str = "timestamp", lg_k: int = 14) -> DataFrame:
    """Per day and keys, a sketch of the distinct values of each column; days merge into any span without reading rows again.

    A sketch of 2^lg_k registers has a relative standard error of about 1.04 / 2^(lg_k / 2).
    Numbers are sketched as their text, as a sketch takes integers and text only.
    """
    sketches = [F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(c) for c in columns]
    return df.groupBy(F.to_date(time).alias("day"), *keys).agg(*sketches)


def distinct_over(sketches: DataFrame, columns: list[str], keys: list[str], first: str, last: str) -> DataFrame:
    """Estimated distinct values of each column over the days from first to last, out of stored daily sketches."""
    span = sketches.filter(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return span.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def state_share(df: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """Share of each state in percent, per key or overall.

    The window runs over the counts: one row per state, or per key and state.
    """
    keys = [key] if key else []
    counts = df.groupBy(*keys, column).agg(F.count("*").alias("rows"))
    total = F.sum("rows").over(Window.partitionBy(*keys))
    return counts.withColumn("share_percent", F.round(F.col("rows") * 100.0 / total, 2))


def profile_stats(df: DataFrame, key: str, column: str) -> DataFrame:
    """Mean, population std, min, max and quartiles per key, rounded to 2 places."""
    v = F.col("v")
    moments = {
        "readings": F.count(v),
        "mean": F.round(steady_avg(v), 2),
        "std": F.round(F.stddev_pop(v), 2),
        "min": F.round(F.min(v), 2),
        "max": F.round(F.max(v), 2),
    }
    quartiles = {"q25": 0.25, "median": 0.5, "q75": 0.75}
    found = exact_quantiles(df, key, column, quartiles, moments)
    return found.select(key, *moments, *[F.round(F.col(q), 2).alias(q) for q in quartiles])


def normality_check(df: DataFrame, key: str, column: str) -> DataFrame:
    """Share of readings within 1, 2 and 3 standard deviations per key, with pass flags."""
    values = df.filter(F.col(column).isNotNull()).select(key, F.col(column).alias("v"))
    stats = df.groupBy(key).agg(steady_avg(F.col(column)).alias("mu"), F.stddev_pop(column).alias("sd"))
    away = F.round(F.abs(F.col("v") - F.col("mu")), 8)
    # One row per key joins the readings, which are counted as they are read.
    shares = (
        join_same(values, stats, [key])
        .groupBy(key)
        .agg(*[(F.count_if(away <= F.round(F.col("sd") * k, 8)) / F.count("v")).alias(f"w{k}") for k in (1, 2, 3)])
    )
    # Tolerated shares within 1, 2 and 3 standard deviations.
    return shares.select(
        key,
        F.col("w1").between(0.60, 0.75).alias("rule_68"),
        F.col("w2").between(0.90, 0.98).alias("rule_95"),
        F.col("w3").between(0.95, 1.00).alias("rule_99"),
        *[F.round(F.col(f"w{k}") * 100, 2).alias(f"actual_{k}std") for k in (1, 2, 3)],
    )


def incident_dispersion(df: DataFrame, key: str = "vehicle_id", keys: DataFrame | None = None) -> DataFrame:
    """Mean and variance of daily incident counts per key, days without incidents included.

    With a dimension as ``keys``, its keys without any incident are reported too.

    Empty days add nothing to the sums, so only the length of the calendar
    enters as a number and no (key, day) grid is built.
    """
    day = F.to_date("timestamp")
    calendar = df.agg((F.datediff(F.max(day), F.min(day)) + 1).alias("days"))
    daily = df.groupBy(key, day.alias("day")).agg(F.count("*").alias("n"))
    sums = daily.groupBy(key).agg(
        F.sum("n").alias("s"),
        F.sum(F.col("n") * F.col("n")).alias("ss"),
        F.count("*").alias("busy"),
        F.min("n").alias("low"),
        F.max("n").alias("max"),
    )
    if keys is not None:
        known = keys.select(key).distinct().withColumns({c: F.lit(0).cast("bigint") for c in sums.columns if c != key})
        sums = sums.unionByName(known).groupBy(key).agg(*[F.max(c).alias(c) for c in sums.columns if c != key])
    days = F.col("days")
    mean = F.col("s") / days
    moments = sums.withColumn("days", calendar.scalar()).withColumns(
        {"m": mean, "v": (F.col("ss") - F.col("s") * F.col("s") / days) / days}
    )
    spread = ratio(F.col("v"), F.col("m"))
    return moments.select(
        key,
        "days",
        F.round(F.col("m"), 3).alias("mean"),
        F.round(F.col("v"), 3).alias("variance"),
        F.round(spread, 3).alias("variance_to_mean_ratio"),
        F.round(F.sqrt(F.greatest(F.col("v"), F.lit(0.0))), 3).alias("std"),
        F.when(F.col("busy") < days, 0).otherwise(F.col("low")).alias("min"),
        F.col("max"),
        F.round(spread, 8).between(0.8, 1.2).alias("follows_poisson"),
    )


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, stored bytes and mean bytes per row of file-based tables."""
    out = []
    for name, df in tables.items():
        files = df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count("*").alias("n"), F.max("_metadata.file_size").alias("b")
        )
        out.append(
            files.agg(F.sum("n").alias("rows"), F.sum("b").alias("bytes"), F.count("*").alias("files")).select(
                F.lit(name).alias("entity"), "files", "rows", "bytes",
                F.round(ratio(F.col("bytes"), F.col("rows")), 2).alias("avg_row_bytes"),
            )
        )
    return union_all(out)
