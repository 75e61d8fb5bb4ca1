"""Hot, warm and cold tiers. One cutoff is chosen by the caller and used in every step."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

TIME = "timestamp"
DAY_PARTS = ("year", "month", "day")
MONTH_PARTS = ("year", "month")


def archive_candidates(df: DataFrame, cutoff: Column) -> DataFrame:
    return df.filter(F.col(TIME) < cutoff)


def _with_parts(df: DataFrame) -> DataFrame:
    t = F.col(TIME)
    return df.withColumns({"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t)})


def _spread(df: DataFrame, parts: tuple[str, ...]) -> DataFrame:
    """Bring rows of one partition folder together, so folders hold few files.

    A rebalance lets adaptive execution split a day or month that holds most of
    the rows over many tasks and merge small ones.
    """
    return df.hint("rebalance", *[F.col(p) for p in parts])


def stored(spark: SparkSession, root: str, fmt: str) -> DataFrame | None:
    """The tier under a folder, or None before its first write."""
    try:
        return spark.read.format(fmt).load(root)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _same_span(tier: DataFrame, rows: DataFrame, parts: tuple[str, ...]) -> DataFrame:
    """The folders of a tier that can hold any of the rows."""
    first, last = rows.agg(F.min(TIME), F.max(TIME)).first()
    if first is None:
        return tier.limit(0)
    number = F.col("year") * 100 + F.col("month")
    low, high = first.year * 100 + first.month, last.year * 100 + last.month
    if "day" in parts:
        number = number * 100 + F.col("day")
        low, high = low * 100 + first.day, high * 100 + last.day
    return tier.filter(number.between(low, high))


def _not_in(rows: DataFrame, tier: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key and content the tier does not hold; a missing key equals a missing key."""
    content = F.xxhash64(*sorted(c for c in rows.columns if c not in DAY_PARTS))
    known = tier.select(*[F.col(k).alias(f"_k_{k}") for k in keys], content.alias("_held"))
    same = F.col("_content") == F.col("_held")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return rows.withColumn("_content", content).join(known, same, "left_anti").drop("_content")


def _append_missing(rows: DataFrame, root: str, fmt: str, codec: str, parts: tuple[str, ...], keys: list[str]) -> None:
    """Append the rows a tier does not hold yet.

    Nothing stored is rewritten, so rows that arrive for an old day and repeated
    or broken-off runs neither lose nor double any. A corrected row is kept
    beside the one it corrects.
    """
    tier = stored(rows.sparkSession, root, fmt)
    if tier is not None:
        rows = _not_in(rows, _same_span(tier, rows, parts), keys)
    (
        _spread(rows, parts)
        .write.format(fmt)
        .mode("append")
        .option("compression", codec)
        .partitionBy(*parts)
        .save(root)
    )


def archive_warm(df: DataFrame, root: str, cutoff: Column, keys: list[str], codec: str = "snappy") -> None:
    """Rows older than the cutoff to Parquet by day."""
    _append_missing(_with_parts(archive_candidates(df, cutoff)), root, "parquet", codec, DAY_PARTS, keys)


def retain_hot(df: DataFrame, warm: DataFrame, cutoff: Column, keys: list[str]) -> DataFrame:
    """Rows that stay hot; refuses to drop rows the archive does not hold."""
    due = archive_candidates(df, cutoff)
    if not _not_in(due, _same_span(warm, due, DAY_PARTS), keys).isEmpty():
        raise ValueError("rows older than the cutoff are missing in the archive; nothing removed")
    return df.filter((F.col(TIME) >= cutoff) | F.col(TIME).isNull())


def hot_to_warm(df: DataFrame, root: str, cutoff: Column, keys: list[str]) -> DataFrame:
    """Archive, verify, and return the rows that stay hot."""
    archive_warm(df, root, cutoff, keys)
    return retain_hot(df, df.sparkSession.read.parquet(root), cutoff, keys)


def archive_cold(
    spark: SparkSession, warm_root: str, cold_root: str, cutoff: Column, keys: list[str], codec: str = "zlib"
) -> None:
    """Warm rows older than the cutoff to ORC by month."""
    old = archive_candidates(spark.read.parquet(warm_root), cutoff).drop("day")
    _append_missing(old, cold_root, "orc", codec, MONTH_PARTS, keys)


def warm_to_cold(
    spark: SparkSession, warm_root: str, cold_root: str, cutoff: Column, keys: list[str], codec: str = "zlib"
) -> None:
    """Cool old rows, verify that the cold tier holds them, and let them leave the warm tier.

    The cutoff is noted beside the warm tier; ``warm_rows`` leaves out what lies
    before it, from that moment on and all at once. Files of cooled days may
    then be deleted at any time.
    """
    archive_cold(spark, warm_root, cold_root, cutoff, keys, codec)
    due = archive_candidates(spark.read.parquet(warm_root), cutoff).drop("day")
    if not _not_in(due, _same_span(spark.read.orc(cold_root), due, MONTH_PARTS), keys).isEmpty():
        raise ValueError("rows older than the cutoff are missing in the cold tier; nothing removed")
    spark.range(1).select(cutoff.alias("cooled_until")).write.mode("append").parquet(f"{warm_root}-cooled")


def warm_rows(spark: SparkSession, warm_root: str) -> DataFrame:
    """The warm tier without the rows that have moved to the cold one."""
    warm, marks = spark.read.parquet(warm_root), stored(spark, f"{warm_root}-cooled", "parquet")
    if marks is None:
        return warm
    until = marks.agg(F.max("cooled_until")).scalar()
    return warm.filter(F.col(TIME) >= until)


def warm_scan(spark: SparkSession, root: str, year: int, month: int, day: int | None = None) -> DataFrame:
    """One month or day of the warm tier; only its folders are read."""
    wanted = (F.col("year") == year) & (F.col("month") == month)
    if day is not None:
        wanted = wanted & (F.col("day") == day)
    return spark.read.parquet(root).filter(wanted)


def tiered_read(hot: DataFrame, warm: DataFrame, cold: DataFrame) -> DataFrame:
    """All tiers as one table."""
    tiers = {"hot": hot, "warm": warm, "cold": cold}
    frames = [df.drop(*DAY_PARTS).withColumn("tier", F.lit(name)) for name, df in tiers.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def tier_inventory(df: DataFrame, parts: tuple[str, ...]) -> DataFrame:
    """Files, bytes and rows per partition folder."""
    files = df.groupBy(*parts, F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.max("_metadata.file_size").alias("b")
    )
    return files.groupBy(*parts).agg(
        F.count("*").alias("files"), F.sum("b").alias("bytes"), F.sum("n").alias("rows")
    )


def create_warm_table(spark: SparkSession, name: str, root: str) -> None:
    """External table over the warm folder, unless there is one; its partitions are added by the archive job."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(root).schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({fields}) USING PARQUET PARTITIONED BY ({', '.join(DAY_PARTS)}) LOCATION '{root}'"
    )


def _partition(day: Row) -> str:
    return f"PARTITION ({', '.join(f'{p}={day[p]}' for p in DAY_PARTS)})"


def keep_statistics(spark: SparkSession, name: str, days: list[Row], columns: list[str]) -> None:
    """Add the days as partitions and count them; other partitions keep their figures. Columns are analysed over the table."""
    if not days:
        return
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(map(_partition, days))}")
    spark.catalog.refreshTable(name)
    for day in days:
        spark.sql(f"ANALYZE TABLE {name} {_partition(day)} COMPUTE STATISTICS")
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")


def register_warm_table(spark: SparkSession, name: str, root: str, columns: list[str]) -> None:
    """External table over a warm folder that is there already, with its partitions and column statistics."""
    create_warm_table(spark, name, root)
    days = spark.read.parquet(root).select(*DAY_PARTS).distinct().collect()  # one row per day
    keep_statistics(spark, name, days, columns)


def archive_to_catalog(df: DataFrame, name: str, root: str, cutoff: Column, keys: list[str], columns: list[str]) -> DataFrame:
    """Archive, verify, bring the catalog up to date for the days written, and return the rows that stay hot.

    Hot rows leave only after the archive holds them, so the days of what is due are the days that this run writes.
    """
    days = _with_parts(archive_candidates(df, cutoff)).select(*DAY_PARTS).distinct().collect()  # one row per day
    kept = hot_to_warm(df, root, cutoff, keys)
    if days:
        create_warm_table(df.sparkSession, name, root)
        keep_statistics(df.sparkSession, name, days, columns)
    return kept


def _described(spark: SparkSession, what: str) -> dict[str, str]:
    return {r[0]: r[1] for r in spark.sql(f"DESCRIBE EXTENDED {what}").collect()}


def catalog_partitions(spark: SparkSession, name: str) -> DataFrame:
    """Partitions with the rows that the catalog states; no file of the table is read."""
    rows = []
    for (spec,) in spark.sql(f"SHOW PARTITIONS {name}").collect():
        parts = [int(p.split("=")[1]) for p in spec.split("/")]
        day = ", ".join(spec.split("/"))
        stated = re.search(r"(\d+) rows", _described(spark, f"{name} PARTITION ({day})").get("Partition Statistics", ""))
        rows.append((*parts, int(stated.group(1)) if stated else None))
    return spark.createDataFrame(rows, "year int, month int, day int, rows bigint")


def catalog_columns(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """Range, missing and distinct values per column as the catalog states them; distinct is an estimate."""
    rows = []
    for column in columns:
        stated = _described(spark, f"{name} {column}")
        rows.append((column, *[None if stated[k] == "NULL" else float(stated[k]) for k in ("min", "max", "num_nulls", "distinct_count")]))
    found = spark.createDataFrame(rows, "column string, min_value double, max_value double, nulls double, distinct_values double")
    return found.withColumns({c: F.col(c).cast("bigint") for c in ("nulls", "distinct_values")})


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, range and distinct values per column, as the catalog statistics hold them."""
    row = df.agg(
        F.count("*").alias("rows"),
        *[
            F.struct(
                F.min(c).cast("double").alias("lo"),
                F.max(c).cast("double").alias("hi"),
                F.count_distinct(c).alias("distinct"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
            ).alias(c)
            for c in columns
        ],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}.lo").alias("min_value"),
            F.col(f"{c}.hi").alias("max_value"),
            F.col(f"{c}.distinct").alias("distinct_values"),
            F.col(f"{c}.nulls").alias("nulls"),
        )
        for c in columns
    ]
    return row.select("rows", F.inline(F.array(*lines)))
