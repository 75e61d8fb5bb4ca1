"""Message envelopes: decode, encode, route and inspect topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.schemas import schema_for

BROKER_COLUMNS = ("key", "topic", "timestamp", "partition", "offset")


def read_stream(
    spark: SparkSession,
    source: str,
    entity: str,
    *,
    servers: str | None = None,
    fmt: str = "json",
    schema: T.StructType | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Subscribe to a topic, or follow a folder of files when no broker is given.

    The broker form reads from the earliest offset and tolerates lost segments;
    it needs Spark's Kafka connector on the class path.
    """
    if servers:
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", source)
            .option("startingOffsets", "earliest")
            .option("failOnDataLoss", "false")
            .options(**(options or {}))
            .load()
        )
        return decode(raw, schema or schema_for(entity))
    reader = spark.readStream.schema(schema or schema_for(entity)).options(**(options or {}))
    return reader.format(fmt).load(source)


def decode(df: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON value to typed columns beside the broker's own columns.

    A broken document gives all NULLs, a wrong field gives NULL for that field.
    """
    broker = {c: "kafka_timestamp" if c == "timestamp" else c for c in BROKER_COLUMNS if c in df.columns}
    data = F.from_json(F.col("value").cast("string"), schema).alias("data")
    return df.select(data, *[F.col(c).cast("string").alias(c) if c == "key" else F.col(c).alias(n) for c, n in broker.items()]).select("data.*", *broker.values())


def encode_envelope(df: DataFrame, key: Column, *, topic: str | None = None, offset: Column | None = None) -> DataFrame:
    """Key and JSON value of every record, ready for a broker or a file sink.

    Topic and offset are what a broker adds; give them to build a log of files.
    """
    out = [key.cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value")]
    if topic is not None:
        out.insert(0, F.lit(topic).alias("topic"))
    if offset is not None:
        out.append(offset.cast("bigint").alias("offset"))
    return df.select(*out)


def route(df: DataFrame, topic: str) -> DataFrame:
    return df.filter(F.col("topic") == topic)


def publish(coded: DataFrame, *, servers: str | None = None, path: str | None = None) -> None:
    """Send encoded records to a broker, compressed, or to a folder of files."""
    if servers:
        writer = coded.write.format("kafka").option("kafka.bootstrap.servers", servers)
        writer.option("kafka.compression.type", "gzip").save()
    else:
        coded.write.mode("append").parquet(path)


def peek(df: DataFrame, n: int = 5, width: int = 200) -> DataFrame:
    """Newest n messages per topic with a shortened value.

    The places are found on topic and offset alone: ``row_number() <= n`` becomes
    a group limit that runs before the shuffle, so a topic with most of the rows
    sends n rows per task. The n places per topic are then broadcast to pick the
    messages; no payload is sorted.
    """
    place = [c for c in ("topic", "partition", "offset") if c in df.columns]
    newest = Window.partitionBy("topic").orderBy(F.col("offset").desc(), *[c for c in place if c == "partition"])
    ranks = df.select(*place).withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= n)
    return df.join(F.broadcast(ranks), place).select(
        "topic", "rank", "offset", "key", F.substring("value", 1, width).alias("preview")
    )


def topic_counts(df: DataFrame) -> DataFrame:
    """Messages per topic and share of all; the window runs over one row per topic."""
    counts = df.groupBy("topic").agg(F.count("*").alias("messages"))
    total = F.sum("messages").over(Window.partitionBy())
    return counts.select("topic", "messages", F.round(F.col("messages") * 100.0 / total, 2).alias("share_percent"))


def flatten_location(df: DataFrame, column: str = "location", prefix: str = "") -> DataFrame:
    """Nested location to two double columns, 0.0 where missing."""
    out = df
    for axis in ("latitude", "longitude"):
        out = out.withColumn(prefix + axis, F.coalesce(F.col(f"{column}.{axis}").cast("double"), F.lit(0.0)))
    return out.drop(column)


def coerce_double(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns to double; unreadable text gives NULL."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def extract_recent(df: DataFrame, cutoff: Column, column: str = "timestamp") -> DataFrame:
    return df.filter(F.col(column) >= cutoff)


def extract_dimension(df: DataFrame) -> DataFrame:
    """Whole dimension with dates and times as ISO text."""
    out = []
    for field in df.schema:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(field.name)
        out.append(c)
    return df.select(*out)
