"""Stream jobs over the given tables.

Each job works off its source and ends, so its output can be read as a table.
The same operators run unchanged on batch and stream.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.functions.timing import iso_text, parse_ts
from haulmark.operators.checks import anomalies, validate
from haulmark.operators.joins import interval_pairs, union_all
from haulmark.operators.rollups import sliding_rollup
from haulmark.schemas import schema_for
from haulmark.session import run_dir
from haulmark.sources.envelopes import decode, encode_envelope, publish, read_stream
from haulmark.sources.tables import DELIVERIES, INCIDENTS, TELEMETRY, load, read_table, table_schema
from haulmark.streaming import lateness, sinks
from haulmark.streaming.keyed import read_upserted, upsert_batch


def _read(spark: SparkSession, like: DataFrame, path: str) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream, whether it is one file or a folder of files."""
    path = f"{sf_dir}/events.parquet"
    return spark.readStream.schema(table_schema(spark, path)).parquet(f"{sf_dir}/event[s].parquet")


def telemetry_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_stream(spark, sf_dir).selectExpr(*TELEMETRY)


def ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry published as JSON envelopes, then read back as a typed stream."""
    root = run_dir(spark, "ingest")
    readings = load(spark, sf_dir, "telemetry")
    fields = [f for f in schema_for("telemetry").fieldNames() if f != "timestamp"]
    messages = readings.select(*fields, iso_text(F.col("timestamp")).alias("timestamp"))
    publish(encode_envelope(messages, F.col("vehicle_id"), topic="vehicle-telemetry"), path=f"{root}/topic")
    raw = read_stream(
        spark, f"{root}/topic", "telemetry", fmt="parquet", schema=spark.read.parquet(f"{root}/topic").schema
    )
    typed = decode(raw, schema_for("telemetry")).withColumn("timestamp", parse_ts(F.col("timestamp")))
    typed = typed.drop("key", "topic")
    sinks.await_all(sinks.start(typed, "ingest", f"{root}/out", f"{root}/checkpoints"))
    return _read(spark, typed, f"{root}/out")


def memory_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running count per event type in the debug sink; one row per type."""
    counts = event_stream(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("rows"))
    name = f"counts_{uuid.uuid4().hex}"
    sinks.await_all(sinks.to_memory(counts, name, "complete"))
    return spark.table(name)


def _delivery_messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """First message of every delivery, and the partial message that completes it."""
    d = load(spark, sf_dir, "deliveries")
    opened = d.select(
        "delivery_id", "vehicle_id", "driver_id", F.lit("InProgress").alias("status"), "pickup_time",
        "distance_km", F.lit(None).cast("timestamp").alias("completion_time"),
        F.lit(None).cast("int").alias("delivery_minutes"), F.col("pickup_time").alias("event_time"),
        (2 * F.col("delivery_id")).alias("offset"),
    )
    closed = d.filter(F.col("completion_time").isNotNull()).select(
        "delivery_id",
        *[F.lit(None).cast(opened.schema[c].dataType).alias(c) for c in ("vehicle_id", "driver_id")],
        F.lit("Completed").alias("status"),
        *[F.lit(None).cast(opened.schema[c].dataType).alias(c) for c in ("pickup_time", "distance_km")],
        "completion_time", "delivery_minutes", F.col("completion_time").alias("event_time"),
        (2 * F.col("delivery_id") + 1).alias("offset"),
    )
    return opened, closed


def upsert_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries built from partial messages; of every seventh the closing message comes before the opening one."""
    root = run_dir(spark, "upsert")
    opened, closed = _delivery_messages(spark, sf_dir)
    swapped = F.col("delivery_id") % 7 == 0
    first = opened.filter(~swapped).unionByName(closed.filter(swapped))
    second = closed.filter(~swapped).unionByName(opened.filter(swapped))
    for phase, messages in enumerate((first, second)):
        sinks.lit_phase(messages, f"{root}/src", phase)
        stream = sinks.phase_stream(spark, f"{root}/src", opened).drop("phase")
        sinks.await_all(
            sinks.start_upsert(
                stream, f"{root}/target", "upsert", f"{root}/checkpoints", ["delivery_id"], ["event_time", "offset"]
            )
        )
    return read_upserted(spark, f"{root}/target", ["delivery_id"])


def checkpoint_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per part of the source after a stop and a restart from the checkpoint."""
    root = run_dir(spark, "restart")
    events = read_table(spark, sf_dir, "events")
    first = F.col("event_type").isin("error", "click")
    for phase, part in enumerate((events.filter(first), events.filter(~first))):
        sinks.lit_phase(part, f"{root}/src", phase)
        stream = sinks.phase_stream(spark, f"{root}/src", events)
        sinks.await_all(sinks.start(stream, "restart", f"{root}/out", f"{root}/checkpoints"))
    done = spark.read.parquet(f"{root}/out")
    return done.groupBy("phase").agg(F.count("*").alias("rows"), F.count_distinct("event_id").alias("events"))


def enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry stream joined to the drivers table as it is read."""
    root = run_dir(spark, "enrich")
    drivers = load(spark, sf_dir, "drivers").select("driver_id", "name", "rating")
    joined = telemetry_stream(spark, sf_dir).select("event_id", "driver_id", "speed").join(drivers, "driver_id", "left")
    sinks.await_all(sinks.start(joined, "enrich", f"{root}/out", f"{root}/checkpoints"))
    return _read(spark, joined, f"{root}/out")


def late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five-minute windows per vehicle when every tenth early reading arrives last.

    Three runs share one checkpoint: early readings, later readings, and the
    stragglers. The watermark has passed the windows of most stragglers by then.
    """
    root = run_dir(spark, "late")
    t = load(spark, sf_dir, "telemetry").select("event_id", "vehicle_id", "timestamp", "speed", "fuel_level", "engine_temp")
    early, straggler = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp"), F.col("event_id") % 10 == 0
    parts = (t.filter(early & ~straggler), t.filter(~early), t.filter(early & straggler))
    log, arrivals = sinks.watch(spark), lateness.Arrivals()
    for phase, part in enumerate(parts):
        sinks.lit_phase(part, f"{root}/src", phase)
        stream = sinks.phase_stream(spark, f"{root}/src", t)
        query = lateness.start_counted_windows(stream, f"{root}/windows", "late", f"{root}/checkpoints")
        sinks.await_all(query)
        arrivals.add(log, query)
    spark.streams.removeListener(log)
    return lateness.late_report(spark, f"{root}/windows", arrivals)


def interval_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents of a driver in the hour before each reading, both read as streams in three parts of the month.

    Closing readings and incidents of no real driver, weeks later, let the
    watermark pass all others; they are left out of the result.
    """
    root = run_dir(spark, "interval")
    readings = load(spark, sf_dir, "telemetry").select("event_id", "driver_id", "vehicle_id", "timestamp")
    incidents = load(spark, sf_dir, "incidents").select("incident_id", "driver_id", "timestamp")
    # A driver of their own: incidents without driver are filtered out before they could move the watermark.
    kinds = {name: F.lit(-1).cast(readings.schema[name].dataType).alias(name) for name in ("driver_id", "vehicle_id")}

    def closing(day: str) -> tuple[DataFrame, DataFrame]:
        one, time = spark.range(1), F.lit(day).cast("timestamp").alias("timestamp")
        none = F.lit(-1).cast("bigint")
        return (
            one.select(none.alias("event_id"), kinds["driver_id"], kinds["vehicle_id"], time),
            one.select(none.alias("incident_id"), kinds["driver_id"], time),
        )

    borders = [F.lit(f"2024-{day}").cast("timestamp") for day in ("01-01", "01-11", "01-21", "03-01")]
    within = [(F.col("timestamp") >= a) & (F.col("timestamp") < b) for a, b in zip(borders, borders[1:], strict=False)]
    parts = [(readings.filter(w), incidents.filter(w)) for w in within]
    # The first moves the watermark, and the batch of the second uses it.
    parts += [closing("2024-03-01"), closing("2024-03-02")]
    for phase, (some_readings, some_incidents) in enumerate(parts):
        sinks.lit_phase(some_readings, f"{root}/readings", phase)
        sinks.lit_phase(some_incidents, f"{root}/incidents", phase)
        pairs = interval_pairs(
            sinks.phase_stream(spark, f"{root}/readings", readings).drop("phase"),
            sinks.phase_stream(spark, f"{root}/incidents", incidents).drop("phase"),
        )
        sinks.await_all(sinks.start(pairs, "interval", f"{root}/pairs", f"{root}/checkpoints"))
    found = _read(spark, pairs, f"{root}/pairs").filter(F.col("event_id") >= 0)
    return found.groupBy("driver_id", "event_id", "timestamp", "vehicle_id").agg(F.count("incident_id").alias("incidents"))


def append_vs_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows each output mode has delivered when the source ends.

    Update mode has shown every window; append mode holds back those the
    watermark has not passed.
    """
    root = run_dir(spark, "modes")
    append = sliding_rollup(telemetry_stream(spark, sf_dir))
    sinks.await_all(sinks.start(append, "append", f"{root}/append", f"{root}/checkpoints"))
    update = sliding_rollup(telemetry_stream(spark, sf_dir))
    write = sinks.append_batches((f"{root}/update", lambda b: b))
    sinks.await_all(sinks.per_batch(update, write, "update", f"{root}/checkpoints", mode="update", closing=False))
    shown = spark.read.parquet(f"{root}/update")
    keys = ["window_start", "vehicle_id"]
    latest = shown.groupBy(*keys).agg(F.max_by("record_count", "batch_id").alias("record_count"))
    out = [("append", _read(spark, append, f"{root}/append")), ("update", latest)]
    rows = [
        df.agg(F.count("*").alias("windows"), F.sum("record_count").alias("records")).select(
            F.lit(mode).alias("mode"), "windows", "records"
        )
        for mode, df in out
    ]
    return rows[0].unionByName(rows[1])


def stream_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = run_dir(spark, "anomalies")
    found = anomalies(validate(telemetry_stream(spark, sf_dir), "telemetry")).select(
        "event_id", "vehicle_id", "speed", "engine_temp", "fuel_level", "anomaly_type", "timestamp"
    )
    sinks.await_all(sinks.start(found, "anomalies", f"{root}/out", f"{root}/checkpoints"))
    return _read(spark, found, f"{root}/out")


def several_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read of the source feeds valid readings and anomalies; incidents run beside it."""
    root = run_dir(spark, "several")
    valid = validate(telemetry_stream(spark, sf_dir), "telemetry")
    write = sinks.append_batches((f"{root}/valid", lambda b: b), (f"{root}/anomalies", anomalies))
    errors = event_stream(spark, sf_dir).filter(F.col("event_type") == "error").select("event_id", "user_id")
    sinks.await_all(
        sinks.per_batch(valid, write, "telemetry", f"{root}/checkpoints"),
        sinks.start(errors, "incidents", f"{root}/incidents", f"{root}/checkpoints"),
    )
    rows = [
        spark.read.parquet(f"{root}/{name}").agg(F.count("*").alias("rows")).select(F.lit(name).alias("output"), "rows")
        for name in ("valid", "anomalies", "incidents")
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def complete_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five streams side by side: raw telemetry, its rollup, anomalies, valid deliveries and valid incidents.

    Tables with a key are upserted; every window is upserted as it grows.
    """
    root = run_dir(spark, "complete")
    raw = telemetry_stream(spark, sf_dir).select(
        "event_id", "vehicle_id", "driver_id", "timestamp", "speed", "fuel_level", "engine_temp"
    )
    valid = validate(raw, "telemetry")
    windows = sliding_rollup(valid).withColumn("seen", F.col("record_count"))
    orders = f"{sf_dir}/orders.parquet"
    deliveries = spark.readStream.schema(table_schema(spark, orders)).parquet(f"{sf_dir}/order[s].parquet").selectExpr(*DELIVERIES)
    incidents = event_stream(spark, sf_dir).filter("event_type = 'error'").selectExpr(*INCIDENTS)
    checkpoints = f"{root}/checkpoints"

    def numbered(df: DataFrame, key: str) -> DataFrame:
        """The key stands for the offset that a broker would give."""
        return df.withColumn("offset", F.col(key))

    keyed = {  # stream, keys, order, output mode
        "telemetry": (numbered(raw, "event_id"), ["event_id"], ["timestamp", "offset"], "append"),
        "windows": (windows, ["window_start", "window_end", "vehicle_id"], ["seen"], "update"),
        "deliveries": (numbered(validate(deliveries, "delivery"), "delivery_id"), ["delivery_id"], ["pickup_time", "offset"], "append"),
        "incidents": (numbered(validate(incidents, "incident"), "incident_id"), ["incident_id"], ["timestamp", "offset"], "append"),
    }
    running = [
        sinks.per_batch(df, upsert_batch(f"{root}/{name}", keys, order), name, checkpoints, mode=mode, closing=mode != "update")
        for name, (df, keys, order, mode) in keyed.items()
    ]
    found = anomalies(valid)
    running.append(sinks.start(found, "anomalies", f"{root}/anomalies", checkpoints))
    sinks.await_all(*running)
    out = {name: read_upserted(spark, f"{root}/{name}", keys) for name, (_, keys, _, _) in keyed.items()}
    out["anomalies"] = _read(spark, found, f"{root}/anomalies")
    rows = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("output"), "rows") for name, df in out.items()]
    records = out["windows"].agg(F.sum("record_count").alias("rows")).select(F.lit("window_records").alias("output"), "rows")
    return union_all([*rows, records])


def dedup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which a third is sent a second time, each kept once."""
    root = run_dir(spark, "dedup")
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value")
    copies = events.filter(F.col("event_id") % 3 == 0)
    for phase, part in enumerate((events.unionAll(copies), copies)):
        sinks.lit_phase(part, f"{root}/src", phase)
        stream = sinks.phase_stream(spark, f"{root}/src", events).drop("phase")
        once = stream.withWatermark("ts", "1 day").dropDuplicatesWithinWatermark(["event_id"])
        sinks.await_all(sinks.start(once, "dedup", f"{root}/out", f"{root}/checkpoints"))
    return _read(spark, once, f"{root}/out")


def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input rows per query as its progress reports state them.

    Progress counts rows that leave the scan; the query has no filter that
    could be pushed down, so that is every row.
    """
    root = run_dir(spark, "progress")
    log = sinks.watch(spark)
    query = sinks.start(telemetry_stream(spark, sf_dir), "telemetry", f"{root}/out", f"{root}/checkpoints")
    sinks.await_all(query)
    table = sinks.progress_table(spark, log, query)
    return table.groupBy("query").agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"))
