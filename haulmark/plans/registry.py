"""Named queries: each takes a session and a data folder and returns a DataFrame.

Limits of the reports are set so that the small test tables return rows; the
functions' own defaults are the published ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from haulmark.functions import geo, labels, numeric, timing
from haulmark.operators import archive, checks, joins, kpis, models, ordered, quality, rollups, staging, statistics, typed
from haulmark.plans import reports
from haulmark.schemas import DIMENSIONS, ENTITIES, KEYS
from haulmark.session import run_dir
from haulmark.sources import envelopes
from haulmark.sources.tables import AS_OF, Star, conditions, load, observed_drivers, read_table, with_throttle
from haulmark.sources.versioned import VersionedTable
from haulmark.streaming import jobs, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def lookback():
    """Twenty days, so that part of the month lies before it."""
    return reports.last_days(AS_OF, 20)


def hot_from():
    return timing.before(AS_OF, hours=48)


def warm_from():
    """Ten days instead of 30: the test data spans one month, and every tier should hold rows."""
    return timing.before(AS_OF, days=10)


TELEMETRY_ROW = ["event_id", "vehicle_id", "timestamp", "speed", "fuel_level", "engine_temp"]


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return add


def star(name: str) -> Callable[[Callable[[Star], DataFrame]], Callable]:
    """A query over the star views only."""

    def add(fn: Callable[[Star], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: fn(Star(spark, sf_dir))
        return fn

    return add


def views(s: Star, names=ENTITIES) -> dict[str, DataFrame]:
    return {n: getattr(s, n) for n in names}


# --- sources -----------------------------------------------------------------


def message_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact tables as one log of envelopes with topic, offset, key and JSON value."""
    s = Star(spark, sf_dir)
    parts = (
        ("vehicle-telemetry", s.telemetry, "event_id", "vehicle_id"),
        ("deliveries", s.deliveries, "delivery_id", "delivery_id"),
        ("incidents", s.incidents, "incident_id", "incident_id"),
    )
    return joins.union_all(
        [
            envelopes.encode_envelope(envelopes.extract_dimension(df), F.col(key), topic=topic, offset=F.col(offset))
            for topic, df, offset, key in parts
        ]
    )


QUERIES["stream_ingest"] = jobs.ingest


@query("json_decode")
def json_decode(spark, sf_dir):
    schema = "vehicle_id long, timestamp string, speed double, fuel_level double, rpm double, driver_id long"
    log = envelopes.route(message_log(spark, sf_dir), "vehicle-telemetry")
    decoded = envelopes.decode(log, StructType.fromDDL(schema))
    return decoded.withColumn("timestamp", timing.parse_ts(F.col("timestamp"))).drop("topic")




@query("scan_full")
def scan_full(spark, sf_dir):
    """Whole tables that a dashboard load reads."""
    return statistics.table_counts({e: load(spark, sf_dir, e) for e in ("customers", "telemetry", "deliveries", "incidents")})


@star("flatten_location")
def flatten_location(s):
    both = s.warehouses.select(F.lit("warehouse").alias("kind"), F.col("warehouse_id").cast("bigint").alias("id"), "location")
    return envelopes.flatten_location(
        both.unionByName(s.customers.select(F.lit("customer").alias("kind"), F.col("customer_id").alias("id"), "location"))
    )


@query("coerce_numeric")
def coerce_numeric(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select(
        "event_id", F.col("value").cast("string").alias("value"), F.regexp_replace("props", "[{}]", "").alias("props")
    )
    return envelopes.coerce_double(events, ["value", "props"])


@star("extract_recent")
def extract_recent(s):
    cutoff = timing.before(AS_OF, hours=24)
    out = envelopes.extract_recent(s.telemetry, cutoff)
    return out.select("event_id", "vehicle_id", "timestamp", "speed", "fuel_level")


@star("extract_dimension")
def extract_dimension(s):
    return envelopes.extract_dimension(s.vehicles)


@query("route_by_topic")
def route_by_topic(spark, sf_dir):
    log = message_log(spark, sf_dir)
    out = []
    for topic in ("vehicle-telemetry", "deliveries", "incidents"):
        branch = envelopes.route(log, topic)
        out.append(branch.agg(F.count("*").alias("messages"), F.count_distinct("key").alias("keys"))
                   .select(F.lit(topic).alias("topic"), "messages", "keys"))
    return joins.union_all(out)


@query("peek_per_topic")
def peek_per_topic(spark, sf_dir):
    return envelopes.peek(message_log(spark, sf_dir), 5, 200).select(
        "topic", "rank", "offset", "key", (F.length("preview") <= 200).alias("short")
    )


@query("topic_counts")
def topic_counts(spark, sf_dir):
    return envelopes.topic_counts(message_log(spark, sf_dir).select("topic"))


# --- tiers -------------------------------------------------------------------


ARCHIVE_KEYS = ["event_id"]


def _hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "telemetry").select(*TELEMETRY_ROW)


def _archived(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the warm tier with all telemetry older than 48 hours."""
    root = f"{run_dir(spark, 'warm')}/telemetry"
    archive.archive_warm(_hot(spark, sf_dir), root, hot_from(), ARCHIVE_KEYS)
    return root


def _cooled(spark: SparkSession, warm_root: str) -> str:
    root = f"{run_dir(spark, 'cold')}/telemetry"
    archive.archive_cold(spark, warm_root, root, warm_from(), ARCHIVE_KEYS)
    return root


@query("warm_scan")
def warm_scan(spark, sf_dir):
    return archive.warm_scan(spark, _archived(spark, sf_dir), 2024, 1, 15)


@query("tiered_read")
def tiered_read(spark, sf_dir):
    warm_root = f"{run_dir(spark, 'warm')}/telemetry"
    kept = archive.hot_to_warm(_hot(spark, sf_dir), warm_root, hot_from(), ARCHIVE_KEYS)
    cold_root = f"{run_dir(spark, 'cold')}/telemetry"
    archive.warm_to_cold(spark, warm_root, cold_root, warm_from(), ARCHIVE_KEYS)
    return archive.tiered_read(kept, archive.warm_rows(spark, warm_root), spark.read.orc(cold_root))


@star("archive_candidates")
def archive_candidates(s):
    due = archive.archive_candidates(s.telemetry, hot_from())
    return due.agg(F.count("*").alias("rows"), F.min("timestamp").alias("oldest"), F.max("timestamp").alias("newest"))


@query("archive_warm")
def archive_warm(spark, sf_dir):
    return spark.read.parquet(_archived(spark, sf_dir))


@query("archive_retain")
def archive_retain(spark, sf_dir):
    warm = spark.read.parquet(_archived(spark, sf_dir))
    return archive.retain_hot(_hot(spark, sf_dir), warm, hot_from(), ARCHIVE_KEYS)


@query("archive_cold")
def archive_cold(spark, sf_dir):
    return spark.read.orc(_cooled(spark, _archived(spark, sf_dir)))


@query("tier_inventory")
def tier_inventory(spark, sf_dir):
    return archive.tier_inventory(spark.read.parquet(_archived(spark, sf_dir)), archive.DAY_PARTS)


@query("tier_inventory_rows")
def tier_inventory_rows(spark, sf_dir):
    """The part of the inventory that does not depend on the files."""
    return tier_inventory(spark, sf_dir).select("year", "month", "day", "rows")


@query("partition_stats")
def partition_stats(spark, sf_dir):
    return archive.column_stats(spark.read.parquet(_archived(spark, sf_dir)), ["vehicle_id", "speed", "fuel_level"])


CATALOG_COLUMNS = ["vehicle_id", "speed", "fuel_level"]


def _catalogued(spark: SparkSession, sf_dir: str) -> str:
    """Name of a catalog table over the warm tier after two archive runs, the second over what the first kept."""
    name, root = f"warm_{uuid.uuid4().hex}", f"{run_dir(spark, 'warm')}/telemetry"
    kept = archive.archive_to_catalog(_hot(spark, sf_dir), name, root, warm_from(), ARCHIVE_KEYS, CATALOG_COLUMNS)
    archive.archive_to_catalog(kept, name, root, hot_from(), ARCHIVE_KEYS, CATALOG_COLUMNS)
    return name


@query("catalog_partitions")
def catalog_partitions(spark, sf_dir):
    name = _catalogued(spark, sf_dir)
    return archive.catalog_partitions(spark, name)


@query("catalog_columns")
def catalog_columns(spark, sf_dir):
    """What the catalog states, beside the exact number of distinct values, which its estimate must be near to."""
    name = _catalogued(spark, sf_dir)
    stated = archive.catalog_columns(spark, name, CATALOG_COLUMNS)
    exact = archive.column_stats(spark.table(name), CATALOG_COLUMNS).select("column", F.col("distinct_values").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= 0.15 * F.col("exact")
    return stated.join(exact, "column").select("column", "min_value", "max_value", "nulls", near.alias("distinct_near"))


@query("catalog_scan")
def catalog_scan(spark, sf_dir):
    """One day by the table's name: the partition comes from the catalog."""
    return spark.table(_catalogued(spark, sf_dir)).filter("year = 2024 AND month = 1 AND day = 15")


@star("tier_assign")
def tier_assign(s):
    tier = archive_tier()
    return s.telemetry.groupBy(tier.alias("tier")).agg(
        F.count("*").alias("rows"), F.min("timestamp").alias("oldest"), F.max("timestamp").alias("newest")
    )


def archive_tier():
    return checks.tier(F.col("timestamp"), hot_from(), warm_from())


# --- sinks -------------------------------------------------------------------

QUERIES["stream_memory_sink"] = jobs.memory_counts
QUERIES["stream_upsert"] = jobs.upsert_deliveries
QUERIES["stream_checkpoint_restart"] = jobs.checkpoint_restart


@star("merge_partial_updates")
def merge_partial_updates(s):
    d = s.deliveries
    fields = ["delivery_id", "vehicle_id", "status", "pickup_time", "completion_time", "delivery_minutes"]
    even = F.col("delivery_id") % 2 == 0
    # Stored: open deliveries with even ids. Updates: first messages of the rest and all completions.
    opened = d.select(
        "delivery_id", "vehicle_id", F.lit("InProgress").alias("status"), "pickup_time",
        F.lit(None).cast("timestamp").alias("completion_time"), F.lit(None).cast("int").alias("delivery_minutes"),
    )
    closed = d.filter(F.col("completion_time").isNotNull()).select(
        "delivery_id", F.lit(None).cast("bigint").alias("vehicle_id"), F.lit("Completed").alias("status"),
        F.lit(None).cast("timestamp").alias("pickup_time"), "completion_time", "delivery_minutes",
    )
    updates = opened.filter(~even).withColumn("event_time", F.col("pickup_time")).unionByName(
        closed.withColumn("event_time", F.col("completion_time"))
    )
    return joins.merge_partial(opened.filter(even), updates, ["delivery_id"], ["event_time"]).select(*fields)


@star("upsert_keys_dedup")
def upsert_keys_dedup(s):
    t = s.telemetry.select("vehicle_id", "timestamp", "event_id", "speed")
    repeated = t.unionAll(t.filter(F.col("event_id") % 3 == 0))
    facts = [("telemetry", joins.dedup(repeated, KEYS["telemetry"], ["event_id"]))]
    i = s.incidents.select("incident_id", "vehicle_id", "severity")
    facts.append(("incidents", joins.dedup(i.unionAll(i), KEYS["incidents"], ["vehicle_id"])))
    d = s.drivers.select("name", "status")
    facts.append(("whole_row", joins.dedup(d.unionAll(d), None, [])))
    return statistics.table_counts(dict(facts))


@query("append_counts")
def append_counts(spark, sf_dir):
    root = run_dir(spark, "append")
    written = []
    for entity in ("telemetry", "incidents"):
        df = load(spark, sf_dir, entity)
        first = F.col("timestamp") < warm_from()
        for part, rows in (("early", df.filter(first)), ("late", df.filter(~first))):
            written.append((entity, part, sinks.append_counted(rows, f"{root}/{entity}")))
    stored = statistics.table_counts({e: spark.read.parquet(f"{root}/{e}") for e in ("telemetry", "incidents")})
    counters = spark.createDataFrame(written, "entity string, part string, written bigint")
    return counters.join(stored.withColumnRenamed("rows", "stored"), "entity")


@star("kpi_snapshot")
def kpi_snapshot(s):
    return kpis.snapshot_kpis(kpis.kpi_fleet(s), AS_OF, 300)


@star("kpi_lookup")
def kpi_lookup(s):
    root = run_dir(s.spark, "snapshots")
    figures = kpis.kpi_sql(s)
    for as_of in ("2024-01-30 23:50:00", "2024-01-30 23:56:00", "2024-01-30 23:58:00"):
        kpis.snapshot_kpis(figures, as_of).write.mode("append").parquet(root)
    return kpis.get_kpi(s.spark.read.parquet(root), "total_deliveries", "2024-01-31 00:00:00")


def _staged(s: Star) -> DataFrame:
    frames = [staging.stage(getattr(s, e), e, KEYS[e], AS_OF, staging.DIMENSION_TTL) for e in DIMENSIONS]
    recent = envelopes.extract_recent(s.telemetry, timing.before(AS_OF, hours=24))
    facts = {"telemetry": recent, "deliveries": s.deliveries, "incidents": s.incidents}
    frames += [staging.stage(df, e, KEYS[e], AS_OF, staging.FACT_TTL) for e, df in facts.items()]
    return joins.union_all(frames)


@star("stage_records")
def stage_records(s):
    return _staged(s).select("entity", "key", "written_at", "expires_at")


@star("staged_read")
def staged_read(s):
    root = run_dir(s.spark, "staged")
    staging.write_staged(_staged(s), root)
    schema = "delivery_id long, vehicle_id long, status string, distance_km double, pickup_time string"
    return staging.get_staged(s.spark.read.parquet(root), "deliveries", "2024-01-31 00:10:00", schema)


@star("staging_clear")
def staging_clear(s):
    cached = kpis.kpi_sql(s).select(
        F.lit("kpi").alias("entity"), F.concat(F.lit("cache:kpi:"), "kpi").alias("key"), F.col("value").cast("string").alias("payload"),
        timing.at(AS_OF).alias("written_at"), timing.at(AS_OF).alias("expires_at"),
    )
    store = VersionedTable(s.spark, f"{run_dir(s.spark, 'staging')}/records")
    store.append(_staged(s).unionByName(cached), "stage")
    removed = staging.clear_stored(store, "clear-1", ("staging:",))
    again = staging.clear_stored(store, "clear-1", ("staging:",))
    total = removed.unionByName(again).groupBy("prefix").agg(F.sum("removed").alias("removed"))
    # What another reader of the store finds afterwards.
    left = VersionedTable(s.spark, store.root).read()
    rest = left.agg(F.count("*").alias("n")).select(F.lit("left").alias("prefix"), F.col("n").alias("removed"))
    return total.unionByName(rest)


@star("staging_counts")
def staging_counts(s):
    # Half an hour on, facts have expired and dimensions have not.
    return staging.staging_counts(_staged(s), list(ENTITIES), "2024-01-31 00:30:00")


@query("json_export")
def json_export(spark, sf_dir):
    root = run_dir(spark, "export")
    frames = []
    for e in DIMENSIONS:
        staging.export_json(load(spark, sf_dir, e), f"{root}/{e}")
        back = spark.read.schema("name string, make string").json(f"{root}/{e}")
        frames.append(
            back.agg(F.count("*").alias("rows"), F.count_distinct(F.coalesce("name", "make")).alias("labels"))
            .select(F.lit(e).alias("entity"), "rows", "labels")
        )
    return joins.union_all(frames)


@star("encode_envelope")
def encode_envelope(s):
    coded = envelopes.encode_envelope(s.incidents.drop("timestamp"), F.col("incident_id"), topic="incidents")
    data = F.from_json("value", "vehicle_id long, incident_type string, severity string, speed_at_incident double")
    return coded.select("topic", "key", data.alias("d")).select("topic", "key", "d.*")


@star("json_document")
def json_document(s):
    return staging.json_document(kpi_top(s, 10).select("rank", "name", "rating", "experience_years"))


# --- predicates and labels -----------------------------------------------------

@star("validate_telemetry")
def validate_telemetry(s):
    return checks.validate(s.telemetry, "telemetry").select(*TELEMETRY_ROW)


@star("validate_delivery")
def validate_delivery(s):
    return checks.validate(s.deliveries, "delivery").select("delivery_id", "vehicle_id", "status")


@star("validate_incident")
def validate_incident(s):
    return checks.validate(s.incidents, "incident").select("incident_id", "vehicle_id", "incident_type")


@star("anomaly_filter")
def anomaly_filter(s):
    return checks.anomaly_filter(s.telemetry).select(*TELEMETRY_ROW)


@star("anomaly_classify")
def anomaly_classify(s):
    return checks.anomalies(s.telemetry).select(*TELEMETRY_ROW, "anomaly_type")


@star("predicate_mix")
def predicate_mix(s):
    d = s.deliveries.filter(
        F.col("status").isin("InProgress", "Completed")
        & F.col("distance_km").between(5, 30)
        & (F.col("package_weight") > 0)
        & (F.col("warehouse_id") != 3)
        & (F.col("pickup_time") >= lookback())
    )
    return d.select("delivery_id", "status", "warehouse_id", "distance_km")


@star("experience_buckets")
def experience_buckets(s):
    years = F.col("experience_years")
    return s.drivers.select(
        "driver_id",
        labels.bucket(years, labels.EXPERIENCE_4).alias("four_levels"),
        labels.bucket(years, labels.EXPERIENCE_3).alias("three_levels"),
        labels.bucket(years, labels.EXPERIENCE_3_SHORT).alias("short_levels"),
    )


@star("capacity_class")
def capacity_class(s):
    return s.vehicles.select("vehicle_id", labels.bucket(F.col("capacity_kg"), labels.CAPACITY).alias("capacity_class"))


@star("motion_status")
def motion_status(s):
    speed = F.col("speed")
    return s.telemetry.select(
        "event_id", labels.motion_status(speed).alias("status"), labels.motion_status(speed, 10).alias("incident_status")
    )


@star("speed_band")
def speed_band(s):
    return s.telemetry.select("event_id", F.array_join(labels.speed_band(F.col("speed")), ", ").alias("candidates"))


@star("temp_zone")
def temp_zone(s):
    return s.telemetry.select("event_id", labels.temp_zone(F.col("engine_temp")).alias("zone"))


@star("road_type_map")
def road_type_map(s):
    return s.telemetry.select("event_id", "segment", labels.road_type(F.col("segment")).alias("mapped"))


@star("kpi_bands")
def kpi_bands(s):
    return kpis.kpi_bands(kpis.kpi_fleet(s))


@star("dashboard_feed")
def dashboard_feed(s):
    snapshot = kpis.snapshot_kpis(kpis.kpi_fleet(s), "2024-01-30 23:58:00")
    return kpis.dashboard_feed(snapshot, s.vehicles, AS_OF)


# --- joins ---------------------------------------------------------------------


@star("join_inner_star")
def join_inner_star(s):
    return (
        s.telemetry.select("event_id", "driver_id", "vehicle_id", "speed")
        .join(s.drivers.select("driver_id", "name"), "driver_id")
        .join(s.vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id")
        .select("event_id", "name", "vehicle_type", "speed")
    )


@star("join_star4")
def join_star4(s):
    return (
        s.deliveries.select("delivery_id", "warehouse_id", "customer_id", "vehicle_id")
        .join(s.warehouses.select("warehouse_id", F.col("city").alias("origin_city")), "warehouse_id")
        .join(s.customers.select("customer_id", "customer_type"), "customer_id")
        .join(s.vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id")
        .select("delivery_id", "origin_city", "customer_type", "vehicle_type")
    )


@star("join_left_dim")
def join_left_dim(s):
    return s.incidents.select("incident_id", "driver_id").join(
        s.drivers.select("driver_id", "name", "experience_years"), "driver_id", "left"
    )


star("join_vehicle_day")(reports.vehicle_day_join)
star("join_left_chain")(reports.origin_chain_join)


@star("join_interval")
def join_interval(s):
    return joins.interval_counts(s.telemetry, s.incidents, columns=["vehicle_id"])


QUERIES["stream_join_interval"] = jobs.interval_stream


@star("fk_orphans")
def fk_orphans(s):
    return quality.fk_orphans(views(s))


star("active_vehicles")(kpis.active_vehicles)
QUERIES["stream_enrich"] = jobs.enrich


# --- aggregates ------------------------------------------------------------------


@star("table_counts")
def table_counts(s):
    return statistics.table_counts(views(s))


star("filtered_counts")(kpis.filtered_counts)
star("global_averages")(kpis.global_averages)


@star("count_distincts")
def count_distincts(s):
    return s.telemetry.groupBy(labels.road_type(F.col("segment")).alias("road_type")).agg(
        F.count_distinct("vehicle_id").alias("vehicles"),
        F.count_distinct(F.to_date("timestamp")).alias("days"),
        F.count_distinct("speed").alias("speeds"),
    )


@star("distinct_estimates")
def distinct_estimates(s):
    """Distinct counts of three spans merged from stored daily sketches, beside the exact ones they must be near to."""
    columns, road = ["vehicle_id", "speed"], labels.road_type(F.col("segment")).alias("road_type")
    t = s.telemetry.withColumn("road_type", road)
    path = run_dir(s.spark, "sketches")
    statistics.daily_sketches(t, columns, ["road_type"]).write.parquet(path)
    out = []
    for first, last in (("2024-01-01", "2024-01-07"), ("2024-01-05", "2024-01-20"), ("2024-01-01", "2024-01-31")):
        near = statistics.distinct_over(s.spark.read.parquet(path), columns, ["road_type"], first, last)
        days = t.filter((F.col("timestamp") >= F.lit(first).cast("timestamp")) & (F.to_date("timestamp") <= F.lit(last).cast("date")))
        exact = days.groupBy("road_type").agg(*[F.count_distinct(c).alias(f"{c}_exact") for c in columns])
        close = [(F.abs(F.col(c) - F.col(f"{c}_exact")) <= 0.04 * F.col(f"{c}_exact")).alias(f"{c}_near") for c in columns]
        out.append(near.join(exact, "road_type").select("road_type", F.lit(first).alias("first_day"), F.col("vehicle_id_exact").alias("vehicles"),
                                                        F.col("speed_exact").alias("speeds"), *close))
    return joins.union_all(out)


@star("counts_by_category")
def counts_by_category(s):
    out = joins.union_all(
        [
            statistics.counts_by(s.vehicles, "vehicle_type", "vehicles"),
            statistics.counts_by(s.drivers, "status", "drivers"),
            statistics.counts_by(s.customers, "customer_type", "customers"),
        ]
    )
    return out.orderBy("entity", F.desc("rows"), "category")


@star("minute_series_speed")
def minute_series_speed(s):
    out = rollups.minute_series(s.telemetry, "speed", timing.before(AS_OF, hours=24))
    return out.withColumn("avg_speed", F.round("avg_speed", 4))


@star("minute_series_fuel")
def minute_series_fuel(s):
    out = rollups.minute_series(s.telemetry, "fuel_level", timing.before(AS_OF, hours=24))
    return out.withColumn("avg_fuel_level", F.round("avg_fuel_level", 4))


@star("fleet_avg_minutely")
def fleet_avg_minutely(s):
    means = rollups.mean_of_minutes(s.telemetry, ["speed", "fuel_level"], AS_OF)
    return means.select(*[F.round(c, 1).alias(c) for c in means.columns])


@star("recent_rollup")
def recent_rollup(s):
    return rollups.recent_rollup(s.telemetry, AS_OF, 60)


@star("dup_keys")
def dup_keys(s):
    return statistics.duplicate_keys(s.telemetry, ["vehicle_id", "fuel_level"])


@star("speed_profile_stats")
def speed_profile_stats(s):
    return statistics.profile_stats(s.telemetry, "vehicle_id", "speed")


@star("normality_check")
def normality_check(s):
    return statistics.normality_check(s.telemetry, "vehicle_id", "speed")


@star("incident_dispersion")
def incident_dispersion(s):
    return statistics.incident_dispersion(s.incidents, keys=s.vehicles)


@star("state_share")
def state_share(s):
    return statistics.state_share(s.telemetry, "segment", "vehicle_id")


@query("table_stats")
def table_stats(spark, sf_dir):
    stored = {"vehicles": "part", "drivers": "supplier", "customers": "customer", "telemetry": "events", "deliveries": "orders"}
    return statistics.table_stats({e: read_table(spark, sf_dir, t) for e, t in stored.items()})


@query("table_stats_rows")
def table_stats_rows(spark, sf_dir):
    return table_stats(spark, sf_dir).select("entity", "rows")


# --- ordered rows ----------------------------------------------------------------

star("route_distance")(lambda s: ordered.route_distance(s.telemetry))
star("ar1_check")(lambda s: ordered.ar1_check(s.telemetry))
star("ar1_residual")(lambda s: ordered.ar1_residual(s.telemetry))
star("speed_jump")(lambda s: ordered.speed_jump(s.telemetry))
star("ts_monotonic")(lambda s: ordered.ts_monotonic(s.telemetry))
star("fuel_monotonic")(lambda s: ordered.fuel_monotonic(s.telemetry))


@star("transition_matrix")
def transition_matrix(s):
    return ordered.transition_matrix(s.telemetry, "segment", models.route_moves())


@star("latest_per_key")
def latest_per_key(s):
    columns = ["event_id", "timestamp", "speed", "fuel_level"]
    return ordered.latest_per_key(s.telemetry, "vehicle_id", ["timestamp", "event_id"], columns)


# --- top rows ----------------------------------------------------------------------


def kpi_top(s: Star, n: int) -> DataFrame:
    """Best rated drivers with their rank; the window runs over n rows."""
    order = [F.desc_nulls_last("rating"), F.asc("driver_id")]
    top = s.drivers.select("driver_id", "name", "rating", "experience_years").orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.partitionBy().orderBy(*order)))


@star("driver_rank")
def driver_rank(s):
    return kpi_top(s, 10).select("rank", "driver_id", "name", "rating")


@star("top_drivers")
def top_drivers(s):
    order = [F.desc_nulls_last("rating"), F.asc("driver_id")]
    return s.drivers.select("driver_id", "name", "rating", "experience_years").orderBy(*order).limit(10)


@star("recent_incidents")
def recent_incidents(s):
    newest = s.incidents.orderBy(F.desc_nulls_last("timestamp"), F.desc("incident_id")).limit(10)
    return newest.select("incident_id", "vehicle_id", "driver_id", "incident_type", "severity", "timestamp")


@star("latest_telemetry")
def latest_telemetry(s):
    newest = s.telemetry.orderBy(F.desc_nulls_last("timestamp"), F.desc("event_id")).limit(5)
    return newest.select(*TELEMETRY_ROW)


@star("latest_deliveries")
def latest_deliveries(s):
    newest = s.deliveries.orderBy(F.desc_nulls_last("pickup_time"), F.desc("delivery_id")).limit(5)
    return newest.select("delivery_id", "vehicle_id", "status", "pickup_time")


@star("latest_aggregations")
def latest_aggregations(s):
    # The last reading lies in five windows, so the five latest rows need nothing before the first of them.
    newest = s.telemetry.agg(F.date_trunc("minute", F.max("timestamp")).alias("t")).scalar()
    windows = rollups.sliding_rollup(s.telemetry.filter(F.col("timestamp") >= newest - F.expr("INTERVAL 4 MINUTES")))
    return windows.orderBy(F.desc("window_start"), F.asc_nulls_last("vehicle_id")).limit(5)


# --- scalars -------------------------------------------------------------------------


@star("scalar_time")
def scalar_time(s):
    ts, text = F.col("timestamp"), timing.iso_text(F.col("timestamp"))
    broken = F.when(F.col("event_id") % 7 == 0, "garbage").otherwise(F.concat(text, F.lit("Z")))
    return s.telemetry.select(
        "event_id",
        timing.parse_ts(broken).alias("parsed"),
        timing.parse_or(broken, timing.at(AS_OF)).alias("repaired"),
        timing.parse_ts(broken).isNull().alias("ts_repaired"),
        text.alias("iso"),
        F.to_date(ts).alias("day"),
        timing.minute_text(ts).alias("minute"),
        timing.clock_text(ts).alias("clock"),
        F.substring(text, 1, 8).alias("clock_fallback"),
        timing.minutes_between(ts, timing.at(AS_OF)).alias("minutes_to_end"),
    )


@star("scalar_text")
def scalar_text(s):
    return s.incidents.select(
        "incident_id",
        labels.title_text(F.col("incident_type")).alias("title"),
        labels.capital_text(F.col("severity")).alias("capital"),
        labels.title_text(F.when(F.col("incident_id") % 2 == 0, F.col("incident_type"))).alias("or_na"),
        F.lower("severity").alias("lower"),
        labels.padded_id("VEH-", F.col("vehicle_id"), 5).alias("vehicle"),
        labels.padded_id("INC-", F.col("incident_id"), 8).alias("incident"),
        F.substring("incident_type", 1, 200).alias("preview"),
    )


@star("scalar_math")
def scalar_math(s):
    speed, fuel = F.col("speed"), F.col("fuel_level")
    km = geo.haversine_km(F.lit(24.8607), F.lit(67.0011), F.col("latitude"), F.col("longitude"))
    return s.telemetry.select(
        "event_id",
        F.round(speed, 1).alias("r1"),
        F.round(speed, 0).alias("r0"),
        F.round(numeric.ratio(speed, fuel, 100.0), 6).alias("guarded"),
        F.round(speed / F.nullif(fuel, F.lit(0.0)), 6).alias("null_if_zero"),
        numeric.clip(speed, 10, 140).alias("clipped"),
        F.signum(speed - 50).alias("side"),
        F.round(F.abs(speed - 50), 6).alias("distance_from_50"),
        F.round(F.pow(speed - 50, F.lit(2)), 6).alias("squared"),
        F.round(km, 6).alias("km"),
        F.round(numeric.gaussian_pdf(speed, F.lit(50.0), F.lit(15.0)), 6).alias("density"),
        F.coalesce(F.when(fuel > 50, fuel), F.lit(0.0)).alias("defaulted"),
    )


# --- windows --------------------------------------------------------------------------


@star("sliding_rollup")
def sliding_rollup(s):
    return rollups.sliding_rollup(s.telemetry)


@star("tumbling_rollup")
def tumbling_rollup(s):
    return rollups.sliding_rollup(s.telemetry, slide=None)


QUERIES["stream_late_data"] = jobs.late_data
QUERIES["stream_append_vs_update"] = jobs.append_vs_update
QUERIES["stream_anomalies"] = jobs.stream_anomalies
QUERIES["stream_multi"] = jobs.several_outputs
QUERIES["stream_pipeline"] = jobs.complete_pipeline
QUERIES["stream_dedup"] = jobs.dedup_stream
QUERIES["stream_progress"] = jobs.progress


@star("freshness_check")
def freshness_check(s):
    recent = F.count_if(F.col("timestamp") >= timing.before("2024-01-30 23:58:00", minutes=5))
    return s.telemetry.agg(
        F.max("timestamp").alias("newest"), recent.alias("recent_rows"), (recent > 0).alias("passed")
    )


# --- quality ----------------------------------------------------------------------------

UNIQUE = {
    "vehicles": ["vehicle_id"],
    "drivers": ["driver_id", "license_number"],
    "warehouses": ["warehouse_id"],
    "customers": ["customer_id"],
    "deliveries": ["delivery_id"],
    "incidents": ["incident_id"],
}
# Published size of each dimension.
EXPECTED_ROWS = {"vehicles": 500, "drivers": 350, "warehouses": 20, "customers": 10000}

star("dq_nulls")(lambda s: quality.dq_nulls(views(s)))
star("dq_missing")(lambda s: quality.dq_missing(views(s)))
star("dq_outliers")(lambda s: quality.dq_outliers(views(s)))
star("dq_ranges")(lambda s: quality.dq_ranges(views(s)))
# Of every fiftieth document the value of one path is replaced by one of another type.
PLANTED = {
    "vehicles": ("vehicle_id", "year", '"new"'), "drivers": ("driver_id", "rating", "true"),
    "warehouses": ("warehouse_id", "location", '"here"'), "customers": ("customer_id", "name", "7"),
    "telemetry": ("event_id", "speed", '"fast"'), "deliveries": ("delivery_id", "driver_id", "12"),
    "incidents": ("incident_id", "timestamp", '"soon"'),
}


def _raw_documents(s: Star) -> DataFrame:
    """The tables as JSON documents with text ids, some with a value of the wrong type, some cut off."""
    out = []
    for entity, (key, path, wrong) in PLANTED.items():
        df = envelopes.extract_dimension(getattr(s, entity))
        names = {p.name.split(".")[0] for p in typed.DOCUMENTS[entity]} & set(df.columns)
        fields = [F.col(c).cast("string").alias(c) if c.endswith("_id") else F.col(c) for c in sorted(names)]
        value = F.to_json(F.struct(*fields))
        hurt = F.regexp_replace(value, f'"{path}":(\\{{[^}}]*\\}}|"[^"]*"|[^,}}]*)', f'"{path}":{wrong}')
        value = F.when(F.col(key) % 50 == 3, hurt).otherwise(value)
        value = F.when(F.col(key) % 70 == 9, F.substring(value, 1, 12)).otherwise(value)
        out.append(df.select(F.lit(entity).alias("entity"), value.alias("value")))
    return joins.union_all(out)


star("dq_raw_rules")(lambda s: typed.rule_counts(typed.tagged(_raw_documents(s))))


@star("dq_quarantine")
def dq_quarantine(s):
    """Documents per entity that passed, and that the stored quarantine holds after a run that was repeated."""
    root = run_dir(s.spark, "quarantine")
    tagged = typed.tagged(_raw_documents(s))
    tagged.write.parquet(f"{root}/tagged")  # both runs read the tags, the rules are checked once
    checked = s.spark.read.schema(tagged.schema).parquet(f"{root}/tagged")
    table = VersionedTable(s.spark, f"{root}/documents")
    for _ in range(2):
        passed = typed.quarantine(checked, table, "2024-01-31")
    held = table.read().groupBy("entity").agg(F.count("*").alias("quarantined"))
    left = passed.groupBy("entity").agg(F.count("*").alias("passed"))
    counts = left.join(held, "entity", "full")
    return counts.select("entity", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("passed", "quarantined")])


star("dq_schema_rules")(lambda s: quality.dq_schema_rules(views(s)))
star("dq_duplicates")(lambda s: quality.dq_duplicates(views(s), UNIQUE))
star("dq_foreign_keys")(lambda s: quality.dq_foreign_keys(views(s)))


@star("dq_expected_counts")
def dq_expected_counts(s):
    return quality.expected_counts(statistics.table_counts(views(s, DIMENSIONS)), EXPECTED_ROWS)


@star("dq_summary")
def dq_summary(s):
    t = views(s)
    report = joins.union_all(
        [quality.dq_nulls(t), quality.dq_outliers(t), quality.dq_duplicates(t, {"vehicles": ["vehicle_id"]})]
    )
    return quality.dq_summary(report, statistics.table_counts(t), timing.at(AS_OF))


@star("dq_history")
def dq_history(s):
    """The stored lines of two runs, of which the first ran twice."""
    t = views(s)
    report = quality.dq_nulls(t)
    counts = statistics.table_counts(t)
    history = VersionedTable(s.spark, f"{run_dir(s.spark, 'dq-history')}/runs")
    for as_of in ("2024-01-30 00:00:00", "2024-01-30 00:00:00", "2024-01-31 00:00:00"):
        quality.record_run(history, quality.dq_summary(report, counts, timing.at(as_of)), as_of)
    return VersionedTable(s.spark, history.root).read()


@star("dq_expect")
def dq_expect(s):
    rules = [quality.required("vehicle_id"), quality.within("speed", 0, 120), quality.within("fuel_level", 5, 95)]
    checked = quality.expect(s.telemetry, rules)
    return checked.select("event_id", F.array_join("broken_rules", ",").alias("broken_rules"))


# --- KPIs ---------------------------------------------------------------------------------

star("kpi_fleet")(kpis.kpi_fleet)
star("kpi_realtime")(lambda s: kpis.kpi_realtime(s, "2024-01-30 23:58:00"))
star("kpi_sql")(kpis.kpi_sql)
star("kpi_severity_score")(kpis.severity_score_kpi)
star("kpi_on_time")(kpis.on_time_kpi)
star("kpi_delivery_variance")(kpis.delivery_variance_kpi)
star("kpi_distance")(kpis.distance_kpi)
star("kpi_fuel")(kpis.fuel_kpi)
star("kpi_incident_rate")(kpis.incident_rate_kpi)
star("kpi_utilization_time")(kpis.utilization_time_kpi)
star("kpi_driver_score")(kpis.driver_score_kpi)
star("kpi_maintenance_age")(lambda s: kpis.maintenance_age_kpi(s, AS_OF))


# --- reports ---------------------------------------------------------------------------------

star("showcase_q1")(lambda s: reports.driver_performance(s, lookback(), 5, 30))
star("showcase_q2")(lambda s: reports.route_efficiency(s, lookback()))
star("showcase_q3")(lambda s: reports.incident_analysis(s, lookback()))
star("showcase_q4")(lambda s: reports.delivery_spread(s, lookback(), 2))
star("showcase_q5")(lambda s: reports.fuel_pattern(s, lookback(), 5, 10, 1))
star("showcase_q1_all")(reports.driver_performance_all)
star("showcase_q2_all")(reports.route_efficiency_all)
star("showcase_q3_all")(reports.incident_analysis_all)
star("doc_q1")(lambda s: reports.drivers_with_incidents(s, lookback(), 30, 30))
star("doc_q2")(lambda s: reports.city_routes(s, lookback()))
star("doc_q3")(lambda s: reports.incidents_by_severity(s, lookback()))
star("doc_q4")(lambda s: reports.low_fuel_by_road(s, lookback(), 55))
star("doc_q5")(lambda s: reports.delivery_by_experience(s, lookback()))

# The same reports at their published limits and spans; on small tables some of them find nothing.
PUBLISHED = {
    "showcase_q1": lambda s: reports.driver_performance(s, reports.last_hours(AS_OF, 24)),
    "showcase_q2": lambda s: reports.route_efficiency(s, reports.last_days(AS_OF, 7)),
    "showcase_q3": lambda s: reports.incident_analysis(s, reports.last_days(AS_OF, 30)),
    "showcase_q4": lambda s: reports.delivery_spread(s, reports.last_days(AS_OF, 14)),
    "showcase_q5": lambda s: reports.fuel_pattern(s, reports.last_days(AS_OF, 7)),
    "doc_q1": lambda s: reports.drivers_with_incidents(s, reports.last_hours(AS_OF, 24)),
    "doc_q2": lambda s: reports.city_routes(s, reports.last_days(AS_OF, 7)),
    "doc_q3": lambda s: reports.incidents_by_severity(s, reports.last_days(AS_OF, 30)),
    "doc_q4": lambda s: reports.low_fuel_by_road(s, reports.last_hours(AS_OF, 24)),
    "doc_q5": lambda s: reports.delivery_by_experience(s, reports.last_days(AS_OF, 30)),
}
for _name, _report in PUBLISHED.items():
    star(f"{_name}_published")(_report)
star("incidents_formatted")(reports.incidents_formatted)


# --- models -------------------------------------------------------------------------------------


@star("risk_rate")
def risk_rate(s):
    return models.with_risk(conditions(s.telemetry), s.drivers).select(
        "event_id", "experience", "weather", "traffic", "time_of_day", "behaviour", "rate"
    )


@star("risk_expected")
def risk_expected(s):
    return models.risk_expected(conditions(s.telemetry), s.drivers, s.incidents)


star("speed_zscore")(lambda s: models.speed_zscore(conditions(s.telemetry)))


@star("time_of_day")
def time_of_day(s):
    return s.telemetry.select("event_id", timing.time_of_day(F.col("timestamp")).alias("time_of_day"))


@star("fuel_rate")
def fuel_rate(s):
    rpm = models.rpm_from_speed(F.col("speed"))
    litres = models.fuel_rate(F.col("speed"), rpm, F.col("throttle"), F.col("engine_temp"))
    return with_throttle(s.telemetry).select("event_id", rpm.alias("rpm"), litres.alias("litres_per_hour"))


def _driver_states(s):
    return models.driver_state(observed_drivers(s.telemetry))


@star("driver_state")
def driver_state(s):
    return _driver_states(s).select("event_id", "p_normal", "p_aggressive", "p_tired", "state")


@star("driver_transitions")
def driver_transitions(s):
    """Changes of the inferred state from reading to reading of a driver, beside the configured ones."""
    states = _driver_states(s).filter(F.col("state").isNotNull())
    return ordered.transition_matrix(states, "state", models.pairs_of(models.DRIVER_MOVES), key="driver_id")


star("hourly_aggregations")(lambda s: ordered.hourly_aggregations(s.telemetry, s.incidents))


def queries() -> dict[str, Query]:
    return dict(QUERIES)
