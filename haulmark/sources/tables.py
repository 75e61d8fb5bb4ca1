"""Parquet tables and the star views built on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulmark.functions.timing import time_of_day
from haulmark.schemas import ENTITIES

EPOCH = "2024-01-01 00:00:00"
AS_OF = "2024-01-31 00:00:00"


_SCHEMAS: dict[str, T.StructType] = {}


def table_schema(spark: SparkSession, path: str) -> T.StructType:
    """Stored schema with zone-less timestamps read as TIMESTAMP, looked up once per path.

    Declaring the type on the reader, instead of casting after it, keeps time
    filters in the Parquet scan and lets streams set a watermark on the column.
    """
    if path not in _SCHEMAS:
        _SCHEMAS[path] = _with_zoned_times(spark.read.parquet(path).schema)
    return _SCHEMAS[path]


def _with_zoned_times(stored: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(
                f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType, f.nullable
            )
            for f in stored
        ]
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(table_schema(spark, path)).parquet(path)


# Views as SQL expressions over the stored columns.
PROPS_NUMBER = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT)"
SEGMENT = f"element_at(array('warehouse', 'highway', 'urban', 'customer'), {PROPS_NUMBER} % 4 + 1)"
PICKUP = f"timestampadd(MINUTE, o_orderkey * 37 % 43200, TIMESTAMP '{EPOCH}')"
# Drivers change between readings of a vehicle; some keys and measures are missing.
DRIVER = "CASE WHEN event_id % 499 <> 7 THEN user_id + event_id % 2 + 1 END"
SPEED = "CASE WHEN event_id % 211 = 5 THEN 0D WHEN event_id % 307 <> 11 THEN value END"

VEHICLES = (
    "p_partkey AS vehicle_id",
    "p_type AS vehicle_type",
    "p_brand AS make",
    "p_name AS model",
    "p_size % 16 + 2010 AS year",
    "p_size * 100 AS capacity_kg",
    "p_size * 4 AS fuel_capacity",
    "CASE WHEN p_partkey % 20 < 17 THEN 'Active' WHEN p_partkey % 20 < 19 THEN 'Maintenance' ELSE 'Retired' END AS status",
    f"date_sub(TIMESTAMP '{EPOCH}', CAST(p_partkey % 180 AS INT)) AS last_maintenance",
)
DRIVERS = (
    "s_suppkey AS driver_id",
    "s_name AS name",
    "concat('LIC-', s_suppkey) AS license_number",
    "CAST(s_suppkey % 25 + 1 AS INT) AS experience_years",
    "s_suppkey % 21 / 10D + 3D AS rating",
    "element_at(array('OnRoute', 'Available', 'OnBreak', 'OffDuty'), CAST(s_suppkey % 4 + 1 AS INT)) AS status",
)
LOCATION = (
    "named_struct('latitude', CAST({key} % 20 + 22 AS DOUBLE), 'longitude', CAST({key} % 25 + 58 AS DOUBLE)) AS location"
)
WAREHOUSES = (
    "n_nationkey AS warehouse_id",
    "n_name AS name",
    "r_name AS city",
    LOCATION.format(key="n_nationkey"),
    "(n_nationkey + 1) * 1000 AS capacity_sqft",
)
CUSTOMERS = (
    "c_custkey AS customer_id",
    "c_name AS name",
    "n_name AS city",
    "CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Wholesale' "
    "WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Individual' ELSE 'Retail' END AS customer_type",
    LOCATION.format(key="c_custkey"),
)
TELEMETRY = (
    "event_id",
    "CASE WHEN event_id % 997 <> 3 THEN user_id END AS vehicle_id",
    f"{DRIVER} AS driver_id",
    "ts AS timestamp",
    "event_id % 1000 / 1000D + 24.8607D AS latitude",
    "event_id * 7 % 1000 / 1000D + 67.0011D AS longitude",
    f"{SPEED} AS speed",
    f"CASE WHEN event_id % 401 <> 13 THEN CAST({PROPS_NUMBER} AS DOUBLE) END AS fuel_level",
    "CAST(event_id % 100 + 30 AS DOUBLE) AS engine_temp",
    "CAST(event_id % 5000 AS INT) AS rpm",
    "event_id * 0.5D + 1000D AS odometer",
    f"CASE WHEN {SPEED} > 5 THEN 'Moving' ELSE 'Idle' END AS status",
    f"{SEGMENT} AS segment",
    f"CASE {SEGMENT} WHEN 'highway' THEN 'highway' ELSE 'urban' END AS road_type",
)
DELIVERIES = (
    "o_orderkey AS delivery_id",
    "o_custkey AS vehicle_id",
    "o_orderkey % 120 AS driver_id",
    "CAST(o_orderkey % 25 AS INT) AS warehouse_id",
    "o_custkey + 1 AS customer_id",
    "CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'InProgress' ELSE 'Cancelled' END AS status",
    f"{PICKUP} AS pickup_time",
    f"timestampadd(MINUTE, o_custkey % 91 + 30, {PICKUP}) AS estimated_delivery",
    f"CASE WHEN o_orderstatus = 'F' THEN timestampadd(MINUTE, o_orderkey % 121 + 20, {PICKUP}) END AS completion_time",
    "CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 121 + 20 AS INT) END AS delivery_minutes",
    "CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 121 + 20 <= o_custkey % 91 + 30 END AS on_time",
    "o_totalprice / 10000D AS distance_km",
    "o_totalprice / 5000D AS package_weight",
)
INCIDENTS = (
    "event_id AS incident_id",
    "user_id AS vehicle_id",
    f"{DRIVER} AS driver_id",
    "ts AS timestamp",
    "element_at(array('harsh_braking', 'speeding', 'harsh_acceleration', 'sharp_turn', 'idling_excessive'), "
    f"{PROPS_NUMBER} % 5 + 1) AS incident_type",
    f"element_at(array('Low', 'Medium', 'High', 'low', 'medium', 'high'), {PROPS_NUMBER} % 6 + 1) AS severity",
    "value AS speed_at_incident",
)


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").selectExpr(*VEHICLES)


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "supplier").selectExpr(*DRIVERS)


def warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = read_table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return read_table(spark, sf_dir, "nation").join(region, "n_regionkey").selectExpr(*WAREHOUSES)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    return read_table(spark, sf_dir, "customer").join(nation, "c_nationkey").selectExpr(*CUSTOMERS)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").selectExpr(*TELEMETRY)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").selectExpr(*DELIVERIES)


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").filter("event_type = 'error'").selectExpr(*INCIDENTS)


VIEWS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "vehicles": vehicles,
    "drivers": drivers,
    "warehouses": warehouses,
    "customers": customers,
    "telemetry": telemetry,
    "deliveries": deliveries,
    "incidents": incidents,
}

# Names under which SQL texts refer to the views.
SQL_NAMES = {
    "vehicles": ("vehicles", "dim_vehicles"),
    "drivers": ("drivers", "dim_drivers"),
    "warehouses": ("warehouses", "dim_warehouses"),
    "customers": ("customers", "dim_customers"),
    "telemetry": ("telemetry", "telemetry_events"),
    "deliveries": ("deliveries",),
    "incidents": ("incidents",),
}


def load(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """One star view."""
    return VIEWS[entity](spark, sf_dir)


def register_views(spark: SparkSession, sf_dir: str) -> None:
    for entity in ENTITIES:
        df = load(spark, sf_dir, entity)
        for name in SQL_NAMES[entity]:
            df.createOrReplaceTempView(name)


class Star:
    """The star views of one data folder, read on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._loaded: dict[str, DataFrame] = {}

    def __getattr__(self, entity: str) -> DataFrame:
        if entity not in VIEWS:
            raise AttributeError(entity)
        if entity not in self._loaded:
            self._loaded[entity] = load(self.spark, self.sf_dir, entity)
        return self._loaded[entity]


def conditions(readings: DataFrame) -> DataFrame:
    """Readings with weather, traffic, behaviour and time class. The given tables have no such sensors; fuel and event number stand in."""
    pick = lambda c, names: F.element_at(F.array(*[F.lit(x) for x in names]), (c % len(names) + 1).cast("int"))
    fuel, event = F.col("fuel_level").cast("int"), F.col("event_id")
    return readings.withColumns(
        {
            "weather": F.when(fuel.isNotNull(), pick(fuel, ["clear", "rain", "fog", "dust", "snow"])),
            "traffic": pick(event, ["light", "moderate", "heavy", "congested"]),
            "behaviour": F.when(F.col("speed") > 100, "aggressive").when(F.col("speed") < 20, "cautious").otherwise("normal"),
            "time_of_day": time_of_day(F.col("timestamp")),
        }
    )


def observed_drivers(readings: DataFrame) -> DataFrame:
    """Speed deviation and reaction time of drivers. The given tables have neither; speed and fuel stand in."""
    return readings.select(
        "event_id", "driver_id", "timestamp",
        (F.col("speed") - 50.0).alias("speed_deviation"),
        (F.col("fuel_level") * 12 + 300.0).alias("reaction_time_ms"),
    )


def with_throttle(readings: DataFrame) -> DataFrame:
    """Readings with a throttle position, for which the fuel level stands in."""
    return readings.withColumn("throttle", F.least(F.lit(100.0), F.col("fuel_level")))
