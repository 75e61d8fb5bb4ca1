"""One fixed schema per message and table, shared by batch and stream."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TEXT, REAL = T.StringType(), T.DoubleType()
LOCATION = _struct(latitude=REAL, longitude=REAL)

# Messages. Numbers that producers may send as 3.0 are read as double, times as text.
MESSAGES = {
    "telemetry": _struct(
        vehicle_id=TEXT,
        timestamp=TEXT,
        latitude=REAL,
        longitude=REAL,
        speed=REAL,
        fuel_level=REAL,
        engine_temp=REAL,
        rpm=REAL,
        odometer=REAL,
        driver_id=TEXT,
        status=TEXT,
    ),
    # One schema for the first message of a delivery and the one that completes it.
    "delivery": _struct(
        delivery_id=TEXT,
        vehicle_id=TEXT,
        driver_id=TEXT,
        warehouse_id=TEXT,
        customer_id=TEXT,
        status=TEXT,
        scheduled_time=TEXT,
        actual_time=TEXT,
        pickup_time=TEXT,
        estimated_delivery=TEXT,
        pickup_location=LOCATION,
        delivery_location=LOCATION,
        distance_km=REAL,
        package_weight=REAL,
        completion_time=TEXT,
        duration_minutes=REAL,
    ),
    "incident": _struct(
        incident_id=TEXT,
        vehicle_id=TEXT,
        driver_id=TEXT,
        incident_type=TEXT,
        severity=TEXT,
        latitude=REAL,
        longitude=REAL,
        speed_at_incident=REAL,
        timestamp=TEXT,
    ),
}

TOPICS = {"vehicle-telemetry": "telemetry", "deliveries": "delivery", "incidents": "incident"}

# Key columns of every table; tables without a key compare whole rows.
KEYS = {
    "vehicles": ["vehicle_id"],
    "drivers": ["driver_id"],
    "warehouses": ["warehouse_id"],
    "customers": ["customer_id"],
    "telemetry": ["vehicle_id", "timestamp"],
    "deliveries": ["delivery_id"],
    "incidents": ["incident_id"],
}

ENTITIES = tuple(KEYS)
DIMENSIONS = ("vehicles", "drivers", "warehouses", "customers")
FACTS = ("telemetry", "deliveries", "incidents")


def schema_for(entity: str) -> T.StructType:
    return MESSAGES[entity]
