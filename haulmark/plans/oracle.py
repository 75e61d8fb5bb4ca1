"""DuckDB twins of the named queries, used to check results.

Sums of measures go through DECIMAL and rounding through the decimal text of a
double, which is what Spark's ROUND does, so both engines give equal digits.
"""

from __future__ import annotations

# Fixed values, written out here again so that a slip on one side shows.
FOREIGN_KEYS = (
    ("telemetry", "vehicle_id", "vehicles"),
    ("telemetry", "driver_id", "drivers"),
    ("deliveries", "vehicle_id", "vehicles"),
    ("deliveries", "driver_id", "drivers"),
    ("deliveries", "warehouse_id", "warehouses"),
    ("deliveries", "customer_id", "customers"),
    ("incidents", "vehicle_id", "vehicles"),
    ("incidents", "driver_id", "drivers"),
)
KPI_BANDS = (
    ("total_vehicles", None, "green"),
    ("total_vehicles", 100.0, "#EAB839"),
    ("total_vehicles", 400.0, "green"),
    ("avg_speed_kmh", None, "red"),
    ("avg_speed_kmh", 10.0, "orange"),
    ("avg_speed_kmh", 30.0, "yellow"),
    ("avg_speed_kmh", 50.0, "green"),
    ("drivers_on_route", None, "#EAB839"),
    ("drivers_on_route", 20.0, "yellow"),
    ("drivers_on_route", 50.0, "green"),
    ("total_incidents", None, "green"),
    ("total_incidents", 10.0, "yellow"),
    ("total_incidents", 50.0, "red"),
    ("avg_fuel_level_percent", None, "red"),
    ("avg_fuel_level_percent", 30.0, "yellow"),
    ("avg_fuel_level_percent", 60.0, "green"),
    ("delivery_success_rate_percent", None, "red"),
    ("delivery_success_rate_percent", 50.0, "orange"),
    ("delivery_success_rate_percent", 80.0, "yellow"),
    ("delivery_success_rate_percent", 95.0, "green"),
    ("avg_driver_rating", None, "red"),
    ("avg_driver_rating", 3.0, "yellow"),
    ("avg_driver_rating", 4.0, "green"),
    ("total_deliveries", None, "blue"),
)
PANELS = (
    (1, "Total Vehicles", "total_vehicles"),
    (2, "Average Speed", "avg_speed_kmh"),
    (3, "Drivers On Route", "drivers_on_route"),
    (4, "Total Incidents", "total_incidents"),
    (5, "Average Fuel Level", "avg_fuel_level_percent"),
    (6, "Delivery Success Rate", "delivery_success_rate_percent"),
    (7, "Average Driver Rating", "avg_driver_rating"),
    (8, "Total Deliveries", "total_deliveries"),
    (9, "Vehicles by Type", "vehicles_by_type"),
    (10, "Fleet Utilization", "fleet_utilization_percent"),
)
SCORE_WEIGHTS = {
    "rating": 0.5,
    "incident_rate": -0.3,
    "over_speed": -0.2,
}
RISK = {
    "experience": {"Novice": 3.0, "Intermediate": 1.5, "Expert": 1.0, "Master": 0.6},
    "weather": {"clear": 1.0, "rain": 2.0, "fog": 2.5, "dust": 1.8},
    "traffic": {"light": 0.8, "moderate": 1.0, "heavy": 1.7, "congested": 2.2},
    "time_of_day": {"morning_rush": 1.5, "midday": 1.0, "evening_rush": 1.6, "night": 1.3},
    "behaviour": {"aggressive": 2.5, "cautious": 0.7},
}
SPEED_MEAN = {
    "highway": 90.0,
    "urban": 45.0,
    "rural": 70.0,
}
SPEED_STD = {
    "highway": 15.0,
    "urban": 10.0,
    "rural": 12.0,
}
SPEED_TIME = {
    "morning_rush": 0.7,
    "midday": 1.0,
    "evening_rush": 0.65,
    "night": 1.1,
}
SPEED_WEATHER = {
    "clear": 1.0,
    "rain": 0.8,
    "fog": 0.6,
    "dust": 0.7,
}
SPEED_DRIVER = {
    "cautious": 0.85,
    "normal": 1.0,
    "aggressive": 1.25,
}
DRIVER_STATES = {
    "normal": ((0.0, 5.0), (700.0, 100.0)),
    "aggressive": ((15.0, 8.0), (500.0, 80.0)),
    "tired": ((-5.0, 5.0), (1200.0, 200.0)),
}
ROUTE_MOVES = {
    "warehouse": {"warehouse": 0.0, "highway": 0.7, "urban": 0.2, "customer": 0.1},
    "highway": {"warehouse": 0.0, "highway": 0.6, "urban": 0.3, "customer": 0.1},
    "urban": {"warehouse": 0.0, "highway": 0.2, "urban": 0.6, "customer": 0.2},
    "customer": {"warehouse": 0.5, "highway": 0.3, "urban": 0.2, "customer": 0.0},
}

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
HOT = "TIMESTAMP '2024-01-29 00:00:00'"
WARM = "TIMESTAMP '2024-01-21 00:00:00'"
LOOKBACK = "TIMESTAMP '2024-01-11 00:00:00'"
DAY = "TIMESTAMP '2024-01-30 00:00:00'"


def rnd(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST(CAST(CAST({x} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def dsum(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(38,10))) AS DOUBLE)"


def davg(x: str) -> str:
    return f"({dsum(x)} / NULLIF(COUNT({x}), 0))"


def case_of(column: str, table: dict, default: str) -> str:
    lines = " ".join(
        f"WHEN '{k}' THEN " + (f"'{v}'" if isinstance(v, str) else f"CAST({v} AS DOUBLE)") for k, v in table.items()
    )
    return f"(CASE {column} {lines} ELSE {default} END)"


def levels(x: str, *pairs) -> str:
    out = "CASE "
    for limit, label in pairs:
        out += f"WHEN {x} < {limit} THEN '{label}' " if limit is not None else f"ELSE '{label}' END"
    return f"({out})"


EXP4 = ((5, "Novice (0-5 years)"), (10, "Intermediate (5-10 years)"), (15, "Experienced (10-15 years)"),
        (None, "Expert (15+ years)"))
EXP3 = ((5, "Novice"), (10, "Intermediate"), (None, "Expert"))
EXP3S = ((2, "Novice"), (5, "Intermediate"), (None, "Expert"))
CAP = ((1000, "Small (<1000kg)"), (2000, "Medium (1000-2000kg)"), (3000, "Large (2000-3000kg)"),
       (None, "Extra Large (3000kg+)"))


def location(key: str) -> str:
    return (
        f"{{'latitude': CAST({key} % 20 + 22 AS DOUBLE), 'longitude': CAST({key} % 25 + 58 AS DOUBLE)}} AS location"
    )


K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"
SEGMENT = f"(['warehouse', 'highway', 'urban', 'customer'])[{K} % 4 + 1]"
PICKUP = "TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(o_orderkey * 37 % 43200 AS BIGINT))"
DRIVER = "CASE WHEN event_id % 499 <> 7 THEN user_id + event_id % 2 + 1 END"
SPEED = "CASE WHEN event_id % 211 = 5 THEN CAST(0 AS DOUBLE) WHEN event_id % 307 <> 11 THEN value END"

VIEWS = {
    "vehicles": """SELECT p_partkey AS vehicle_id, p_type AS vehicle_type, p_brand AS make, p_name AS model,
        CAST(2010 + p_size % 16 AS INTEGER) AS year, CAST(p_size * 100 AS INTEGER) AS capacity_kg,
        CAST(p_size * 4 AS INTEGER) AS fuel_capacity,
        CASE WHEN p_partkey % 20 < 17 THEN 'Active' WHEN p_partkey % 20 < 19 THEN 'Maintenance' ELSE 'Retired' END
            AS status,
        CAST(DATE '2024-01-01' - CAST(p_partkey % 180 AS INTEGER) AS DATE) AS last_maintenance FROM part""",
    "drivers": """SELECT s_suppkey AS driver_id, s_name AS name, 'LIC-' || s_suppkey AS license_number,
        CAST(1 + s_suppkey % 25 AS INTEGER) AS experience_years, CAST(s_suppkey % 21 AS DOUBLE) / 10 + 3 AS rating,
        (['OnRoute', 'Available', 'OnBreak', 'OffDuty'])[s_suppkey % 4 + 1] AS status FROM supplier""",
    "warehouses": f"""SELECT n_nationkey AS warehouse_id, n_name AS name, r_name AS city, {location('n_nationkey')},
        (n_nationkey + 1) * 1000 AS capacity_sqft FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "customers": f"""SELECT c_custkey AS customer_id, c_name AS name, n_name AS city,
        CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'Wholesale'
             WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Individual' ELSE 'Retail' END AS customer_type,
        {location('c_custkey')} FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "telemetry": f"""SELECT event_id, CASE WHEN event_id % 997 <> 3 THEN user_id END AS vehicle_id, {DRIVER} AS driver_id,
        ts AS "timestamp", CAST(event_id % 1000 AS DOUBLE) / 1000 + CAST(24.8607 AS DOUBLE) AS latitude,
        CAST(event_id * 7 % 1000 AS DOUBLE) / 1000 + CAST(67.0011 AS DOUBLE) AS longitude,
        {SPEED} AS speed, CASE WHEN event_id % 401 <> 13 THEN CAST({K} AS DOUBLE) END AS fuel_level, CAST(event_id % 100 + 30 AS DOUBLE) AS engine_temp,
        CAST(event_id % 5000 AS INTEGER) AS rpm, event_id * CAST(0.5 AS DOUBLE) + 1000 AS odometer,
        CASE WHEN {SPEED} > 5 THEN 'Moving' ELSE 'Idle' END AS status, {SEGMENT} AS segment,
        CASE WHEN {SEGMENT} = 'highway' THEN 'highway' ELSE 'urban' END AS road_type FROM events""",
    "deliveries": f"""SELECT *, completion_time <= estimated_delivery AS on_time FROM (SELECT o_orderkey AS delivery_id,
        o_custkey AS vehicle_id, o_orderkey % 120 AS driver_id, CAST(o_orderkey % 25 AS INTEGER) AS warehouse_id,
        o_custkey + 1 AS customer_id,
        CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'InProgress' ELSE 'Cancelled' END AS status,
        {PICKUP} AS pickup_time, {PICKUP} + to_minutes(CAST(30 + o_custkey % 91 AS BIGINT)) AS estimated_delivery,
        CASE WHEN o_orderstatus = 'F' THEN {PICKUP} + to_minutes(CAST(20 + o_orderkey % 121 AS BIGINT)) END
            AS completion_time,
        CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 121 + 20 AS INTEGER) END AS delivery_minutes,
        o_totalprice / 10000 AS distance_km, o_totalprice / 5000 AS package_weight FROM orders)""",
    "incidents": f"""SELECT event_id AS incident_id, user_id AS vehicle_id, {DRIVER} AS driver_id, ts AS "timestamp",
        (['harsh_braking', 'speeding', 'harsh_acceleration', 'sharp_turn', 'idling_excessive'])[{K} % 5 + 1]
            AS incident_type,
        (['Low', 'Medium', 'High', 'low', 'medium', 'high'])[{K} % 6 + 1] AS severity, value AS speed_at_incident
        FROM events WHERE event_type = 'error'""",
}

MINUTES = "date_sub('minute', d.pickup_time, d.estimated_delivery)"
ROW = 'event_id, vehicle_id, "timestamp", speed, fuel_level, engine_temp'
SQL: dict[str, str] = {}


def with_views(body: str) -> str:
    used = [f"{name} AS ({text})" for name, text in VIEWS.items() if name in body]
    return ("WITH " + ",\n".join(used) + "\n" if used else "") + body


# --- sources and sinks ---------------------------------------------------------

TELEMETRY_TOPIC = "'vehicle-telemetry'"
LOG = """(SELECT 'vehicle-telemetry' AS topic, event_id AS "offset", CAST(vehicle_id AS VARCHAR) AS key FROM telemetry
    UNION ALL SELECT 'deliveries', delivery_id, CAST(delivery_id AS VARCHAR) FROM deliveries
    UNION ALL SELECT 'incidents', incident_id, CAST(incident_id AS VARCHAR) FROM incidents)"""

SQL["stream_ingest"] = """SELECT CAST(vehicle_id AS VARCHAR) AS vehicle_id, "timestamp", latitude, longitude, speed,
    fuel_level, engine_temp, CAST(rpm AS DOUBLE) AS rpm, odometer, CAST(driver_id AS VARCHAR) AS driver_id, status
    FROM telemetry"""
SQL["json_decode"] = """SELECT vehicle_id, "timestamp", speed, fuel_level, CAST(rpm AS DOUBLE) AS rpm, driver_id,
    CAST(vehicle_id AS VARCHAR) AS key, event_id AS "offset" FROM telemetry"""
SQL["scan_full"] = " UNION ALL ".join(
    f"SELECT '{e}' AS entity, COUNT(*) AS rows FROM {e}" for e in ("customers", "telemetry", "deliveries", "incidents")
)
SQL["flatten_location"] = """SELECT 'warehouse' AS kind, CAST(warehouse_id AS BIGINT) AS id, location.latitude AS latitude,
    location.longitude AS longitude FROM warehouses
    UNION ALL SELECT 'customer', customer_id, location.latitude, location.longitude FROM customers"""
SQL["coerce_numeric"] = """SELECT event_id, value,
    TRY_CAST(regexp_replace(props, '[{}]', '', 'g') AS DOUBLE) AS props FROM events"""
SQL["extract_recent"] = f"""SELECT event_id, vehicle_id, "timestamp", speed, fuel_level FROM telemetry
    WHERE "timestamp" >= {DAY}"""
SQL["extract_dimension"] = """SELECT vehicle_id, vehicle_type, make, model, year, capacity_kg, fuel_capacity, status,
    strftime(last_maintenance, '%Y-%m-%dT%H:%M:%S.%f') AS last_maintenance FROM vehicles"""
SQL["route_by_topic"] = f"SELECT topic, COUNT(*) AS messages, COUNT(DISTINCT key) AS keys FROM {LOG} GROUP BY topic"
SQL["peek_per_topic"] = f"""SELECT topic, CAST(r AS INTEGER) AS rank, "offset", key, TRUE AS short FROM (
    SELECT *, row_number() OVER (PARTITION BY topic ORDER BY "offset" DESC) AS r FROM {LOG}) WHERE r <= 5"""
SQL["topic_counts"] = f"""SELECT topic, COUNT(*) AS messages,
    {rnd('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER ()', 2)} AS share_percent FROM {LOG} GROUP BY topic"""

HOT_ROWS = f"SELECT {ROW} FROM telemetry"
PARTS = """CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month"""
DAY_PART = """CAST(day("timestamp") AS INTEGER) AS day"""
SQL["warm_scan"] = f"""SELECT {ROW}, {PARTS}, {DAY_PART} FROM telemetry
    WHERE CAST("timestamp" AS DATE) = DATE '2024-01-15'"""
TIER = f"CASE WHEN \"timestamp\" IS NULL OR \"timestamp\" >= {HOT} THEN 'hot' WHEN \"timestamp\" >= {WARM} THEN 'warm' ELSE 'cold' END"
SQL["tiered_read"] = f"SELECT {ROW}, {TIER} AS tier FROM telemetry"
SQL["archive_candidates"] = f"""SELECT COUNT(*) AS rows, MIN("timestamp") AS oldest, MAX("timestamp") AS newest
    FROM telemetry WHERE "timestamp" < {HOT}"""
SQL["archive_warm"] = f'SELECT {ROW}, {PARTS}, {DAY_PART} FROM telemetry WHERE "timestamp" < {HOT}'
SQL["archive_retain"] = f'{HOT_ROWS} WHERE "timestamp" >= {HOT}'
SQL["archive_cold"] = f'SELECT {ROW}, {PARTS} FROM telemetry WHERE "timestamp" < {WARM}'
SQL["partition_stats"] = " UNION ALL ".join(
    f"""SELECT COUNT(*) AS rows, '{c}' AS "column", CAST(MIN({c}) AS DOUBLE) AS min_value,
    CAST(MAX({c}) AS DOUBLE) AS max_value, COUNT(DISTINCT {c}) AS distinct_values,
    COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls FROM telemetry WHERE "timestamp" < {HOT}"""
    for c in ("vehicle_id", "speed", "fuel_level")
)
SQL["tier_inventory_rows"] = f"""SELECT {PARTS}, {DAY_PART}, COUNT(*) AS rows FROM telemetry WHERE "timestamp" < {HOT}
    GROUP BY ALL"""
SQL["catalog_partitions"] = SQL["tier_inventory_rows"]
SQL["catalog_columns"] = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value,
    COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, TRUE AS distinct_near FROM telemetry WHERE "timestamp" < {HOT}"""
    for c in ("vehicle_id", "speed", "fuel_level")
)
SQL["catalog_scan"] = SQL["warm_scan"]
SQL["table_stats_rows"] = " UNION ALL ".join(
    f"SELECT '{e}' AS entity, COUNT(*) AS rows FROM {t}"
    for e, t in (("vehicles", "part"), ("drivers", "supplier"), ("customers", "customer"), ("telemetry", "events"), ("deliveries", "orders"))
)
SQL["tier_assign"] = f"""SELECT {TIER} AS tier, COUNT(*) AS rows, MIN("timestamp") AS oldest, MAX("timestamp") AS newest
    FROM telemetry GROUP BY 1"""

SQL["stream_memory_sink"] = "SELECT event_type, COUNT(*) AS rows FROM events GROUP BY event_type"
SQL["stream_upsert"] = """SELECT delivery_id, vehicle_id, driver_id,
    CASE WHEN completion_time IS NULL THEN 'InProgress' ELSE 'Completed' END AS status, pickup_time, distance_km,
    completion_time, delivery_minutes FROM deliveries"""
SQL["stream_checkpoint_restart"] = """SELECT CASE WHEN event_type IN ('error', 'click') THEN 0 ELSE 1 END AS phase,
    COUNT(*) AS rows, COUNT(DISTINCT event_id) AS events FROM events GROUP BY 1"""
SQL["merge_partial_updates"] = """WITH delta AS (
    SELECT delivery_id, vehicle_id, 'InProgress' AS status, pickup_time, NULL::TIMESTAMP AS completion_time,
        NULL::INTEGER AS delivery_minutes, pickup_time AS event_time FROM deliveries WHERE delivery_id % 2 = 1
    UNION ALL SELECT delivery_id, NULL, 'Completed', NULL, completion_time, delivery_minutes, completion_time
        FROM deliveries WHERE completion_time IS NOT NULL),
    newest AS (SELECT delivery_id,
        arg_max(vehicle_id, event_time) FILTER (WHERE vehicle_id IS NOT NULL) AS vehicle_id,
        arg_max(status, event_time) FILTER (WHERE status IS NOT NULL) AS status,
        arg_max(pickup_time, event_time) FILTER (WHERE pickup_time IS NOT NULL) AS pickup_time,
        arg_max(completion_time, event_time) FILTER (WHERE completion_time IS NOT NULL) AS completion_time,
        arg_max(delivery_minutes, event_time) FILTER (WHERE delivery_minutes IS NOT NULL) AS delivery_minutes
        FROM delta GROUP BY delivery_id),
    base AS (SELECT delivery_id, vehicle_id, 'InProgress' AS status, pickup_time, NULL::TIMESTAMP AS completion_time,
        NULL::INTEGER AS delivery_minutes FROM deliveries WHERE delivery_id % 2 = 0)
    SELECT delivery_id, COALESCE(n.vehicle_id, b.vehicle_id) AS vehicle_id, COALESCE(n.status, b.status) AS status,
        COALESCE(n.pickup_time, b.pickup_time) AS pickup_time,
        COALESCE(n.completion_time, b.completion_time) AS completion_time,
        COALESCE(n.delivery_minutes, b.delivery_minutes) AS delivery_minutes
    FROM base b FULL JOIN newest n USING (delivery_id)"""
SQL["upsert_keys_dedup"] = """SELECT 'telemetry' AS entity, COUNT(*) AS rows FROM
        (SELECT DISTINCT vehicle_id, "timestamp" FROM telemetry)
    UNION ALL SELECT 'incidents', COUNT(DISTINCT incident_id) FROM incidents
    UNION ALL SELECT 'whole_row', COUNT(*) FROM (SELECT DISTINCT name, status FROM drivers)"""
SQL["append_counts"] = " UNION ALL ".join(
    f"""SELECT '{e}' AS entity, '{part}' AS part, COUNT(*) AS written, (SELECT COUNT(*) FROM {e}) AS stored FROM {e}
    WHERE "timestamp" {op} {WARM}"""
    for e in ("telemetry", "incidents")
    for part, op in (("early", "<"), ("late", ">="))
)
SQL["stage_records"] = " UNION ALL ".join(
    f"""SELECT '{e}' AS entity, 'staging:{e}:' || {key} AS key, {AS_OF} AS written_at,
    {AS_OF} + to_seconds({ttl}) AS expires_at FROM {e} {cond}"""
    for e, key, ttl, cond in (
        ("vehicles", "vehicle_id", 3600, ""),
        ("drivers", "driver_id", 3600, ""),
        ("warehouses", "warehouse_id", 3600, ""),
        ("customers", "customer_id", 3600, ""),
        ("telemetry", "COALESCE(CAST(vehicle_id AS VARCHAR), 'None') || ':' || strftime(\"timestamp\", '%Y-%m-%dT%H:%M:%S.%f')", 1800,
         f'WHERE "timestamp" >= {DAY}'),
        ("deliveries", "delivery_id", 1800, ""),
        ("incidents", "incident_id", 1800, ""),
    )
)
SQL["staged_read"] = """SELECT 'staging:deliveries:' || delivery_id AS key, delivery_id, vehicle_id, status, distance_km,
    strftime(pickup_time, '%Y-%m-%dT%H:%M:%S.%f') AS pickup_time FROM deliveries"""
SQL["staging_clear"] = f"""SELECT 'staging:' AS prefix, (SELECT COUNT(*) FROM vehicles) + (SELECT COUNT(*) FROM drivers)
    + (SELECT COUNT(*) FROM warehouses) + (SELECT COUNT(*) FROM customers) + (SELECT COUNT(*) FROM deliveries)
    + (SELECT COUNT(*) FROM incidents) + (SELECT COUNT(*) FROM telemetry WHERE "timestamp" >= {DAY}) AS removed
    UNION ALL SELECT 'left', 9"""
SQL["staging_counts"] = " UNION ALL ".join(
    f"SELECT '{e}' AS entity, {n} AS records, {n} > 0 AS passed"
    for e, n in (
        ("vehicles", "(SELECT COUNT(*) FROM vehicles)"),
        ("drivers", "(SELECT COUNT(*) FROM drivers)"),
        ("warehouses", "(SELECT COUNT(*) FROM warehouses)"),
        ("customers", "(SELECT COUNT(*) FROM customers)"),
        ("telemetry", "0::BIGINT"),
        ("deliveries", "0::BIGINT"),
        ("incidents", "0::BIGINT"),
    )
)
SQL["json_export"] = """SELECT 'vehicles' AS entity, COUNT(*) AS rows, COUNT(DISTINCT make) AS labels FROM vehicles
    UNION ALL SELECT 'drivers', COUNT(*), COUNT(DISTINCT name) FROM drivers
    UNION ALL SELECT 'warehouses', COUNT(*), COUNT(DISTINCT name) FROM warehouses
    UNION ALL SELECT 'customers', COUNT(*), COUNT(DISTINCT name) FROM customers"""
SQL["encode_envelope"] = """SELECT 'incidents' AS topic, CAST(incident_id AS VARCHAR) AS key, vehicle_id, incident_type,
    severity, speed_at_incident FROM incidents"""

SQL["json_document"] = """SELECT CAST(to_json(list({'rank': rank, 'name': name, 'rating': rating,
    'experience_years': experience_years} ORDER BY rank)) AS VARCHAR) AS document FROM (
    SELECT row_number() OVER (ORDER BY rating DESC, driver_id) AS rank, name, rating, experience_years FROM
    (SELECT * FROM drivers ORDER BY rating DESC NULLS LAST, driver_id LIMIT 10))"""

# --- predicates and labels -------------------------------------------------------

SQL["validate_telemetry"] = f"""SELECT {ROW} FROM telemetry WHERE vehicle_id IS NOT NULL AND "timestamp" IS NOT NULL
    AND speed BETWEEN 0 AND 200 AND fuel_level BETWEEN 0 AND 100"""
SQL["validate_delivery"] = """SELECT delivery_id, vehicle_id, status FROM deliveries
    WHERE delivery_id IS NOT NULL AND vehicle_id IS NOT NULL AND status IS NOT NULL"""
SQL["validate_incident"] = """SELECT incident_id, vehicle_id, incident_type FROM incidents
    WHERE incident_id IS NOT NULL AND vehicle_id IS NOT NULL AND incident_type IS NOT NULL"""
ANOMALY = "(speed > 140 OR speed < 0 OR engine_temp > 110 OR engine_temp < 40 OR fuel_level < 5)"
ANOMALY_TYPE = """CASE WHEN speed > 140 THEN 'OVER_SPEED' WHEN speed < 0 THEN 'INVALID_SPEED'
    WHEN engine_temp > 110 THEN 'OVERHEATING' WHEN engine_temp < 40 THEN 'ENGINE_COLD'
    WHEN fuel_level < 5 THEN 'LOW_FUEL' ELSE 'UNKNOWN' END AS anomaly_type"""
SQL["anomaly_filter"] = f"SELECT {ROW} FROM telemetry WHERE {ANOMALY}"
SQL["anomaly_classify"] = f"SELECT {ROW}, {ANOMALY_TYPE} FROM telemetry WHERE {ANOMALY}"
SQL["stream_anomalies"] = f"""SELECT {ROW}, {ANOMALY_TYPE} FROM telemetry WHERE {ANOMALY}
    AND vehicle_id IS NOT NULL AND speed BETWEEN 0 AND 200 AND fuel_level BETWEEN 0 AND 100"""
SQL["predicate_mix"] = f"""SELECT delivery_id, status, warehouse_id, distance_km FROM deliveries
    WHERE status IN ('InProgress', 'Completed') AND distance_km BETWEEN 5 AND 30 AND package_weight > 0
    AND warehouse_id <> 3 AND pickup_time >= {LOOKBACK}"""
SQL["experience_buckets"] = f"""SELECT driver_id, {levels('experience_years', *EXP4)} AS four_levels,
    {levels('experience_years', *EXP3)} AS three_levels, {levels('experience_years', *EXP3S)} AS short_levels FROM drivers"""
SQL["capacity_class"] = f"SELECT vehicle_id, {levels('capacity_kg', *CAP)} AS capacity_class FROM vehicles"
SQL["motion_status"] = """SELECT event_id, CASE WHEN speed > 5 THEN 'Moving' ELSE 'Idle' END AS status,
    CASE WHEN speed > 10 THEN 'Moving' ELSE 'Idle' END AS incident_status FROM telemetry"""
# Incident types above 100, above 60 and up to 60.
SQL["speed_band"] = """SELECT event_id, array_to_string(CASE
    WHEN speed > 100 THEN ['speeding', 'harsh_acceleration', 'sharp_turn']
    WHEN speed > 60 THEN ['harsh_braking', 'sharp_turn', 'sudden_lane_change', 'speeding']
    ELSE ['harsh_braking', 'harsh_acceleration', 'sudden_lane_change'] END, ', ') AS candidates FROM telemetry"""
SQL["temp_zone"] = """SELECT event_id, CASE WHEN engine_temp < 75 THEN NULL WHEN engine_temp < 95 THEN 'normal'
    WHEN engine_temp < 105 THEN 'warning' WHEN engine_temp <= 120 THEN 'critical' END AS zone FROM telemetry"""
SQL["road_type_map"] = """SELECT event_id, segment, CASE segment WHEN 'highway' THEN 'highway' ELSE 'urban' END AS mapped
    FROM telemetry"""

# --- joins -------------------------------------------------------------------------

SQL["join_inner_star"] = """SELECT t.event_id, d.name, v.vehicle_type, t.speed FROM telemetry t
    JOIN drivers d ON t.driver_id = d.driver_id JOIN vehicles v ON t.vehicle_id = v.vehicle_id"""
SQL["join_star4"] = """SELECT d.delivery_id, w.city AS origin_city, c.customer_type, v.vehicle_type FROM deliveries d
    JOIN warehouses w ON d.warehouse_id = w.warehouse_id JOIN customers c ON d.customer_id = c.customer_id
    JOIN vehicles v ON d.vehicle_id = v.vehicle_id"""
SQL["join_left_dim"] = """SELECT i.driver_id, i.incident_id, d.name, d.experience_years FROM incidents i
    LEFT JOIN drivers d ON i.driver_id = d.driver_id"""
SQL["join_vehicle_day"] = """SELECT t.vehicle_id, CAST(t."timestamp" AS DATE) AS day,
    COUNT(DISTINCT t.event_id) AS readings, COUNT(DISTINCT d.delivery_id) AS deliveries, COUNT(*) AS joined_rows
    FROM telemetry t LEFT JOIN deliveries d ON t.vehicle_id = d.vehicle_id
        AND CAST(t."timestamp" AS DATE) = CAST(d.pickup_time AS DATE) GROUP BY 1, 2"""
SQL["join_left_chain"] = """SELECT w.city AS origin_city, COUNT(*) AS joined_rows,
    COUNT(DISTINCT t.vehicle_id) AS vehicles
    FROM telemetry t LEFT JOIN deliveries d ON t.vehicle_id = d.vehicle_id
        AND CAST(t."timestamp" AS DATE) = CAST(d.pickup_time AS DATE)
    LEFT JOIN warehouses w ON d.warehouse_id = w.warehouse_id GROUP BY 1"""
INTERVAL = """incidents i ON i.driver_id = t.driver_id
    AND i."timestamp" BETWEEN t."timestamp" - INTERVAL 1 HOUR AND t."timestamp\""""
SQL["join_interval"] = f"""SELECT t.driver_id, t.event_id, t."timestamp", t.vehicle_id, COUNT(i.incident_id) AS incidents
    FROM telemetry t LEFT JOIN {INTERVAL} GROUP BY ALL"""
SQL["stream_join_interval"] = SQL["join_interval"]
SQL["fk_orphans"] = " UNION ALL ".join(
    f"""SELECT '{fact}' AS entity, '{c}' AS "column", CAST(f.{c} AS BIGINT) AS fk, COUNT(*) AS rows FROM {fact} f
    WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{c} = f.{c}) GROUP BY f.{c}"""
    for fact, c, dim in FOREIGN_KEYS
)
SQL["stream_enrich"] = """SELECT t.driver_id, t.event_id, t.speed, d.name, d.rating FROM telemetry t
    LEFT JOIN drivers d ON t.driver_id = d.driver_id"""

# --- aggregates -----------------------------------------------------------------------

SQL["table_counts"] = " UNION ALL ".join(f"SELECT '{e}' AS entity, COUNT(*) AS rows FROM {e}" for e in VIEWS)
SQL["count_distincts"] = """SELECT road_type, COUNT(DISTINCT vehicle_id) AS vehicles,
    COUNT(DISTINCT CAST("timestamp" AS DATE)) AS days, COUNT(DISTINCT speed) AS speeds FROM telemetry GROUP BY road_type"""
SQL["distinct_estimates"] = " UNION ALL ".join(
    f"""SELECT road_type, '{first}' AS first_day, COUNT(DISTINCT vehicle_id) AS vehicles, COUNT(DISTINCT speed) AS speeds,
    TRUE AS vehicle_id_near, TRUE AS speed_near FROM telemetry WHERE CAST("timestamp" AS DATE) BETWEEN DATE '{first}' AND DATE '{last}'
    GROUP BY road_type"""
    for first, last in (("2024-01-01", "2024-01-07"), ("2024-01-05", "2024-01-20"), ("2024-01-01", "2024-01-31"))
)
SQL["counts_by_category"] = " UNION ALL ".join(
    f"""SELECT '{e}' AS entity, '{c}' AS "column", {c} AS category, COUNT(*) AS rows FROM {e} GROUP BY {c}"""
    for e, c in (("vehicles", "vehicle_type"), ("drivers", "status"), ("customers", "customer_type"))
)
for _name, _c in (("minute_series_speed", "speed"), ("minute_series_fuel", "fuel_level")):
    SQL[_name] = f"""SELECT strftime("timestamp", '%Y-%m-%d %H:%M') AS minute, {rnd(davg(_c), 4)} AS avg_{_c}
        FROM telemetry WHERE "timestamp" >= {DAY} GROUP BY 1"""


def minute_means(since: str) -> str:
    return f"""(SELECT {davg('speed')} AS speed, {davg('fuel_level')} AS fuel_level FROM telemetry
    WHERE "timestamp" >= {since} GROUP BY date_trunc('minute', "timestamp"))"""


SQL["fleet_avg_minutely"] = f"""SELECT {rnd(davg('speed'), 1)} AS avg_speed, {rnd(davg('fuel_level'), 1)} AS avg_fuel_level
    FROM {minute_means(DAY)}"""
SQL["recent_rollup"] = f"""SELECT vehicle_id, {rnd(davg('speed'), 2)} AS avg_speed, {rnd(davg('fuel_level'), 2)} AS avg_fuel,
    COUNT(*) AS record_count, TIMESTAMP '2024-01-30 23:00:00' AS window_start, {AS_OF} AS window_end
    FROM telemetry WHERE "timestamp" >= TIMESTAMP '2024-01-30 23:00:00' GROUP BY vehicle_id"""
SQL["dup_keys"] = """SELECT vehicle_id, fuel_level, COUNT(*) AS rows FROM telemetry GROUP BY 1, 2 HAVING COUNT(*) > 1"""
SQL["speed_profile_stats"] = f"""SELECT vehicle_id, COUNT(speed) AS readings, {rnd(davg('speed'), 2)} AS mean,
    {rnd('stddev_pop(speed)', 2)} AS std, {rnd('MIN(speed)', 2)} AS min, {rnd('MAX(speed)', 2)} AS max,
    {rnd('quantile_cont(speed, 0.25)', 2)} AS q25, {rnd('quantile_cont(speed, 0.5)', 2)} AS median,
    {rnd('quantile_cont(speed, 0.75)', 2)} AS q75 FROM telemetry GROUP BY vehicle_id"""
AWAY = rnd("ABS(t.speed - s.mu)", 8)
WITHIN = {
    k: f"(COUNT(*) FILTER (WHERE {AWAY} <= {rnd(f's.sd * {k}', 8)})) / CAST(COUNT(t.speed) AS DOUBLE)" for k in (1, 2, 3)
}
SQL["normality_check"] = f"""SELECT t.vehicle_id, {WITHIN[1]} BETWEEN 0.6 AND 0.75 AS rule_68,
    {WITHIN[2]} BETWEEN 0.9 AND 0.98 AS rule_95, {WITHIN[3]} BETWEEN 0.95 AND 1 AS rule_99,
    {", ".join(rnd(WITHIN[k] + ' * 100', 2) + f' AS actual_{k}std' for k in (1, 2, 3))}
    FROM telemetry t JOIN (SELECT vehicle_id, {davg('speed')} AS mu, stddev_pop(speed) AS sd FROM telemetry
    GROUP BY vehicle_id) s ON t.vehicle_id IS NOT DISTINCT FROM s.vehicle_id WHERE t.speed IS NOT NULL GROUP BY t.vehicle_id"""
SQL["incident_dispersion"] = f"""WITH days AS (SELECT UNNEST(generate_series(MIN(CAST("timestamp" AS DATE)),
        MAX(CAST("timestamp" AS DATE)), INTERVAL 1 DAY)) AS day FROM incidents),
    grid AS (SELECT v.vehicle_id, d.day, COUNT(i.incident_id) AS n
        FROM (SELECT vehicle_id FROM incidents UNION SELECT vehicle_id FROM vehicles) v
        CROSS JOIN days d LEFT JOIN incidents i ON i.vehicle_id IS NOT DISTINCT FROM v.vehicle_id AND CAST(i."timestamp" AS DATE) = d.day
        GROUP BY 1, 2),
    moments AS (SELECT vehicle_id, CAST(COUNT(*) AS INTEGER) AS days, avg(n) AS m, var_pop(n) AS v, MIN(n) AS lo, MAX(n) AS hi
        FROM grid GROUP BY vehicle_id)
    SELECT vehicle_id, days, {rnd('m', 3)} AS mean, {rnd('v', 3)} AS variance,
        {rnd('COALESCE(v / NULLIF(m, 0), 0)', 3)} AS variance_to_mean_ratio, {rnd('sqrt(v)', 3)} AS std, lo AS min, hi AS max,
        {rnd('COALESCE(v / NULLIF(m, 0), 0)', 8)} BETWEEN 0.8 AND 1.2 AS follows_poisson FROM moments"""
SQL["state_share"] = f"""SELECT vehicle_id, segment, COUNT(*) AS rows,
    {rnd('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (PARTITION BY vehicle_id)', 2)} AS share_percent
    FROM telemetry GROUP BY vehicle_id, segment"""

# --- ordered rows -------------------------------------------------------------------------

BY_TIME = 'OVER (PARTITION BY vehicle_id ORDER BY "timestamp", event_id)'


def previous(c: str) -> str:
    return f"(SELECT *, lag({c}) {BY_TIME} AS prev FROM telemetry)"


def haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * power(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(2 * 6371.0::DOUBLE * atan2(sqrt({a}), sqrt(1 - {a})))"


SQL["route_distance"] = f"""SELECT vehicle_id, COUNT(*) AS points, COALESCE({rnd(dsum('km'), 3)}, 0.0) AS distance_km FROM (
    SELECT vehicle_id, {haversine('plat', 'plon', 'latitude', 'longitude')} AS km FROM (SELECT vehicle_id, latitude,
    longitude, lag(latitude) {BY_TIME} AS plat, lag(longitude) {BY_TIME} AS plon FROM telemetry)) GROUP BY vehicle_id"""
PAIR_CORR = """CASE WHEN MIN(engine_temp) FILTER (WHERE prev IS NOT NULL) < MAX(engine_temp) FILTER (WHERE prev IS NOT NULL)
    AND MIN(prev) < MAX(prev) THEN corr(prev, engine_temp) END"""
SQL["ar1_check"] = f"""SELECT vehicle_id, readings, sample_mean, 85.0::DOUBLE AS theoretical_mean, sample_variance,
    256.41::DOUBLE AS theoretical_variance, {rnd('c', 3)} AS lag1_autocorrelation, 0.95::DOUBLE AS theoretical_phi,
    COALESCE(ABS(c - 0.95::DOUBLE) < 0.1, FALSE) AS ar1_property_holds FROM (
    SELECT vehicle_id, COUNT(*) AS readings, {rnd(davg('engine_temp'), 2)} AS sample_mean,
    {rnd('var_pop(engine_temp)', 2)} AS sample_variance, {PAIR_CORR} AS c FROM {previous('engine_temp')} GROUP BY vehicle_id)"""
SQL["ar1_residual"] = f"""SELECT event_id, vehicle_id, "timestamp", engine_temp, residual FROM (
    SELECT *, {rnd('engine_temp - ((prev - 85) * 0.95::DOUBLE + 85)', 6)} AS residual FROM {previous('engine_temp')})
    WHERE ABS(residual) > 15"""
SQL["speed_jump"] = f"""SELECT event_id, vehicle_id, "timestamp", speed, prev AS prev_speed, change,
    {rnd('prev + sign(change) * 15', 2)} AS allowed_speed FROM (
    SELECT *, {rnd('speed - prev', 6)} AS change FROM {previous('speed')}) WHERE ABS(change) > 15"""
SQL["ts_monotonic"] = """SELECT vehicle_id, COUNT(*) AS readings, COUNT(*) FILTER (WHERE "timestamp" < prev) AS out_of_order,
    COUNT(*) FILTER (WHERE "timestamp" < prev) = 0 AS passed FROM (
    SELECT *, lag("timestamp") OVER (PARTITION BY vehicle_id ORDER BY event_id) AS prev FROM telemetry) GROUP BY vehicle_id"""
SQL["fuel_monotonic"] = f"""SELECT vehicle_id, COUNT(*) FILTER (WHERE fuel_level < prev) AS falls,
    COUNT(*) FILTER (WHERE fuel_level = prev) AS flat, COUNT(*) FILTER (WHERE fuel_level > prev) AS refuels,
    COUNT(*) FILTER (WHERE fuel_level > prev) = 0 AS passed FROM {previous('fuel_level')} GROUP BY vehicle_id"""
MOVES = "(CASE " + " ".join(
    f"WHEN prev = '{a}' AND segment = '{b}' THEN {p}::DOUBLE" for a, row in ROUTE_MOVES.items() for b, p in row.items()
) + " END)"
SQL["transition_matrix"] = f"""SELECT prev AS from_state, segment AS to_state, COUNT(*) AS moves,
    {rnd('COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY prev) AS DOUBLE)', 4)} AS observed,
    ANY_VALUE({MOVES}) AS configured FROM {previous('segment')} WHERE prev IS NOT NULL GROUP BY prev, segment"""
SQL["latest_per_key"] = """SELECT vehicle_id, event_id, "timestamp", speed, fuel_level FROM telemetry
    QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY "timestamp" DESC, event_id DESC) = 1"""

# --- top rows ----------------------------------------------------------------------------------

TOP = "FROM drivers ORDER BY rating DESC NULLS LAST, driver_id LIMIT 10"
SQL["driver_rank"] = f"""SELECT CAST(row_number() OVER (ORDER BY rating DESC, driver_id) AS INTEGER) AS rank, driver_id, name,
    rating FROM (SELECT * {TOP})"""
SQL["top_drivers"] = f"SELECT driver_id, name, rating, experience_years {TOP}"
SQL["recent_incidents"] = """SELECT incident_id, vehicle_id, driver_id, incident_type, severity, "timestamp" FROM incidents
    ORDER BY "timestamp" DESC NULLS LAST, incident_id DESC LIMIT 10"""
SQL["latest_telemetry"] = f'SELECT {ROW} FROM telemetry ORDER BY "timestamp" DESC NULLS LAST, event_id DESC LIMIT 5'

SQL["latest_deliveries"] = """SELECT delivery_id, vehicle_id, status, pickup_time FROM deliveries
    ORDER BY pickup_time DESC NULLS LAST, delivery_id DESC LIMIT 5"""

# --- scalars ------------------------------------------------------------------------------------

SQL["scalar_time"] = f"""SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN "timestamp" END AS parsed,
    CASE WHEN event_id % 7 <> 0 THEN "timestamp" ELSE {AS_OF} END AS repaired, event_id % 7 = 0 AS ts_repaired,
    strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f') AS iso, CAST("timestamp" AS DATE) AS day,
    strftime("timestamp", '%Y-%m-%d %H:%M') AS minute, strftime("timestamp", '%H:%M:%S') AS clock,
    substring(strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%f'), 1, 8) AS clock_fallback,
    date_sub('minute', "timestamp", {AS_OF}) AS minutes_to_end FROM telemetry"""
TITLE = """(CASE incident_type WHEN 'harsh_braking' THEN 'Harsh Braking' WHEN 'speeding' THEN 'Speeding'
    WHEN 'harsh_acceleration' THEN 'Harsh Acceleration' WHEN 'sharp_turn' THEN 'Sharp Turn'
    WHEN 'idling_excessive' THEN 'Idling Excessive' ELSE 'N/A' END)"""
SQL["scalar_text"] = f"""SELECT incident_id, {TITLE} AS title, upper(severity[1]) || lower(severity[2:]) AS capital,
    CASE WHEN incident_id % 2 = 0 THEN {TITLE} ELSE 'N/A' END AS or_na, lower(severity) AS lower,
    'VEH-' || printf('%05d', vehicle_id) AS vehicle, 'INC-' || printf('%08d', incident_id) AS incident,
    incident_type AS preview FROM incidents"""
GUARD = "CASE WHEN fuel_level = 0 THEN 0 ELSE COALESCE(speed / fuel_level * 100, 0) END"
DENSITY = "exp(-((speed - 50) * (speed - 50)) / (225 * 2.0::DOUBLE)) / sqrt(225 * 2.0::DOUBLE * pi())"
SQL["scalar_math"] = f"""SELECT event_id, {rnd('speed', 1)} AS r1, {rnd('speed', 0)} AS r0, {rnd(GUARD, 6)} AS guarded,
    {rnd('speed / NULLIF(fuel_level, 0)', 6)} AS null_if_zero,
    CASE WHEN speed IS NOT NULL THEN CAST(GREATEST(10, LEAST(140, speed)) AS DOUBLE) END AS clipped, CAST(sign(speed - 50) AS DOUBLE) AS side,
    {rnd('ABS(speed - 50)', 6)} AS distance_from_50, {rnd('(speed - 50) * (speed - 50)', 6)} AS squared,
    {rnd(haversine('24.8607::DOUBLE', '67.0011::DOUBLE', 'latitude', 'longitude'), 6)} AS km,
    {rnd(DENSITY, 6)} AS density, CASE WHEN fuel_level > 50 THEN fuel_level ELSE 0 END AS defaulted FROM telemetry"""

# --- windows --------------------------------------------------------------------------------------

ROLLUP = f"""vehicle_id, {rnd(davg('speed'), 2)} AS avg_speed, {rnd('MAX(speed)', 2)} AS max_speed,
    {rnd('MIN(speed)', 2)} AS min_speed, {rnd(davg('fuel_level'), 2)} AS avg_fuel_level,
    {rnd(davg('engine_temp'), 2)} AS avg_engine_temp, COUNT(*) AS record_count"""
SLIDING = """(SELECT *, date_trunc('minute', "timestamp") - to_minutes(i) AS window_start
    FROM telemetry CROSS JOIN range(5) AS r(i))"""
TUMBLING = """(SELECT *, time_bucket(INTERVAL 5 MINUTES, "timestamp") AS window_start FROM telemetry)"""
SQL["sliding_rollup"] = f"""SELECT window_start, window_start + INTERVAL 5 MINUTES AS window_end, {ROLLUP} FROM {SLIDING}
    GROUP BY window_start, vehicle_id"""
SQL["latest_aggregations"] = SQL["sliding_rollup"] + " ORDER BY window_start DESC, vehicle_id NULLS LAST LIMIT 5"
SQL["tumbling_rollup"] = f"""SELECT window_start, window_start + INTERVAL 5 MINUTES AS window_end, {ROLLUP} FROM {TUMBLING}
    GROUP BY window_start, vehicle_id"""
CLOSED = "window_start + INTERVAL 5 MINUTES <= (SELECT MAX(\"timestamp\") - INTERVAL 10 MINUTES FROM telemetry)"
SQL["stream_append_vs_update"] = f"""SELECT 'append' AS mode, COUNT(*) AS windows, CAST(SUM(n) AS BIGINT) AS records FROM
    (SELECT window_start, vehicle_id, COUNT(*) AS n FROM {SLIDING} GROUP BY 1, 2) WHERE {CLOSED}
    UNION ALL SELECT 'update', COUNT(*), CAST(SUM(n) AS BIGINT) FROM
    (SELECT window_start, vehicle_id, COUNT(*) AS n FROM {SLIDING} GROUP BY 1, 2)"""
STRAGGLER = "\"timestamp\" < TIMESTAMP '2024-01-16' AND event_id % 10 = 0"
SQL["stream_late_data"] = f"""SELECT COUNT(*) AS windows, CAST(SUM(n) AS BIGINT) AS records,
    (SELECT COUNT(*) FROM {TUMBLING} WHERE {STRAGGLER} AND window_start + INTERVAL 5 MINUTES <=
        (SELECT MAX("timestamp") - INTERVAL 10 MINUTES FROM telemetry WHERE NOT ({STRAGGLER}))) AS late_rows FROM
    (SELECT window_start, vehicle_id, COUNT(*) AS n FROM {TUMBLING} WHERE NOT ({STRAGGLER}) GROUP BY 1, 2) WHERE {CLOSED}"""
VALID = "vehicle_id IS NOT NULL AND speed BETWEEN 0 AND 200 AND fuel_level BETWEEN 0 AND 100"
SQL["stream_multi"] = f"""SELECT 'valid' AS output, COUNT(*) AS rows FROM telemetry WHERE {VALID}
    UNION ALL SELECT 'anomalies', COUNT(*) FROM telemetry WHERE {VALID} AND {ANOMALY}
    UNION ALL SELECT 'incidents', COUNT(*) FROM incidents"""
SQL["stream_pipeline"] = f"""SELECT 'telemetry' AS output, COUNT(*) AS rows FROM telemetry
    UNION ALL SELECT 'windows', COUNT(*) FROM (SELECT DISTINCT window_start, vehicle_id FROM {SLIDING} WHERE {VALID})
    UNION ALL SELECT 'window_records', COUNT(*) FROM {SLIDING} WHERE {VALID}
    UNION ALL SELECT 'anomalies', COUNT(*) FROM telemetry WHERE {VALID} AND {ANOMALY}
    UNION ALL SELECT 'deliveries', COUNT(*) FROM deliveries
        WHERE delivery_id IS NOT NULL AND vehicle_id IS NOT NULL AND status IS NOT NULL
    UNION ALL SELECT 'incidents', COUNT(*) FROM incidents
        WHERE incident_id IS NOT NULL AND vehicle_id IS NOT NULL AND incident_type IS NOT NULL"""
SQL["stream_dedup"] = "SELECT event_id, ts, user_id, value FROM events"
SQL["stream_progress"] = """SELECT 'telemetry' AS query, COUNT(*) AS input_rows, 0::BIGINT AS late_rows FROM events"""
FRESH = "COUNT(*) FILTER (WHERE \"timestamp\" >= TIMESTAMP '2024-01-30 23:53:00')"
SQL["freshness_check"] = f"""SELECT MAX("timestamp") AS newest, {FRESH} AS recent_rows, {FRESH} > 0 AS passed FROM telemetry"""

# --- quality ------------------------------------------------------------------------------------------


def checks(rows) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{check}' AS "check", '{e}' AS entity, '{c}' AS "column", COUNT(*) FILTER (WHERE {bad}) AS violations,
        COUNT(*) AS total, COUNT(*) FILTER (WHERE {bad}) = 0 AS passed FROM {e}"""
        for check, e, c, bad in rows
    )


NULL_CHECKS = [("nulls", e, c, f"{c} IS NULL") for e, c in
               (("vehicles", "vehicle_id"), ("drivers", "driver_id"), ("telemetry", "speed"))]
OUTLIERS = [("outliers", "telemetry", "speed", "speed > 200"), ("outliers", "telemetry", "fuel_level", "fuel_level < 0")]
SQL["dq_nulls"] = checks(NULL_CHECKS)
SQL["dq_outliers"] = checks(OUTLIERS)
SQL["dq_missing"] = checks(
    [("missing", e, c, f"{c} IS NULL") for e, c in (("vehicles", "vehicle_id"), ("drivers", "driver_id"),
                                                    ("warehouses", "location"), ("customers", "location"))]
)
SQL["dq_ranges"] = checks(
    [
        ("ranges", "telemetry", "latitude", "latitude NOT BETWEEN 24 AND 38"),
        ("ranges", "telemetry", "longitude", "longitude NOT BETWEEN 60 AND 78"),
        ("ranges", "telemetry", "speed", "speed NOT BETWEEN 0 AND 120"),
    ]
)
REQUIRED = {
    "vehicles": ["vehicle_id", "vehicle_type", "make", "model"],
    "drivers": ["driver_id", "name", "license_number"],
    "warehouses": ["warehouse_id", "name", "location", "location.latitude", "location.longitude"],
    "customers": ["customer_id", "name", "location", "location.latitude", "location.longitude"],
    "telemetry": ["vehicle_id", "timestamp", "latitude", "longitude"],
    "deliveries": ["delivery_id", "vehicle_id", "driver_id"],
    "incidents": ["incident_id", "vehicle_id", "timestamp"],
}
LIMITS = [
    ("enum", "vehicles", "vehicle_type", "vehicle_type NOT IN ('Van', 'Truck', 'Pickup', 'SUV')"),
    ("minimum", "vehicles", "year", "year < 2010"),
    ("maximum", "vehicles", "year", "year > 2025"),
    ("minimum", "vehicles", "capacity_kg", "capacity_kg < 0"),
    ("minimum", "vehicles", "fuel_capacity", "fuel_capacity < 0"),
    ("enum", "vehicles", "status", "status NOT IN ('Active', 'Maintenance', 'Retired')"),
    ("minimum", "drivers", "experience_years", "experience_years < 0"),
    ("minimum", "drivers", "rating", "rating < 0"),
    ("maximum", "drivers", "rating", "rating > 5"),
    ("enum", "drivers", "status", "status NOT IN ('Available', 'OnRoute', 'OnBreak', 'OffDuty')"),
    ("minimum", "warehouses", "capacity_sqft", "capacity_sqft < 0"),
    ("enum", "customers", "customer_type", "customer_type NOT IN ('Retail', 'Wholesale', 'Individual')"),
    ("minimum", "telemetry", "speed", "speed < 0"),
    ("minimum", "telemetry", "fuel_level", "fuel_level < 0"),
    ("minimum", "telemetry", "odometer", "odometer < 0"),
    ("enum", "deliveries", "status", "status NOT IN ('InProgress', 'Completed', 'Cancelled')"),
    ("enum", "incidents", "incident_type", "incident_type NOT IN ('harsh_braking', 'harsh_acceleration', 'speeding', "
     "'sharp_turn', 'idling_excessive')"),
    ("enum", "incidents", "severity", "severity NOT IN ('Low', 'Medium', 'High')"),
]
SQL["dq_schema_rules"] = checks([("required", e, c, f"{c} IS NULL") for e, cs in REQUIRED.items() for c in cs] + LIMITS)
PLANTED = {  # entity: key, path whose value has the wrong type in every fiftieth document
    "vehicles": ("vehicle_id", "year"), "drivers": ("driver_id", "rating"), "warehouses": ("warehouse_id", "location"),
    "customers": ("customer_id", "name"), "telemetry": ("event_id", "speed"), "deliveries": ("delivery_id", "driver_id"),
    "incidents": ("incident_id", "timestamp"),
}
TYPED = {
    "vehicles": "vehicle_id make model year capacity_kg fuel_capacity",
    "drivers": "driver_id name license_number experience_years rating",
    "warehouses": "warehouse_id name location location.latitude location.longitude city capacity_sqft",
    "customers": "customer_id name location location.latitude location.longitude city",
    "telemetry": "vehicle_id timestamp latitude longitude speed fuel_level odometer engine_temp",
    "deliveries": "delivery_id vehicle_id driver_id warehouse_id customer_id",
    "incidents": "incident_id vehicle_id timestamp",
}


def raw_rules() -> list[tuple[str, str, str, str]]:
    """(check, entity, path, condition) over the views, with the planted faults."""
    out = []
    for e, (key, path) in PLANTED.items():
        whole, hurt = f"COALESCE({key} % 70 <> 9, TRUE)", f"COALESCE({key} % 50 = 3, FALSE)"
        out.append(("json", e, "$", f"NOT {whole}"))
        for c in REQUIRED[e]:
            lost = f"({c} IS NULL OR {hurt})" if path == "location" and c.startswith("location.") else f"{c} IS NULL"
            out.append(("required", e, c, f"{whole} AND {lost}"))
        out += [("type", e, c, f"{whole} AND {hurt} AND {c} IS NOT NULL" if c == path else "FALSE") for c in TYPED[e].split()]
        for check, entity, c, bad in LIMITS:
            if entity == e:
                out.append((check, e, c, f"{whole} AND {bad}" + (f" AND NOT {hurt}" if c == path else "")))
    return out


SQL["dq_raw_rules"] = checks(raw_rules())
SQL["dq_quarantine"] = " UNION ALL ".join(
    f"""SELECT '{e}' AS entity, COUNT(*) FILTER (WHERE NOT bad) AS passed, COUNT(*) FILTER (WHERE bad) AS quarantined FROM
    (SELECT {' OR '.join(f'COALESCE({bad}, FALSE)' for _, entity, _, bad in raw_rules() if entity == e)} AS bad FROM {e})"""
    for e in PLANTED
)
UNIQUE = [("vehicles", "vehicle_id"), ("drivers", "driver_id"), ("drivers", "license_number"),
          ("warehouses", "warehouse_id"), ("customers", "customer_id"), ("deliveries", "delivery_id"),
          ("incidents", "incident_id")]


def duplicates(keys) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'duplicates' AS "check", '{e}' AS entity, '{c}' AS "column", COUNT(*) FILTER (WHERE n > 1) AS violations,
        COUNT(*) AS total, COUNT(*) FILTER (WHERE n > 1) = 0 AS passed FROM (SELECT COUNT(*) AS n FROM {e} GROUP BY {c})"""
        for e, c in keys
    )


SQL["dq_duplicates"] = duplicates(UNIQUE)
SQL["dq_foreign_keys"] = " UNION ALL ".join(
    f"""SELECT 'foreign_key' AS "check", '{fact}' AS entity, '{c}' AS "column", COUNT(*) FILTER (WHERE lost) AS violations,
    COUNT(*) AS total, COUNT(*) FILTER (WHERE lost) = 0 AS passed FROM (SELECT NOT EXISTS (SELECT 1 FROM {dim} d
    WHERE d.{c} = f.{c}) AS lost FROM {fact} f)"""
    for fact, c, dim in FOREIGN_KEYS
)
SQL["dq_expected_counts"] = " UNION ALL ".join(
    f"SELECT '{e}' AS entity, {n}::BIGINT AS expected, COUNT(*) AS actual, COUNT(*) = {n} AS passed FROM {e}"
    for e, n in (("vehicles", 500), ("drivers", 350), ("warehouses", 20), ("customers", 10000))
)
SUMMARY = f"{checks(NULL_CHECKS)} UNION ALL {checks(OUTLIERS)} UNION ALL {duplicates(UNIQUE[:1])}"
def summary(run_at: str, source: str) -> str:
    return f"""SELECT {run_at} AS run_at, (SELECT COUNT(*) FROM vehicles) AS vehicles,
    (SELECT COUNT(*) FROM drivers) AS drivers, (SELECT COUNT(*) FROM telemetry) AS telemetry,
    (SELECT COUNT(*) FROM deliveries) AS deliveries, (SELECT COUNT(*) FROM incidents) AS incidents, COUNT(*) AS checks,
    COUNT(*) FILTER (WHERE NOT passed) AS failed,
    CASE WHEN bool_and(passed) THEN 'passed' ELSE 'failed' END AS quality_check FROM ({source})"""


SQL["dq_summary"] = summary(AS_OF, SUMMARY)
SQL["dq_history"] = " UNION ALL ".join(
    summary(f"TIMESTAMP '2024-01-{day} 00:00:00'", checks(NULL_CHECKS)) for day in (30, 31)
)
SQL["dq_expect"] = """SELECT event_id, concat_ws(',', CASE WHEN vehicle_id IS NULL THEN 'required:vehicle_id' END,
    CASE WHEN speed NOT BETWEEN 0 AND 120 THEN 'range:speed' END,
    CASE WHEN fuel_level NOT BETWEEN 5 AND 95 THEN 'range:fuel_level' END) AS broken_rules FROM telemetry"""

# --- KPIs ------------------------------------------------------------------------------------------------


def one(expr: str, source: str) -> str:
    return f"(SELECT {expr} FROM {source})"


def long(pairs: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS kpi, CAST({v} AS DOUBLE) AS value" for k, v in pairs.items())


def pct(num: str, den: str, digits: int, factor: str = "100") -> str:
    return f"COALESCE({rnd(f'CAST({num} AS DOUBLE) / NULLIF({den}, 0) * {factor}', digits)}, 0)"


N = {e: one("COUNT(*)", e) for e in VIEWS}
ACTIVE = one("COUNT(DISTINCT vehicle_id)", "telemetry")
COMPLETED = one("COUNT(*)", "deliveries WHERE status = 'Completed'")
ON_ROUTE = one("COUNT(*)", "drivers WHERE status = 'OnRoute'")
HIGH = one("COUNT(*)", "incidents WHERE lower(severity) = 'high'")
RATING = f"COALESCE({one(rnd(davg('rating'), 2), 'drivers')}, 0)"
SPEED = f"COALESCE({one(rnd(davg('speed'), 2), 'telemetry WHERE speed > 0')}, 0)"
FUEL = f"COALESCE({one(rnd(davg('fuel_level'), 2), 'telemetry')}, 0)"
FLEET = {
    "total_vehicles": N["vehicles"],
    "active_vehicles": ACTIVE,
    "fleet_utilization_percent": pct(ACTIVE, N["vehicles"], 2),
    "total_drivers": N["drivers"],
    "drivers_on_route": ON_ROUTE,
    "avg_driver_rating": RATING,
    "avg_speed_kmh": SPEED,
    "avg_fuel_level_percent": FUEL,
    "total_deliveries": N["deliveries"],
    "completed_deliveries": COMPLETED,
    "delivery_success_rate_percent": pct(COMPLETED, N["deliveries"], 2),
    "total_incidents": N["incidents"],
    "high_severity_incidents": HIGH,
    "incident_rate_per_1000": pct(N["incidents"], N["telemetry"], 2, "1000"),
}
SINCE = "TIMESTAMP '2024-01-29 23:58:00'"
NOW_ACTIVE = one("COUNT(DISTINCT vehicle_id)", "telemetry WHERE \"timestamp\" >= TIMESTAMP '2024-01-30 23:53:00'")
REALTIME = {
    "total_vehicles": N["vehicles"],
    "active_vehicles": NOW_ACTIVE,
    "fleet_utilization_percent": pct(NOW_ACTIVE, N["vehicles"], 1),
    "drivers_on_route": one("COUNT(DISTINCT driver_id)", "deliveries WHERE status IN ('InProgress', 'Pending')"),
    "avg_speed_kmh": one(rnd(davg("speed"), 1), minute_means(SINCE)),
    "total_incidents": N["incidents"],
    "delivery_success_rate_percent": pct(COMPLETED, N["deliveries"], 1),
    "total_deliveries": N["deliveries"],
    "avg_driver_rating": RATING,
    "avg_fuel_level_percent": one(rnd(davg("fuel_level"), 1), minute_means(SINCE)),
}
TOTALS = {
    "total_vehicles": N["vehicles"],
    "total_drivers": N["drivers"],
    "avg_driver_rating": RATING,
    "total_warehouses": N["warehouses"],
    "total_customers": N["customers"],
    "avg_speed": SPEED,
    "avg_fuel": FUEL,
    "total_deliveries": N["deliveries"],
    "total_incidents": N["incidents"],
}
SQL["kpi_fleet"] = long(FLEET)
SQL["kpi_realtime"] = long(REALTIME)
SQL["kpi_sql"] = long(TOTALS)
SQL["filtered_counts"] = long({"drivers_on_route": ON_ROUTE, "completed_deliveries": COMPLETED, "high_severity_incidents": HIGH})
SQL["global_averages"] = long({"avg_driver_rating": RATING, "avg_speed_kmh": SPEED, "avg_fuel_level_percent": FUEL})
KNOWN = one("COUNT(*)", "vehicles WHERE vehicle_id IN (SELECT vehicle_id FROM telemetry)")
SQL["active_vehicles"] = long(
    {"total_vehicles": N["vehicles"], "active_vehicles": ACTIVE, "active_known_vehicles": KNOWN,
     "utilization_percent": pct(ACTIVE, N["vehicles"], 2)}
)
SQL["kpi_snapshot"] = f"""SELECT kpi, value, {AS_OF} AS computed_at, TIMESTAMP '2024-01-31 00:05:00' AS expires_at
    FROM ({long(FLEET)})"""
SQL["kpi_lookup"] = f"""SELECT 'total_deliveries' AS kpi, CAST({N['deliveries']} AS DOUBLE) AS value,
    TIMESTAMP '2024-01-30 23:58:00' AS computed_at"""
BANDS = ", ".join(f"('{k}', {'NULL' if lo is None else lo}::DOUBLE, '{b}')" for k, lo, b in KPI_BANDS)
SQL["kpi_bands"] = f"""SELECT f.kpi, f.value, arg_max(b.band, COALESCE(b.low, '-infinity'::DOUBLE)) AS band
    FROM ({long(FLEET)}) f JOIN (VALUES {BANDS}) b(kpi, low, band) ON f.kpi = b.kpi AND (b.low IS NULL OR f.value >= b.low)
    GROUP BY f.kpi, f.value"""
PANELS = ", ".join(f"({n}, '{t}', '{k}')" for n, t, k in PANELS)
SQL["dashboard_feed"] = f"""SELECT p.panel, p.title, p.kpi, f.value, CASE WHEN p.panel = 9 THEN (SELECT
    string_agg(vehicle_type || '=' || n, ', ' ORDER BY vehicle_type) FROM
    (SELECT vehicle_type, COUNT(*) AS n FROM vehicles GROUP BY vehicle_type)) END AS detail
    FROM (VALUES {PANELS}) p(panel, title, kpi) LEFT JOIN ({long(FLEET)}) f ON f.kpi = p.kpi"""
SCORE = "CASE lower(severity) WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 END"
SQL["kpi_severity_score"] = f"""SELECT COUNT(*) AS incidents, COALESCE({rnd(davg(SCORE), 2)}, 0) AS avg_severity_score
    FROM incidents"""
DONE = "date_sub('minute', pickup_time, completion_time)"
SQL["kpi_on_time"] = f"""SELECT warehouse_id, COUNT(*) AS completed, COUNT(*) FILTER (WHERE on_time) AS on_time,
    {rnd(davg(DONE), 2)} AS avg_delivery_minutes,
    {rnd('COUNT(*) FILTER (WHERE on_time) / CAST(COUNT(*) AS DOUBLE) * 100', 2)} AS on_time_percent
    FROM deliveries WHERE completion_time IS NOT NULL GROUP BY warehouse_id"""
SPENT = "date_sub('minute', pickup_time, COALESCE(completion_time, estimated_delivery))"
SQL["kpi_delivery_variance"] = f"""SELECT status, COUNT({SPENT}) AS deliveries, {rnd(f'stddev_samp({SPENT})', 2)} AS
    stddev_minutes, {rnd(f'var_samp({SPENT})', 2)} AS variance_minutes FROM deliveries GROUP BY status"""
SQL["kpi_distance"] = f"""SELECT vehicle_id, {rnd(dsum('speed') + ' * 0.001::DOUBLE', 2)} AS speed_distance_km,
    {rnd('MAX(odometer) - MIN(odometer)', 2)} AS odometer_km FROM telemetry GROUP BY vehicle_id"""
SPAN = "MAX(fuel_level) - MIN(fuel_level)"
DAYS = 'COUNT(DISTINCT CAST("timestamp" AS DATE))'
SQL["kpi_fuel"] = f"""SELECT vehicle_id, {SPAN} AS fuel_span, {DAYS} AS days, {rnd(f'({SPAN}) / {DAYS}', 2)} AS avg_daily_fuel
    FROM telemetry GROUP BY vehicle_id"""
SQL["kpi_incident_rate"] = f"""SELECT vehicle_id, readings, COALESCE(n, 0) AS incidents,
    {pct('COALESCE(n, 0)', 'readings', 2, '1000')} AS per_1000_readings,
    {pct('COALESCE(n, 0)', 'km', 2, '1000')} AS per_1000_km FROM
    (SELECT vehicle_id, COUNT(*) AS readings, MAX(odometer) - MIN(odometer) AS km FROM telemetry GROUP BY 1)
    LEFT JOIN (SELECT vehicle_id, COUNT(*) AS n FROM incidents GROUP BY 1) USING (vehicle_id)"""
SQL["kpi_utilization_time"] = f"""SELECT vehicle_id, COUNT(*) AS readings, COUNT(*) FILTER (WHERE status = 'Moving') AS moving,
    {rnd("COUNT(*) FILTER (WHERE status = 'Moving') / CAST(COUNT(*) AS DOUBLE) * 100", 2)} AS utilization_percent
    FROM telemetry GROUP BY vehicle_id"""
Z = " + ".join(
    f"COALESCE(({t} - (SELECT {davg(t)} FROM terms)) / NULLIF((SELECT stddev_pop({t}) FROM terms), 0), 0) * {w}::DOUBLE"
    for t, w in SCORE_WEIGHTS.items()
)
SQL["kpi_driver_score"] = f"""WITH terms AS (SELECT d.driver_id, d.name, d.rating,
        COALESCE({rnd('CAST(i.n AS DOUBLE) / r.n * 1000', 6)}, 0) AS incident_rate,
        COALESCE({rnd('CAST(r.fast AS DOUBLE) / r.n', 6)}, 0) AS over_speed FROM drivers d
        LEFT JOIN (SELECT driver_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE speed > 120) AS fast FROM telemetry GROUP BY 1) r
            USING (driver_id)
        LEFT JOIN (SELECT driver_id, COUNT(*) AS n FROM incidents GROUP BY 1) i USING (driver_id))
    SELECT driver_id, name, rating, incident_rate, over_speed, {rnd(Z, 4)} AS score FROM terms"""
SQL["kpi_maintenance_age"] = """SELECT vehicle_id, last_maintenance,
    CAST(DATE '2024-01-31' - last_maintenance AS INTEGER) AS days_since FROM vehicles"""

# --- reports ----------------------------------------------------------------------------------------------


def performance(extra: str, where: str, having: str, order: str) -> str:
    return f"""SELECT d.driver_id, d.name AS driver_name, d.rating AS driver_rating, d.experience_years, v.vehicle_type,
    COUNT(t.vehicle_id) AS total_trips, {rnd(davg('t.speed'), 2)} AS avg_speed,
    {rnd(davg('t.fuel_level'), 2)} AS avg_fuel_remaining{extra} FROM drivers d JOIN telemetry t ON d.driver_id = t.driver_id
    JOIN vehicles v ON t.vehicle_id = v.vehicle_id WHERE t.speed > 0 {where}
    GROUP BY d.driver_id, d.name, d.rating, d.experience_years, v.vehicle_type HAVING {having} ORDER BY {order} LIMIT 20"""


SQL["showcase_q1"] = performance(
    f", {rnd(dsum('t.speed') + ' * 0.001::DOUBLE', 2)} AS total_distance_km",
    f"AND t.\"timestamp\" >= {LOOKBACK} AND d.status = 'OnRoute'",
    f"COUNT(t.vehicle_id) > 5 AND {davg('t.speed')} > 30",
    "driver_rating DESC, total_distance_km DESC, d.driver_id, v.vehicle_type",
)
SQL["showcase_q1_all"] = performance(
    "", "", f"COUNT(t.vehicle_id) > 5 AND {davg('t.speed')} > 20", "driver_rating DESC, d.driver_id, v.vehicle_type"
)
FROM_Q2 = """FROM warehouses w JOIN deliveries d ON w.warehouse_id = d.warehouse_id
    JOIN customers c ON d.customer_id = c.customer_id JOIN vehicles v ON d.vehicle_id = v.vehicle_id"""
SQL["showcase_q2"] = f"""SELECT w.warehouse_id, w.name AS warehouse_name, w.city AS warehouse_city, c.customer_type,
    COUNT(DISTINCT d.delivery_id) AS total_deliveries, {rnd(davg('d.distance_km'), 2)} AS avg_distance_km,
    {rnd(davg(MINUTES), 2)} AS avg_delivery_time_minutes, {rnd(davg('d.package_weight'), 2)} AS avg_package_weight,
    {rnd(f"{davg('d.distance_km')} / {davg(MINUTES)} * 60", 2)} AS avg_speed_kmh {FROM_Q2}
    WHERE d.status IN ('InProgress', 'Completed') AND d.pickup_time >= {LOOKBACK} AND d.distance_km > 0
    GROUP BY w.warehouse_id, w.name, w.city, c.customer_type
    HAVING COUNT(DISTINCT d.delivery_id) >= 5 AND {davg('d.distance_km')} > 10"""
SQL["showcase_q2_all"] = f"""SELECT w.warehouse_id, w.name AS warehouse_name, w.city, c.customer_type,
    COUNT(DISTINCT d.delivery_id) AS total_deliveries, {rnd(davg('d.distance_km'), 2)} AS avg_distance_km {FROM_Q2}
    WHERE d.distance_km > 0 GROUP BY w.warehouse_id, w.name, w.city, c.customer_type
    HAVING COUNT(DISTINCT d.delivery_id) >= 1"""
FROM_Q3 = """FROM vehicles v JOIN incidents i ON v.vehicle_id = i.vehicle_id
    LEFT JOIN drivers d ON i.driver_id = d.driver_id"""
SQL["showcase_q3"] = f"""SELECT v.vehicle_type, {levels('d.experience_years', *EXP4)} AS experience_level,
    COUNT(DISTINCT i.incident_id) AS total_incidents, COUNT(DISTINCT i.driver_id) AS unique_drivers,
    {rnd('COUNT(DISTINCT i.incident_id) / CAST(NULLIF(COUNT(DISTINCT i.driver_id), 0) AS DOUBLE)', 2)} AS incidents_per_driver,
    COUNT(*) FILTER (WHERE i.incident_type = 'harsh_braking') AS harsh_braking_count,
    COUNT(*) FILTER (WHERE i.incident_type = 'speeding') AS speeding_count,
    COUNT(*) FILTER (WHERE i.incident_type = 'harsh_acceleration') AS harsh_accel_count,
    COUNT(*) FILTER (WHERE lower(i.severity) = 'high') AS high_severity_count,
    {rnd("COUNT(*) FILTER (WHERE lower(i.severity) = 'high') * 100.0 / COUNT(*)", 2)} AS high_severity_percentage {FROM_Q3}
    WHERE i."timestamp" >= {LOOKBACK} GROUP BY 1, 2 HAVING COUNT(DISTINCT i.incident_id) >= 3"""
SQL["showcase_q3_all"] = f"""SELECT v.vehicle_type, {levels('d.experience_years', *EXP3)} AS experience_level,
    COUNT(DISTINCT i.incident_id) AS total_incidents {FROM_Q3} GROUP BY 1, 2"""
SQL["showcase_q4"] = f"""SELECT c.city, c.customer_type, {levels('v.capacity_kg', *CAP)} AS vehicle_capacity_class,
    COUNT(d.delivery_id) AS total_deliveries, {rnd(davg(MINUTES), 2)} AS avg_delivery_time_min,
    {rnd(f'stddev_samp({MINUTES})', 2)} AS delivery_time_variance, MIN({MINUTES}) AS min_delivery_time,
    MAX({MINUTES}) AS max_delivery_time, {rnd(davg('d.package_weight'), 2)} AS avg_package_weight,
    {rnd(davg('d.distance_km'), 2)} AS avg_distance FROM deliveries d JOIN customers c ON d.customer_id = c.customer_id
    JOIN vehicles v ON d.vehicle_id = v.vehicle_id JOIN drivers r ON d.driver_id = r.driver_id
    WHERE d.status = 'Completed' AND d.pickup_time >= {LOOKBACK} AND d.distance_km > 0 GROUP BY 1, 2, 3
    HAVING COUNT(d.delivery_id) >= 2 AND {davg(MINUTES)} > 0"""
SQL["showcase_q5"] = f"""SELECT v.make, v.vehicle_type, v.year, r.experience_years, w.city AS origin_city,
    COUNT(DISTINCT t.vehicle_id) AS unique_vehicles, COUNT(*) AS total_readings,
    {rnd(davg('t.fuel_level'), 2)} AS avg_fuel_level, {rnd(davg('t.speed'), 2)} AS avg_speed,
    {rnd(davg('t.engine_temp'), 2)} AS avg_engine_temp,
    {rnd('(MAX(t.fuel_level) - MIN(t.fuel_level)) / NULLIF(COUNT(DISTINCT CAST(t."timestamp" AS DATE)), 0)', 2)}
        AS avg_daily_fuel_consumption,
    {rnd(f"{davg('t.speed')} / NULLIF({davg('t.fuel_level')}, 0) * 100", 2)} AS fuel_efficiency_index,
    COUNT(*) FILTER (WHERE t.fuel_level < 20) AS low_fuel_instances
    FROM telemetry t JOIN vehicles v ON t.vehicle_id = v.vehicle_id LEFT JOIN drivers r ON t.driver_id = r.driver_id
    LEFT JOIN deliveries d ON t.vehicle_id = d.vehicle_id AND CAST(t."timestamp" AS DATE) = CAST(d.pickup_time AS DATE)
    LEFT JOIN warehouses w ON d.warehouse_id = w.warehouse_id
    WHERE t."timestamp" >= {LOOKBACK} AND t.speed > 0 AND t.fuel_level > 0 GROUP BY 1, 2, 3, 4, 5
    HAVING COUNT(*) >= 5 AND {davg('t.fuel_level')} > 10 AND COUNT(DISTINCT t.vehicle_id) >= 1
    ORDER BY fuel_efficiency_index DESC NULLS LAST, avg_daily_fuel_consumption ASC NULLS LAST, v.make, v.vehicle_type,
        v.year, r.experience_years NULLS LAST, origin_city NULLS LAST LIMIT 50"""
SQL["doc_q1"] = f"""SELECT d.name AS driver_name, d.rating AS driver_rating, v.vehicle_type,
    {rnd(davg('t.speed'), 4)} AS avg_speed, COUNT(i.incident_id) AS incident_count FROM telemetry t
    JOIN drivers d ON t.driver_id = d.driver_id JOIN vehicles v ON t.vehicle_id = v.vehicle_id LEFT JOIN {INTERVAL}
    WHERE t."timestamp" > {LOOKBACK} GROUP BY d.driver_id, d.name, d.rating, v.vehicle_type
    HAVING {davg('t.speed')} > 30 AND COUNT(i.incident_id) < 30 ORDER BY d.rating DESC, d.driver_id, v.vehicle_type LIMIT 10"""
SQL["doc_q2"] = f"""SELECT w.city AS origin_city, c.city AS destination_city, {rnd(davg('d.distance_km'), 4)} AS avg_distance,
    {rnd(davg('d.delivery_minutes'), 4)} AS avg_delivery_time,
    {rnd('COUNT(*) FILTER (WHERE d.on_time) * 100.0::DOUBLE / COUNT(*)', 4)} AS on_time_rate FROM deliveries d
    JOIN warehouses w ON d.warehouse_id = w.warehouse_id JOIN customers c ON d.customer_id = c.customer_id
    WHERE d.pickup_time > {LOOKBACK} GROUP BY 1, 2 HAVING COUNT(*) > 5"""
SQL["doc_q3"] = f"""SELECT v.vehicle_type, i.incident_type, i.severity, COUNT(*) AS incident_count,
    {rnd(davg('i.speed_at_incident'), 4)} AS avg_speed_at_incident FROM incidents i
    JOIN vehicles v ON i.vehicle_id = v.vehicle_id JOIN drivers d ON i.driver_id = d.driver_id
    WHERE i."timestamp" > {LOOKBACK} AND lower(i.severity) IN ('medium', 'high') GROUP BY 1, 2, 3 HAVING COUNT(*) > 2"""
SQL["doc_q4"] = f"""SELECT v.vehicle_type, t.road_type, {rnd(davg('t.fuel_level'), 4)} AS avg_fuel_level,
    {rnd(davg('t.speed'), 4)} AS avg_speed, COUNT(DISTINCT t.vehicle_id) AS vehicle_count FROM telemetry t
    JOIN vehicles v ON t.vehicle_id = v.vehicle_id WHERE t."timestamp" > {LOOKBACK} GROUP BY 1, 2
    HAVING {davg('t.fuel_level')} < 55"""
SQL["doc_q5"] = f"""SELECT {levels('r.experience_years', *EXP3S)} AS experience_level,
    COUNT(d.delivery_id) AS total_deliveries, {rnd(davg('d.delivery_minutes'), 4)} AS avg_delivery_time,
    {rnd('COUNT(*) FILTER (WHERE d.on_time) * 100.0::DOUBLE / COUNT(*)', 4)} AS success_rate FROM deliveries d
    JOIN drivers r ON d.driver_id = r.driver_id WHERE d.pickup_time > {LOOKBACK} GROUP BY 1 HAVING COUNT(d.delivery_id) > 10"""


def published(name: str, days: int, limits: dict[str, str]) -> str:
    """A report at its published span and limits: each lowered limit stands once in the twin above."""
    out = SQL[name].replace(LOOKBACK, f"TIMESTAMP '2024-01-31 00:00:00' - INTERVAL {days} DAYS")
    for lowered, limit in limits.items():
        assert out.count(lowered) == 1, (name, lowered)
        out = out.replace(lowered, limit)
    return out


for name, days, limits in (
    ("showcase_q1", 1, {"COUNT(t.vehicle_id) > 5": "COUNT(t.vehicle_id) > 100"}),
    ("showcase_q2", 7, {}),
    ("showcase_q3", 30, {}),
    ("showcase_q4", 14, {"COUNT(d.delivery_id) >= 2": "COUNT(d.delivery_id) >= 10"}),
    ("showcase_q5", 7, {"COUNT(*) >= 5": "COUNT(*) >= 100", "COUNT(DISTINCT t.vehicle_id) >= 1": "COUNT(DISTINCT t.vehicle_id) >= 2"}),
    ("doc_q1", 1, {"> 30 AND": "> 60 AND", "COUNT(i.incident_id) < 30": "COUNT(i.incident_id) < 3"}),
    ("doc_q2", 7, {}),
    ("doc_q3", 30, {}),
    ("doc_q4", 1, {"< 55": "< 30"}),
    ("doc_q5", 30, {}),
):
    SQL[f"{name}_published"] = published(name, days, limits)
SQL["incidents_formatted"] = f"""SELECT incident_id, strftime("timestamp", '%H:%M:%S') AS time,
    CAST(vehicle_id AS VARCHAR) AS vehicle, {TITLE} AS type,
    upper(severity[1]) || lower(severity[2:]) AS severity FROM incidents
    ORDER BY "timestamp" DESC, incident_id DESC LIMIT 10"""

# --- models --------------------------------------------------------------------------------------------------

TIME_CLASS = """(CASE WHEN hour("timestamp") BETWEEN 7 AND 9 THEN 'morning_rush'
    WHEN hour("timestamp") BETWEEN 10 AND 16 THEN 'midday' WHEN hour("timestamp") BETWEEN 17 AND 19 THEN 'evening_rush'
    ELSE 'night' END)"""
CONDITIONS = f"""(SELECT *, (['clear', 'rain', 'fog', 'dust', 'snow'])[CAST(fuel_level AS INTEGER) % 5 + 1] AS weather,
    (['light', 'moderate', 'heavy', 'congested'])[event_id % 4 + 1] AS traffic,
    CASE WHEN speed > 100 THEN 'aggressive' WHEN speed < 20 THEN 'cautious' ELSE 'normal' END AS behaviour,
    {TIME_CLASS} AS time_of_day FROM telemetry)"""
LEVEL = "CASE WHEN experience_years < 5 THEN 'Novice' WHEN experience_years < 10 THEN 'Intermediate' " \
    "WHEN experience_years < 15 THEN 'Expert' WHEN experience_years IS NOT NULL THEN 'Master' END"
RATE = "0.1::DOUBLE * " + " * ".join(case_of(name, table, "1.0::DOUBLE") for name, table in RISK.items())
RISKS = f"""(SELECT *, {rnd(RATE, 6)} AS rate FROM (SELECT t.*, {LEVEL} AS experience FROM {CONDITIONS} t
    LEFT JOIN drivers d ON t.driver_id = d.driver_id))"""
SQL["time_of_day"] = f"SELECT event_id, {TIME_CLASS} AS time_of_day FROM telemetry"
SQL["risk_rate"] = f"SELECT event_id, experience, weather, traffic, time_of_day, behaviour, rate FROM {RISKS}"
SQL["risk_expected"] = f"""SELECT driver_id, hours, expected, COALESCE(n, 0) AS observed FROM (
    SELECT driver_id, COUNT(*) AS hours, {rnd(dsum('rate'), 4)} AS expected FROM (
        SELECT driver_id, date_trunc('hour', "timestamp") AS hour, {davg('rate')} AS rate FROM {RISKS} GROUP BY 1, 2)
    GROUP BY driver_id) LEFT JOIN (SELECT driver_id, COUNT(*) AS n FROM incidents GROUP BY 1) USING (driver_id)"""
MU = " * ".join(
    [
        case_of("road_type", SPEED_MEAN, "45.0::DOUBLE"),
        case_of("time_of_day", SPEED_TIME, "1.0::DOUBLE"),
        case_of("weather", SPEED_WEATHER, "1.0::DOUBLE"),
        case_of("behaviour", SPEED_DRIVER, "1.0::DOUBLE"),
    ]
)
SIGMA = case_of("road_type", SPEED_STD, "10.0::DOUBLE") + \
    " * (CASE WHEN time_of_day IN ('morning_rush', 'evening_rush') THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END)"
SQL["speed_zscore"] = f"""SELECT event_id, vehicle_id, speed, {rnd(MU, 4)} AS expected_speed, {rnd(SIGMA, 4)} AS expected_std,
    {rnd(f'(speed - {MU}) / ({SIGMA})', 4)} AS z_score FROM {CONDITIONS}"""
RPM = """CAST(CASE WHEN speed IS NOT NULL THEN LEAST(floor(CASE WHEN speed < 20 THEN speed * 40 + 800 WHEN speed < 60 THEN (speed - 20) * 25 + 1500
    ELSE (speed - 60) * 15 + 2500 END), 4500) END AS INTEGER)"""
LITRES = """GREATEST(2, LEAST(30, 8 + (speed / 100) * (speed / 100) * 3 + (CAST(rpm2 AS DOUBLE) / 1000) * 0.5::DOUBLE
    + LEAST(100, fuel_level) / 100 * 4 + CASE WHEN engine_temp < 85 THEN (85 - engine_temp) * 0.05::DOUBLE ELSE 0 END))"""
SQL["fuel_rate"] = f"""SELECT event_id, rpm2 AS rpm, CASE WHEN speed IS NOT NULL THEN {rnd(LITRES, 2)} END AS litres_per_hour FROM
    (SELECT *, {RPM} AS rpm2 FROM telemetry)"""


def log_density(state: str) -> str:
    (m1, s1), (m2, s2) = DRIVER_STATES[state]
    return (
        f"(-0.5::DOUBLE * power((dev - {m1}::DOUBLE) / {s1}::DOUBLE, 2) - ln({s1}::DOUBLE)"
        f" - 0.5::DOUBLE * power((rea - {m2}::DOUBLE) / {s2}::DOUBLE, 2) - ln({s2}::DOUBLE))"
    )


STATES = ("normal", "aggressive", "tired")
SQL["driver_state"] = f"""SELECT event_id, p_normal, p_aggressive, p_tired,
    CASE WHEN p_normal >= p_aggressive AND p_normal >= p_tired THEN 'normal'
         WHEN p_aggressive >= p_tired THEN 'aggressive' WHEN p_tired IS NOT NULL THEN 'tired' END AS state FROM (
    SELECT event_id, {", ".join(rnd(f'exp(l_{s} - top) / (exp(l_normal - top) + exp(l_aggressive - top) + exp(l_tired - top))', 6)
                               + f' AS p_{s}' for s in STATES)} FROM (
    SELECT *, GREATEST(l_normal, l_aggressive, l_tired) AS top FROM (
    SELECT event_id, {", ".join(f'{log_density(s)} AS l_{s}' for s in STATES)} FROM (
    SELECT event_id, speed - 50 AS dev, fuel_level * 12 + 300 AS rea FROM telemetry))))"""


DRIVER_MOVES = {
    "normal": {"normal": 0.85, "aggressive": 0.1, "tired": 0.05},
    "aggressive": {"normal": 0.3, "aggressive": 0.6, "tired": 0.1},
    "tired": {"normal": 0.2, "aggressive": 0.05, "tired": 0.75},
}
CHANGES = "(CASE " + " ".join(
    f"WHEN prev = '{a}' AND state = '{b}' THEN {p}::DOUBLE" for a, row in DRIVER_MOVES.items() for b, p in row.items()
) + " END)"
SQL["driver_transitions"] = f"""SELECT prev AS from_state, state AS to_state, COUNT(*) AS moves,
    {rnd('COUNT(*) / CAST(SUM(COUNT(*)) OVER (PARTITION BY prev) AS DOUBLE)', 4)} AS observed, ANY_VALUE({CHANGES}) AS configured
    FROM (SELECT state, lag(state) OVER (PARTITION BY driver_id ORDER BY "timestamp", event_id) AS prev
          FROM ({SQL['driver_state']}) JOIN telemetry USING (event_id) WHERE state IS NOT NULL)
    WHERE prev IS NOT NULL GROUP BY prev, state"""
SQL["hourly_aggregations"] = f"""SELECT COALESCE(h.vehicle_id, i.vehicle_id) AS vehicle_id,
    COALESCE(h.time_bucket, i.time_bucket) AS time_bucket, h.avg_speed, h.max_speed, COALESCE(h.distance_km, 0.0) AS distance_km,
    COALESCE(h.fuel_used, 0.0) AS fuel_used, COALESCE(i.n, 0) AS incident_count FROM (
    SELECT vehicle_id, date_trunc('hour', "timestamp") AS time_bucket, {rnd(davg('speed'), 2)} AS avg_speed,
        {rnd('MAX(speed)', 2)} AS max_speed, COALESCE({rnd(dsum('km'), 3)}, 0.0) AS distance_km,
        COALESCE({rnd(dsum('used'), 2)}, 0.0) AS fuel_used
    FROM (SELECT *, {haversine('plat', 'plon', 'latitude', 'longitude')} AS km,
              CASE WHEN pfuel IS NOT NULL AND fuel_level IS NOT NULL THEN GREATEST(pfuel - fuel_level, 0) END AS used
          FROM (SELECT *, lag(latitude) {BY_TIME} AS plat, lag(longitude) {BY_TIME} AS plon,
                    lag(fuel_level) {BY_TIME} AS pfuel FROM telemetry))
    GROUP BY ALL) h
    FULL JOIN (SELECT vehicle_id, date_trunc('hour', "timestamp") AS time_bucket, COUNT(*) AS n FROM incidents GROUP BY ALL) i
    ON i.vehicle_id IS NOT DISTINCT FROM h.vehicle_id AND i.time_bucket = h.time_bucket"""


def oracle_sql() -> dict[str, str]:
    out = {}
    for name, body in SQL.items():
        text = with_views(body)
        # A body with its own WITH continues the list of views.
        if text.startswith("WITH ") and body.startswith("WITH "):
            text = text[: -len(body)].rstrip() + ",\n" + body[len("WITH "):]
        out[name] = text
    return out
