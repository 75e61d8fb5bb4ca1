"""Star-join reports over vehicles, drivers, warehouses, customers and the three fact tables.

Facts are filtered and, where every measure can be merged, aggregated by their
foreign keys before they meet a dimension. Sort orders end in a unique key, so
a row limit always returns the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions.labels import (
    CAPACITY,
    EXPERIENCE_3,
    EXPERIENCE_3_SHORT,
    EXPERIENCE_4,
    bucket,
    capital_text,
    title_text,
)
from haulmark.functions.numeric import avg_parts, merged_avg, merged_sum, steady_avg
from haulmark.functions.timing import before, clock_text, day_before, minutes_between
from haulmark.operators.joins import deliveries_by_vehicle_day, interval_counts


def _merged_count(name: str = "rows", weight: Column | None = None) -> Column:
    return F.sum(F.col(name) if weight is None else F.col(name) * weight)


def _by_keys(df: DataFrame, keys: list, measures: list[str]) -> DataFrame:
    """Facts aggregated by their foreign keys, in a form that merges later."""
    parts = [p for m in measures for p in avg_parts(m, F.col(m))]
    return df.groupBy(*keys).agg(F.count("*").alias("rows"), *parts)


def driver_performance(
    s,
    cutoff: Column | None,
    min_readings: int = 100,
    min_speed: float = 30,
    limit: int | None = 20,
    status: str | None = "OnRoute",
) -> DataFrame:
    """Drivers by vehicle type: readings, mean speed, mean fuel and distance."""
    t = s.telemetry.filter(F.col("speed") > 0)
    if cutoff is not None:
        t = t.filter(F.col("timestamp") >= cutoff)
    pre = _by_keys(t, ["driver_id", "vehicle_id"], ["speed", "fuel_level"])
    d = s.drivers if status is None else s.drivers.filter(F.col("status") == status)
    out = (
        pre.join(d.select("driver_id", "name", "rating", "experience_years"), "driver_id")
        .join(s.vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id")
        .groupBy(
            "driver_id",
            F.col("name").alias("driver_name"),
            F.col("rating").alias("driver_rating"),
            "experience_years",
            "vehicle_type",
        )
        .agg(
            _merged_count().alias("total_trips"),
            merged_avg("speed").alias("speed"),
            F.round(merged_avg("fuel_level"), 2).alias("avg_fuel_remaining"),
            F.round(merged_sum("speed") * 0.001, 2).alias("total_distance_km"),
        )
        .filter((F.col("total_trips") > min_readings) & (F.col("speed") > min_speed))
        .withColumn("avg_speed", F.round("speed", 2))
        .drop("speed")
    )
    order = [F.desc("driver_rating"), F.desc("total_distance_km"), F.asc("driver_id"), F.asc("vehicle_type")]
    return out.orderBy(*order) if limit is None else out.orderBy(*order).limit(limit)


def driver_performance_all(s) -> DataFrame:
    """All-time variant: more than 5 readings, mean speed above 20, every driver status."""
    out = driver_performance(s, None, 5, 20, None, None).drop("total_distance_km")
    return out.orderBy(F.desc("driver_rating"), F.asc("driver_id"), F.asc("vehicle_type")).limit(20)


def route_efficiency(s, cutoff: Column, min_deliveries: int = 5, min_distance: float = 10) -> DataFrame:
    """Deliveries by warehouse and customer type."""
    d = s.deliveries.filter(
        F.col("status").isin("InProgress", "Completed") & (F.col("pickup_time") >= cutoff) & (F.col("distance_km") > 0)
    )
    minutes = minutes_between(F.col("pickup_time"), F.col("estimated_delivery")).cast("double")
    wh = s.warehouses.select("warehouse_id", F.col("name").alias("warehouse_name"), F.col("city").alias("warehouse_city"))
    return (
        d.withColumn("minutes", minutes)
        .join(wh, "warehouse_id")
        .join(s.customers.select("customer_id", "customer_type"), "customer_id")
        .join(s.vehicles.select("vehicle_id"), "vehicle_id")
        .groupBy("warehouse_id", "warehouse_name", "warehouse_city", "customer_type")
        .agg(
            F.count_distinct("delivery_id").alias("total_deliveries"),
            steady_avg(F.col("distance_km")).alias("distance"),
            steady_avg(F.col("minutes")).alias("minutes"),
            F.round(steady_avg(F.col("package_weight")), 2).alias("avg_package_weight"),
        )
        .filter((F.col("total_deliveries") >= min_deliveries) & (F.col("distance") > min_distance))
        .withColumns(
            {
                "avg_distance_km": F.round("distance", 2),
                "avg_delivery_time_minutes": F.round("minutes", 2),
                "avg_speed_kmh": F.round(F.try_divide(F.col("distance"), F.col("minutes")) * 60, 2),
            }
        )
        .drop("distance", "minutes")
        .orderBy(F.desc_nulls_last("avg_speed_kmh"), F.desc("total_deliveries"), "warehouse_id", "customer_type")
    )


def route_efficiency_all(s) -> DataFrame:
    """All-time variant without thresholds on distance or time."""
    wh = s.warehouses.select("warehouse_id", F.col("name").alias("warehouse_name"), "city")
    return (
        s.deliveries.filter(F.col("distance_km") > 0)
        .join(wh, "warehouse_id")
        .join(s.customers.select("customer_id", "customer_type"), "customer_id")
        .join(s.vehicles.select("vehicle_id"), "vehicle_id")
        .groupBy("warehouse_id", "warehouse_name", "city", "customer_type")
        .agg(
            F.count_distinct("delivery_id").alias("total_deliveries"),
            F.round(steady_avg(F.col("distance_km")), 2).alias("avg_distance_km"),
        )
        .filter(F.col("total_deliveries") >= 1)
        .orderBy(F.desc("total_deliveries"), "warehouse_id", "customer_type")
    )


def incident_analysis(s, cutoff: Column, min_incidents: int = 3, unknown: str | None = None) -> DataFrame:
    """Incidents by vehicle type and driver experience.

    Drivers without a row count as the last experience level, as in the SQL
    CASE, unless a label for them is given.
    """
    level = bucket(F.col("experience_years"), EXPERIENCE_4, unknown)
    kind = lambda name: F.count_if(F.col("incident_type") == name)
    high = F.count_if(F.lower("severity") == "high")
    out = (
        s.incidents.filter(F.col("timestamp") >= cutoff)
        .join(s.vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id")
        .join(s.drivers.select("driver_id", "experience_years"), "driver_id", "left")
        .groupBy("vehicle_type", level.alias("experience_level"))
        .agg(
            F.count_distinct("incident_id").alias("total_incidents"),
            F.count_distinct("driver_id").alias("unique_drivers"),
            kind("harsh_braking").alias("harsh_braking_count"),
            kind("speeding").alias("speeding_count"),
            kind("harsh_acceleration").alias("harsh_accel_count"),
            high.alias("high_severity_count"),
            F.round(high * 100.0 / F.count("*"), 2).alias("high_severity_percentage"),
        )
    )
    return (
        out.filter(F.col("total_incidents") >= min_incidents)
        .withColumn(
            "incidents_per_driver", F.round(F.try_divide(F.col("total_incidents") * 1.0, F.col("unique_drivers")), 2)
        )
        .withColumns({c: F.col(c).cast("double") for c in ("incidents_per_driver", "high_severity_percentage")})
        .orderBy(
            F.desc_nulls_last("incidents_per_driver"),
            F.desc("high_severity_percentage"),
            "vehicle_type",
            "experience_level",
        )
    )


def incident_analysis_all(s) -> DataFrame:
    return (
        s.incidents.join(s.vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id")
        .join(s.drivers.select("driver_id", "experience_years"), "driver_id", "left")
        .groupBy("vehicle_type", bucket(F.col("experience_years"), EXPERIENCE_3).alias("experience_level"))
        .agg(F.count_distinct("incident_id").alias("total_incidents"))
        .orderBy(F.desc("total_incidents"), "vehicle_type", "experience_level")
    )


def delivery_spread(s, cutoff: Column, min_deliveries: int = 10) -> DataFrame:
    """Spread of planned delivery time by city, customer type and capacity class."""
    d = s.deliveries.filter(
        (F.col("status") == "Completed") & (F.col("pickup_time") >= cutoff) & (F.col("distance_km") > 0)
    ).withColumn("minutes", minutes_between(F.col("pickup_time"), F.col("estimated_delivery")))
    m = F.col("minutes")
    return (
        d.join(s.customers.select("customer_id", "city", "customer_type"), "customer_id")
        .join(s.vehicles.select("vehicle_id", "capacity_kg"), "vehicle_id")
        .join(s.drivers.select("driver_id"), "driver_id")
        .groupBy("city", "customer_type", bucket(F.col("capacity_kg"), CAPACITY).alias("vehicle_capacity_class"))
        .agg(
            F.count("delivery_id").alias("total_deliveries"),
            steady_avg(m.cast("double")).alias("mean"),
            F.round(F.stddev_samp(m), 2).alias("delivery_time_variance"),
            F.min(m).alias("min_delivery_time"),
            F.max(m).alias("max_delivery_time"),
            F.round(steady_avg(F.col("package_weight")), 2).alias("avg_package_weight"),
            F.round(steady_avg(F.col("distance_km")), 2).alias("avg_distance"),
        )
        .filter((F.col("total_deliveries") >= min_deliveries) & (F.col("mean") > 0))
        .withColumn("avg_delivery_time_min", F.round("mean", 2))
        .drop("mean")
        .orderBy(
            F.desc_nulls_last("delivery_time_variance"),
            "avg_delivery_time_min",
            "city",
            "customer_type",
            "vehicle_capacity_class",
        )
    )


def readings_per_vehicle_day(readings: DataFrame) -> DataFrame:
    """Readings aggregated by vehicle, driver and day, in a form that merges later."""
    measures = ["fuel_level", "speed", "engine_temp"]
    parts = [p for m in measures for p in avg_parts(m, F.col(m))]
    return readings.groupBy("vehicle_id", "driver_id", F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("rows"),
        *parts,
        F.max("fuel_level").alias("fuel_max"),
        F.min("fuel_level").alias("fuel_min"),
        F.count_if(F.col("fuel_level") < 20).alias("low_fuel"),
    )


def fuel_pattern(
    s, cutoff: Column, min_readings: int = 100, min_fuel: float = 10, min_vehicles: int = 2, limit: int = 50
) -> DataFrame:
    """Fuel use by make, type, year, driver experience and origin city.

    A reading counts once per delivery of its vehicle on the same day. Both
    sides are aggregated per vehicle and day, and the number of deliveries acts
    as a weight, so the pairs themselves are never built.
    """
    t = s.telemetry.filter(
        (F.col("timestamp") >= cutoff) & (F.col("speed") > 0) & (F.col("fuel_level") > 0)
    )
    # Only deliveries of the days read can match.
    d = s.deliveries.filter(F.col("pickup_time") >= F.date_trunc("day", cutoff))
    days = deliveries_by_vehicle_day(d, s.warehouses)
    weight = F.coalesce("matches", F.lit(1))
    fuel, speed = merged_avg("fuel_level", weight), merged_avg("speed", weight)
    span = F.max("fuel_max") - F.min("fuel_min")
    return (
        readings_per_vehicle_day(t)
        .join(days, ["vehicle_id", "day"], "left")
        .join(s.vehicles.select("vehicle_id", "make", "vehicle_type", "year"), "vehicle_id")
        .join(s.drivers.select("driver_id", "experience_years"), "driver_id", "left")
        .groupBy("make", "vehicle_type", "year", "experience_years", "origin_city")
        .agg(
            F.count_distinct("vehicle_id").alias("unique_vehicles"),
            _merged_count("rows", weight).alias("total_readings"),
            fuel.alias("fuel"),
            F.round(fuel, 2).alias("avg_fuel_level"),
            F.round(speed, 2).alias("avg_speed"),
            F.round(merged_avg("engine_temp", weight), 2).alias("avg_engine_temp"),
            # a set of days, bounded by the lookback; a second distinct count would copy every row once more
            F.round(F.try_divide(span, F.size(F.collect_set("day"))), 2).alias("avg_daily_fuel_consumption"),
            F.round(F.try_divide(speed, fuel) * 100, 2).alias("fuel_efficiency_index"),
            _merged_count("low_fuel", weight).alias("low_fuel_instances"),
        )
        .filter(
            (F.col("total_readings") >= min_readings)
            & (F.col("fuel") > min_fuel)
            & (F.col("unique_vehicles") >= min_vehicles)
        )
        .drop("fuel")
        .orderBy(
            F.desc_nulls_last("fuel_efficiency_index"),
            F.asc_nulls_last("avg_daily_fuel_consumption"),
            "make",
            "vehicle_type",
            "year",
            F.asc_nulls_last("experience_years"),
            F.asc_nulls_last("origin_city"),
        )
        .limit(limit)
    )


def drivers_with_incidents(
    s, cutoff: Column, min_speed: float = 60, max_incidents: int = 3, limit: int = 10
) -> DataFrame:
    """Drivers by rating with mean speed and incidents in the hour before each reading.

    As in the left interval join, a reading counts once per incident, at least once.
    """
    t = s.telemetry.filter(F.col("timestamp") > cutoff)
    # A reading looks back one hour, so incidents before the cutoff may still count.
    i = s.incidents.filter(F.col("timestamp") >= cutoff - F.expr("INTERVAL 1 HOUR"))
    counted = interval_counts(t, i, columns=["vehicle_id", "speed"])
    weight = F.greatest(F.col("incidents"), F.lit(1))
    pre = counted.groupBy("driver_id", "vehicle_id").agg(
        F.sum("incidents").alias("incidents"), *avg_parts("speed", F.col("speed"), weight)
    )
    return (
        pre.join(s.drivers.select("driver_id", "name", "rating"), "driver_id")
        .join(s.vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id")
        .groupBy("driver_id", "name", "rating", "vehicle_type")
        .agg(merged_avg("speed").alias("speed"), F.sum("incidents").alias("incident_count"))
        .filter((F.col("speed") > min_speed) & (F.col("incident_count") < max_incidents))
        .orderBy(F.desc("rating"), "driver_id", "vehicle_type")
        .limit(limit)
        .select(
            F.col("name").alias("driver_name"),
            F.col("rating").alias("driver_rating"),
            "vehicle_type",
            F.round("speed", 4).alias("avg_speed"),
            "incident_count",
        )
    )


def city_routes(s, cutoff: Column, min_deliveries: int = 5) -> DataFrame:
    """City to city: mean distance, mean time and on-time share."""
    d = s.deliveries.filter(F.col("pickup_time") > cutoff).withColumn(
        "delivery_minutes", F.col("delivery_minutes").cast("double")
    )
    parts = [p for m in ("distance_km", "delivery_minutes") for p in avg_parts(m, F.col(m))]
    pre = d.groupBy("warehouse_id", "customer_id").agg(
        F.count("*").alias("rows"), F.count_if(F.col("on_time")).alias("on_time"), *parts
    )
    return (
        pre.join(s.warehouses.select("warehouse_id", F.col("city").alias("origin_city")), "warehouse_id")
        .join(s.customers.select("customer_id", F.col("city").alias("destination_city")), "customer_id")
        .groupBy("origin_city", "destination_city")
        .agg(
            F.round(merged_avg("distance_km"), 4).alias("avg_distance"),
            F.round(merged_avg("delivery_minutes"), 4).alias("avg_delivery_time"),
            F.round(F.sum("on_time") * F.lit(100.0) / F.sum("rows"), 4).alias("on_time_rate"),
            F.sum("rows").alias("rows"),
        )
        .filter(F.col("rows") > min_deliveries)
        .drop("rows")
        .orderBy(F.desc("on_time_rate"), "origin_city", "destination_city")
    )


def incidents_by_severity(s, cutoff: Column, min_incidents: int = 2) -> DataFrame:
    """Medium and high incidents by vehicle type, incident type and severity."""
    i = s.incidents.filter((F.col("timestamp") > cutoff) & F.lower("severity").isin("medium", "high"))
    pre = _by_keys(i, ["vehicle_id", "driver_id", "incident_type", "severity"], ["speed_at_incident"])
    return (
        pre.join(s.vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id")
        .join(s.drivers.select("driver_id"), "driver_id")
        .groupBy("vehicle_type", "incident_type", "severity")
        .agg(
            _merged_count().alias("incident_count"),
            F.round(merged_avg("speed_at_incident"), 4).alias("avg_speed_at_incident"),
        )
        .filter(F.col("incident_count") > min_incidents)
        .orderBy(F.desc("incident_count"), "vehicle_type", "incident_type", "severity")
    )


def low_fuel_by_road(s, cutoff: Column, max_fuel: float = 30) -> DataFrame:
    """Mean fuel and speed by vehicle type and road type where fuel is low."""
    t = s.telemetry.filter(F.col("timestamp") > cutoff)
    pre = _by_keys(t, ["vehicle_id", "road_type"], ["fuel_level", "speed"])
    fuel = merged_avg("fuel_level")
    return (
        pre.join(s.vehicles.select("vehicle_id", "vehicle_type"), "vehicle_id")
        .groupBy("vehicle_type", "road_type")
        .agg(
            fuel.alias("fuel"),
            F.round(fuel, 4).alias("avg_fuel_level"),
            F.round(merged_avg("speed"), 4).alias("avg_speed"),
            F.count_distinct("vehicle_id").alias("vehicle_count"),
        )
        .filter(F.col("fuel") < max_fuel)
        .drop("fuel")
        .orderBy("avg_fuel_level", "vehicle_type", "road_type")
    )


def delivery_by_experience(s, cutoff: Column, min_deliveries: int = 10) -> DataFrame:
    """Deliveries, mean time and on-time share by driver experience."""
    d = s.deliveries.filter(F.col("pickup_time") > cutoff).withColumn(
        "delivery_minutes", F.col("delivery_minutes").cast("double")
    )
    pre = d.groupBy("driver_id").agg(
        F.count("delivery_id").alias("n"),
        F.count("*").alias("rows"),
        F.count_if(F.col("on_time")).alias("on_time"),
        *avg_parts("delivery_minutes", F.col("delivery_minutes")),
    )
    return (
        pre.join(s.drivers.select("driver_id", "experience_years"), "driver_id")
        .groupBy(bucket(F.col("experience_years"), EXPERIENCE_3_SHORT).alias("experience_level"))
        .agg(
            F.sum("n").alias("total_deliveries"),
            F.round(merged_avg("delivery_minutes"), 4).alias("avg_delivery_time"),
            F.round(F.sum("on_time") * F.lit(100.0) / F.sum("rows"), 4).alias("success_rate"),
        )
        .filter(F.col("total_deliveries") > min_deliveries)
        .orderBy(F.desc("success_rate"), "experience_level")
    )


def incidents_formatted(s, n: int = 10) -> DataFrame:
    """Newest incidents as display text."""
    return (
        s.incidents.orderBy(F.desc("timestamp"), F.desc("incident_id"))
        .limit(n)
        .select(
            "incident_id",
            clock_text(F.col("timestamp")).alias("time"),
            F.coalesce(F.col("vehicle_id").cast("string"), F.lit("N/A")).alias("vehicle"),
            title_text(F.col("incident_type")).alias("type"),
            capital_text(F.col("severity")).alias("severity"),
        )
    )


def vehicle_day_join(s) -> DataFrame:
    """Readings per vehicle and day with the rows a join on (vehicle, day) would give."""
    days = s.telemetry.groupBy("vehicle_id", F.to_date("timestamp").alias("day")).agg(F.count("*").alias("readings"))
    matches = F.coalesce("matches", F.lit(0))
    return days.join(deliveries_by_vehicle_day(s.deliveries), ["vehicle_id", "day"], "left").select(
        "vehicle_id",
        "day",
        "readings",
        matches.alias("deliveries"),
        (F.col("readings") * F.greatest(matches, F.lit(1))).alias("joined_rows"),
    )


def origin_chain_join(s) -> DataFrame:
    """Joined rows per origin city when readings reach warehouses through the day's deliveries."""
    days = s.telemetry.groupBy("vehicle_id", F.to_date("timestamp").alias("day")).agg(F.count("*").alias("readings"))
    joined = days.join(deliveries_by_vehicle_day(s.deliveries, s.warehouses), ["vehicle_id", "day"], "left")
    return joined.groupBy("origin_city").agg(
        F.sum(F.col("readings") * F.coalesce("matches", F.lit(1))).alias("joined_rows"),
        F.count_distinct("vehicle_id").alias("vehicles"),
    )


def last_hours(as_of: str, hours: int) -> Column:
    return before(as_of, hours=hours)


def last_days(as_of: str, days: int) -> Column:
    return day_before(as_of, days)
