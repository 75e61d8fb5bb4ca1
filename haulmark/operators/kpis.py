"""KPI sets in long format (kpi, value) and per-entity KPI tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.functions.labels import severity_score
from haulmark.functions.numeric import ratio, steady_avg, steady_sum
from haulmark.functions.timing import at, before, minutes_between
from haulmark.operators.joins import union_all
from haulmark.operators.rollups import mean_of_minutes


def _long(row: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One row of figures to (kpi, value) lines."""
    pairs = [
        F.struct(F.lit(n).alias("kpi"), F.col(n).cast("double").alias("value")) for n in (names or row.columns)
    ]
    return row.select(F.inline(F.array(*pairs)))


def _one_row(parts: list[DataFrame]) -> DataFrame:
    """Figures of several one-row results side by side; every part is read once."""
    names = [c for p in parts for c in p.columns]
    lines = union_all([_long(p) for p in parts])
    return lines.agg(*[F.max(F.when(F.col("kpi") == n, F.col("value"))).alias(n) for n in names])


def _mean(c: Column, digits: int = 2) -> Column:
    return F.coalesce(F.round(steady_avg(c), digits), F.lit(0.0))


def _percent(num: str, den: str, digits: int = 2, factor: float = 100.0) -> Column:
    return F.round(ratio(F.col(num), F.col(den), factor), digits)


def kpi_fleet(s) -> DataFrame:
    """14 figures over all data; one aggregate per table."""
    speed = F.col("speed")
    row = _one_row(
        [
            s.vehicles.agg(F.count("*").alias("total_vehicles")),
            s.drivers.agg(
                F.count("*").alias("total_drivers"),
                F.count_if(F.col("status") == "OnRoute").alias("drivers_on_route"),
                _mean(F.col("rating")).alias("avg_driver_rating"),
            ),
            s.telemetry.agg(
                F.count_distinct("vehicle_id").alias("active_vehicles"),
                F.count("*").alias("readings"),
                _mean(F.when(speed > 0, speed)).alias("avg_speed_kmh"),
                _mean(F.col("fuel_level")).alias("avg_fuel_level_percent"),
            ),
            s.deliveries.agg(
                F.count("*").alias("total_deliveries"),
                F.count_if(F.col("status") == "Completed").alias("completed_deliveries"),
            ),
            s.incidents.agg(
                F.count("*").alias("total_incidents"),
                F.count_if(F.lower("severity") == "high").alias("high_severity_incidents"),
            ),
        ]
    ).withColumns(
        {
            "fleet_utilization_percent": _percent("active_vehicles", "total_vehicles"),
            "delivery_success_rate_percent": _percent("completed_deliveries", "total_deliveries"),
            "incident_rate_per_1000": _percent("total_incidents", "readings", factor=1000.0),
        }
    )
    return _long(row.drop("readings"))


def kpi_realtime(s, as_of: str) -> DataFrame:
    """10 figures of the moment: last minutes, open deliveries, means of minute means."""
    means = mean_of_minutes(s.telemetry, ["speed", "fuel_level"], as_of)
    open_states = ["InProgress", "Pending"]
    row = _one_row(
        [
            s.vehicles.agg(F.count("*").alias("total_vehicles")),
            s.telemetry.filter(F.col("timestamp") >= before(as_of, minutes=5)).agg(
                F.count_distinct("vehicle_id").alias("active_vehicles")
            ),
            s.deliveries.agg(
                F.count("*").alias("total_deliveries"),
                F.count_if(F.col("status") == "Completed").alias("completed"),
                F.count_distinct(F.when(F.col("status").isin(open_states), F.col("driver_id"))).alias("drivers_on_route"),
            ),
            s.incidents.agg(F.count("*").alias("total_incidents")),
            s.drivers.agg(_mean(F.col("rating")).alias("avg_driver_rating")),
            means.select(
                F.coalesce(F.round("avg_speed", 1), F.lit(0.0)).alias("avg_speed_kmh"),
                F.coalesce(F.round("avg_fuel_level", 1), F.lit(0.0)).alias("avg_fuel_level_percent"),
            ),
        ]
    ).withColumns(
        {
            "fleet_utilization_percent": _percent("active_vehicles", "total_vehicles", 1),
            "delivery_success_rate_percent": _percent("completed", "total_deliveries", 1),
        }
    )
    return _long(row.drop("completed"))


def _figures(s, entity: str, **figures: Column) -> DataFrame:
    """Figures of one table, 0 for all if the table does not exist."""
    try:
        table = getattr(s, entity)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return s.spark.range(1).select(*[F.lit(0).alias(name) for name in figures])
    return table.agg(*[c.alias(name) for name, c in figures.items()])


def kpi_sql(s) -> DataFrame:
    """9 totals and means over the registered views; a missing table counts 0."""
    speed, rows = F.col("speed"), F.count("*")
    return _long(
        _one_row(
            [
                _figures(s, "vehicles", total_vehicles=rows),
                _figures(s, "drivers", total_drivers=rows, avg_driver_rating=_mean(F.col("rating"))),
                _figures(s, "warehouses", total_warehouses=rows),
                _figures(s, "customers", total_customers=rows),
                _figures(s, "telemetry", avg_speed=_mean(F.when(speed > 0, speed)), avg_fuel=_mean(F.col("fuel_level"))),
                _figures(s, "deliveries", total_deliveries=rows),
                _figures(s, "incidents", total_incidents=rows),
            ]
        )
    )


def filtered_counts(s) -> DataFrame:
    return _long(
        _one_row(
            [
                s.drivers.agg(F.count_if(F.col("status") == "OnRoute").alias("drivers_on_route")),
                s.deliveries.agg(F.count_if(F.col("status") == "Completed").alias("completed_deliveries")),
                s.incidents.agg(F.count_if(F.lower("severity") == "high").alias("high_severity_incidents")),
            ]
        )
    )


def global_averages(s) -> DataFrame:
    """Plain means; 0 for an empty table."""
    speed = F.col("speed")
    return _long(
        _one_row(
            [
                s.drivers.agg(_mean(F.col("rating")).alias("avg_driver_rating")),
                s.telemetry.agg(
                    _mean(F.when(speed > 0, speed)).alias("avg_speed_kmh"),
                    _mean(F.col("fuel_level")).alias("avg_fuel_level_percent"),
                ),
            ]
        )
    )


def active_vehicles(s) -> DataFrame:
    """Known vehicles, those ever seen in telemetry, and the share."""
    row = _one_row(
        [
            s.vehicles.agg(F.count("*").alias("total_vehicles")),
            s.telemetry.agg(F.count_distinct("vehicle_id").alias("active_vehicles")),
            s.vehicles.join(s.telemetry.select("vehicle_id").distinct(), "vehicle_id", "left_semi").agg(
                F.count("*").alias("active_known_vehicles")
            ),
        ]
    )
    return _long(row.withColumn("utilization_percent", _percent("active_vehicles", "total_vehicles")))


def severity_score_kpi(s) -> DataFrame:
    score = severity_score(F.col("severity"))
    return s.incidents.agg(F.count("*").alias("incidents"), _mean(score.cast("double")).alias("avg_severity_score"))


def on_time_kpi(s) -> DataFrame:
    """On-time share of completed deliveries and mean delivery time per origin."""
    done = s.deliveries.filter(F.col("completion_time").isNotNull())
    per = done.groupBy("warehouse_id").agg(
        F.count("*").alias("completed"),
        F.count_if(F.col("on_time")).alias("on_time"),
        F.round(steady_avg(minutes_between(F.col("pickup_time"), F.col("completion_time")).cast("double")), 2).alias(
            "avg_delivery_minutes"
        ),
    )
    return per.withColumn("on_time_percent", _percent("on_time", "completed"))


def delivery_variance_kpi(s) -> DataFrame:
    """Sample deviation and variance of delivery minutes per status."""
    minutes = minutes_between(F.col("pickup_time"), F.coalesce("completion_time", "estimated_delivery"))
    return (
        s.deliveries.select("status", minutes.alias("m"))
        .groupBy("status")
        .agg(
            F.count("m").alias("deliveries"),
            F.round(F.stddev_samp("m"), 2).alias("stddev_minutes"),
            F.round(F.var_samp("m"), 2).alias("variance_minutes"),
        )
    )


def distance_kpi(s) -> DataFrame:
    """Distance per vehicle from speed samples and from the odometer."""
    return s.telemetry.groupBy("vehicle_id").agg(
        F.round(steady_sum(F.col("speed")) * 0.001, 2).alias("speed_distance_km"),
        F.round(F.max("odometer") - F.min("odometer"), 2).alias("odometer_km"),
    )


def fuel_kpi(s) -> DataFrame:
    """Fuel span per vehicle, per day on which it reported."""
    span = F.max("fuel_level") - F.min("fuel_level")
    days = F.count_distinct(F.to_date("timestamp"))
    return s.telemetry.groupBy("vehicle_id").agg(
        span.alias("fuel_span"), days.alias("days"), F.round(F.try_divide(span, days), 2).alias("avg_daily_fuel")
    )


def incident_rate_kpi(s) -> DataFrame:
    """Incidents per vehicle, per 1000 readings and per 1000 km."""
    readings = s.telemetry.groupBy("vehicle_id").agg(
        F.count("*").alias("readings"), (F.max("odometer") - F.min("odometer")).alias("km")
    )
    incidents = s.incidents.groupBy("vehicle_id").agg(F.count("*").alias("incidents"))
    n = F.coalesce("incidents", F.lit(0))
    return readings.join(incidents, "vehicle_id", "left").select(
        "vehicle_id",
        "readings",
        n.alias("incidents"),
        F.round(ratio(n, F.col("readings"), 1000.0), 2).alias("per_1000_readings"),
        F.round(ratio(n, F.col("km"), 1000.0), 2).alias("per_1000_km"),
    )


def utilization_time_kpi(s) -> DataFrame:
    """Share of readings in motion per vehicle."""
    return (
        s.telemetry.groupBy("vehicle_id")
        .agg(F.count("*").alias("readings"), F.count_if(F.col("status") == "Moving").alias("moving"))
        .withColumn("utilization_percent", _percent("moving", "readings"))
    )


# Weights of the driver score: rating counts for, incidents and speeding against.
SCORE_WEIGHTS = {"rating": 0.5, "incident_rate": -0.3, "over_speed": -0.2}


def driver_score_kpi(s, speed_limit: float = 120.0) -> DataFrame:
    """Weighted sum of z-scaled rating, incidents per 1000 readings and share of speeding."""
    readings = s.telemetry.groupBy("driver_id").agg(
        F.count("*").alias("readings"), F.count_if(F.col("speed") > speed_limit).alias("fast")
    )
    incidents = s.incidents.groupBy("driver_id").agg(F.count("*").alias("incidents"))
    terms = (
        s.drivers.select("driver_id", "name", "rating")
        .join(readings, "driver_id", "left")
        .join(incidents, "driver_id", "left")
        .select(
            "driver_id",
            "name",
            F.col("rating"),
            F.round(ratio(F.col("incidents"), F.col("readings"), 1000.0), 6).alias("incident_rate"),
            F.round(ratio(F.col("fast"), F.col("readings")), 6).alias("over_speed"),
        )
    )
    moments = terms.agg(
        F.struct(
            *[
                m
                for t in SCORE_WEIGHTS
                for m in (steady_avg(F.col(t)).alias(f"{t}_mean"), F.stddev_pop(t).alias(f"{t}_std"))
            ]
        ).alias("m")
    )
    scaled = terms.withColumn("m", moments.scalar())
    score = F.lit(0.0)
    for t, w in SCORE_WEIGHTS.items():
        z = F.coalesce(F.try_divide(F.col(t) - F.col(f"m.{t}_mean"), F.col(f"m.{t}_std")), F.lit(0.0))
        score = score + z * w
    return scaled.select("driver_id", "name", "rating", "incident_rate", "over_speed", F.round(score, 4).alias("score"))


def maintenance_age_kpi(s, as_of: str) -> DataFrame:
    return s.vehicles.select(
        "vehicle_id", "last_maintenance", F.datediff(at(as_of).cast("date"), "last_maintenance").alias("days_since")
    )


# Colour bands per dashboard panel, lowest value that enters the band.
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

# Dashboard panels and the KPI each one shows.
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


def kpi_bands(kpis: DataFrame) -> DataFrame:
    """Colour of each KPI: the last band whose lower limit it reaches."""
    bands = kpis.sparkSession.createDataFrame(list(KPI_BANDS), "kpi string, low double, band string")
    reached = F.col("low").isNull() | (F.col("value") >= F.col("low"))
    floor = F.coalesce("low", F.lit(float("-inf")))
    return kpis.join(bands, "kpi").filter(reached).groupBy("kpi", "value").agg(F.max_by("band", floor).alias("band"))


def dashboard_feed(snapshot: DataFrame, vehicles: DataFrame, as_of: str) -> DataFrame:
    """Every panel with the latest live value of its KPI; the table panel lists vehicles by type."""
    panels = snapshot.sparkSession.createDataFrame(list(PANELS), "panel int, title string, kpi string")
    live = (
        snapshot.filter(F.col("expires_at") > at(as_of))
        .groupBy("kpi")
        .agg(F.max_by("value", "computed_at").alias("value"), F.lit(None).cast("string").alias("detail"))
    )
    # One entry per vehicle type.
    by_type = vehicles.groupBy("vehicle_type").agg(F.count("*").alias("n")).select(
        F.concat_ws("=", "vehicle_type", F.col("n").cast("string")).alias("entry")
    )
    table = by_type.agg(F.array_join(F.sort_array(F.collect_list("entry")), ", ").alias("detail")).select(
        F.lit("vehicles_by_type").alias("kpi"), F.lit(None).cast("double").alias("value"), "detail"
    )
    return panels.join(live.unionByName(table), "kpi", "left").select("panel", "title", "kpi", "value", "detail")


def snapshot_kpis(kpis: DataFrame, as_of: str, ttl: int = 300) -> DataFrame:
    """KPI lines with the time they were computed and the time they expire."""
    return kpis.select(
        "kpi",
        "value",
        at(as_of).alias("computed_at"),
        F.timestamp_add("SECOND", F.lit(ttl), at(as_of)).alias("expires_at"),
    )


def get_kpi(snapshot: DataFrame, name: str, as_of: str) -> DataFrame:
    """Latest live value of one KPI; no row when it is missing or expired."""
    live = (F.col("kpi") == name) & (F.col("expires_at") > at(as_of))
    return snapshot.filter(live).groupBy("kpi").agg(
        F.max_by("value", "computed_at").alias("value"), F.max("computed_at").alias("computed_at")
    )
