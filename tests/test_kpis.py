from types import SimpleNamespace

import pytest

from haulmark.operators import kpis, rollups
from haulmark.plans import reports


@pytest.fixture(scope="module")
def empty(star):
    names = ("vehicles", "drivers", "warehouses", "customers", "telemetry", "deliveries", "incidents")
    return SimpleNamespace(**{n: getattr(star, n).limit(0) for n in names})


def test_empty_tables_give_zeros(empty):
    for fn in (kpis.kpi_fleet, kpis.kpi_sql, kpis.global_averages, lambda s: kpis.kpi_realtime(s, "2024-01-31 00:00:00")):
        assert {r.value for r in fn(empty).collect()} == {0.0}


def test_sizes_of_the_sets(star):
    assert kpis.kpi_fleet(star).count() == 14
    assert kpis.kpi_realtime(star, "2024-01-31 00:00:00").count() == 10
    assert kpis.kpi_sql(star).count() == 9


def test_minute_means_fall_back_to_all_rows(star):
    late = rollups.mean_of_minutes(star.telemetry, ["speed"], "2030-01-01 00:00:00").first()[0]
    plain = star.telemetry.agg({"speed": "avg"}).first()[0]
    assert abs(late - plain) < 1e-5


def test_snapshot_expires(spark, rows):
    figures = spark.createDataFrame([("a", 1.0)], "kpi string, value double")
    newer = spark.createDataFrame([("a", 2.0)], "kpi string, value double")
    both = kpis.snapshot_kpis(figures, "2024-01-01 00:00:00").unionAll(kpis.snapshot_kpis(newer, "2024-01-01 00:01:00"))
    value = lambda t: [r.value for r in kpis.get_kpi(both, "a", t).collect()]
    assert value("2024-01-01 00:04:00") == [2.0]
    assert value("2024-01-01 00:06:00") == []
    assert kpis.get_kpi(both, "b", "2024-01-01 00:00:00").count() == 0


def test_bands(spark):
    df = spark.createDataFrame(
        [("avg_speed_kmh", 9.9), ("total_vehicles", 400.0), ("drivers_on_route", 20.0), ("total_incidents", -1.0)],
        "kpi string, value double",
    )
    assert {r.kpi: r.band for r in kpis.kpi_bands(df).collect()} == {
        "avg_speed_kmh": "red", "total_vehicles": "green", "drivers_on_route": "yellow", "total_incidents": "green",
    }


def test_severity_is_read_in_any_case(spark):
    i = spark.createDataFrame([("high",), ("High",), ("LOW",), ("odd",), (None,)], "severity string")
    row = kpis.severity_score_kpi(SimpleNamespace(incidents=i)).first()
    assert (row.incidents, row.avg_severity_score) == (5, 2.33)


def test_unmatched_drivers_can_be_named(star):
    cutoff = reports.last_days("2024-01-31 00:00:00", 30)
    plain = {r.experience_level for r in reports.incident_analysis(star, cutoff, 1).collect()}
    named = {r.experience_level for r in reports.incident_analysis(star, cutoff, 1, "Unknown").collect()}
    assert "Unknown" not in plain and "Unknown" in named


def test_default_limits_filter_small_data(star):
    assert reports.driver_performance(star, reports.last_hours("2024-01-31 00:00:00", 24)).count() == 0


def test_a_missing_table_counts_zero(spark, tmp_path):
    from haulmark.operators import kpis
    from haulmark.sources.tables import Star

    found = {r["kpi"]: r["value"] for r in kpis.kpi_sql(Star(spark, str(tmp_path))).collect()}
    assert len(found) == 9 and set(found.values()) == {0.0}
