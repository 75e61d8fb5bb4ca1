import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from haulmark.operators import quality


@pytest.fixture(scope="module")
def vehicles(spark):
    rows = [("a", "Van", "m", "x", 2015, 10, 5, "Active"), ("a", "Bus", "m", "x", 2009, -1, 5, "active"),
            (None, "SUV", None, "x", 2026, 10, None, None)]
    return spark.createDataFrame(rows, "vehicle_id string, vehicle_type string, make string, model string, year int, "
                                       "capacity_kg int, fuel_capacity int, status string")


def test_rules_and_quarantine(vehicles):
    rules = quality.table_rules()["vehicles"]
    valid, bad = quality.split_valid(vehicles, rules)
    assert valid.count() == 1
    broken = {r.year: set(r.broken_rules) for r in bad.collect()}
    assert broken == {
        2009: {"enum:vehicle_type", "minimum:year", "minimum:capacity_kg", "enum:status"},
        2026: {"required:vehicle_id", "required:make", "maximum:year"},
    }


def test_rule_report(vehicles):
    out = {(r.check, r.column): (r.violations, r.total, r.passed)
           for r in quality.rule_report(vehicles, "vehicles", quality.table_rules()["vehicles"]).collect()}
    assert out[("enum", "status")] == (1, 3, False)
    assert out[("minimum", "fuel_capacity")] == (0, 3, True)


def test_duplicates(vehicles, rows):
    out = quality.dq_duplicates({"vehicles": vehicles}, {"vehicles": ["vehicle_id", "year"]})
    assert rows(out) == [("duplicates", "vehicles", "vehicle_id", 1, 2, False), ("duplicates", "vehicles", "year", 0, 3, True)]


def test_empty_table_passes(vehicles, rows):
    out = quality.dq_duplicates({"vehicles": vehicles.limit(0)}, {"vehicles": ["vehicle_id"]})
    assert rows(out) == [("duplicates", "vehicles", "vehicle_id", 0, 0, True)]


def test_expect_strict_stops(vehicles):
    rules = [quality.required("vehicle_id"), quality.within("year", 2000, 2030)]
    assert quality.expect(vehicles, rules).filter(F.size("broken_rules") > 0).count() == 1
    with pytest.raises(PySparkException, match="required:vehicle_id"):
        quality.expect(vehicles, rules, strict=True).collect()
    assert quality.expect(vehicles.filter("vehicle_id IS NOT NULL"), rules, strict=True).count() == 2


def test_expected_counts_of_missing_table(spark, rows):
    counts = spark.createDataFrame([("a", 3)], "entity string, rows long")
    assert rows(quality.expected_counts(counts, {"a": 3, "b": 1})) == [("a", 3, 3, True), ("b", 1, 0, False)]


def test_summary_fails_when_a_check_fails(spark):
    counts = spark.createDataFrame([("vehicles", 3), ("drivers", 2)], "entity string, rows long")
    line = "check string, entity string, column string, violations long, total long, passed boolean"
    for passed, verdict in ((True, "passed"), (False, "failed")):
        report = spark.createDataFrame([("c", "e", "x", 0, 1, True), ("d", "e", "x", 1, 1, passed)], line)
        row = quality.dq_summary(report, counts, F.lit("now")).first()
        assert (row.vehicles, row.drivers, row.checks, row.quality_check) == (3, 2, 2, verdict)


def test_a_run_is_recorded_once(spark):
    from haulmark.session import run_dir
    from haulmark.sources.versioned import VersionedTable

    history = VersionedTable(spark, f"{run_dir(spark, 't-runs')}/runs")
    line = spark.createDataFrame([("2024-01-01", 3)], "run_at string, failed int")
    assert quality.record_run(history, line, "2024-01-01")
    assert not quality.record_run(history, line.withColumn("failed", F.lit(9)), "2024-01-01")
    assert quality.record_run(VersionedTable(spark.newSession(), history.root), line, "2024-01-02")
    assert [r["failed"] for r in history.read().collect()] == [3, 3]
