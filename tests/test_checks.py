from haulmark.operators import checks

COLUMNS = "n int, vehicle_id string, timestamp string, speed double, fuel_level double, engine_temp double"
T = "2024-01-01"
DIRTY = [
    (0, "v", T, 50.0, 50.0, 80.0),
    (1, None, T, 50.0, 50.0, 80.0),
    (2, "v", T, -1.0, 50.0, 80.0),
    (3, "v", T, 140.0, 50.0, 80.0),
    (4, "v", T, 141.0, 50.0, 115.0),
    (5, "v", T, 200.0, 50.0, 80.0),
    (6, "v", T, 201.0, 50.0, 80.0),
    (7, "v", T, 50.0, -0.1, 80.0),
    (8, "v", T, 50.0, 4.9, 39.9),
    (9, "v", T, 50.0, 100.1, 80.0),
    (10, "v", T, 50.0, None, 80.0),
    (11, "v", T, 50.0, 50.0, 110.0),
    (12, "v", T, 50.0, 50.0, 110.1),
    (13, "v", T, None, 4.9, 40.0),
    (14, "v", None, 50.0, 50.0, 80.0),
]


def test_validate_telemetry(spark):
    df = spark.createDataFrame(DIRTY, COLUMNS)
    kept = [r.n for r in checks.validate(df, "telemetry").orderBy("n").collect()]
    assert kept == [0, 3, 4, 5, 8, 11, 12]
    assert checks.validate(df, "telemetry", speed_max=120).count() == 4


def test_validate_other_entities(spark):
    d = spark.createDataFrame([("a", "v", "s"), (None, "v", "s"), ("a", None, "s"), ("a", "v", None)],
                              "delivery_id string, vehicle_id string, status string")
    assert checks.validate(d, "delivery").count() == 1
    i = d.toDF("incident_id", "vehicle_id", "incident_type")
    assert checks.validate(i, "incident").count() == 1
    assert checks.validate(i, "something").count() == 4


def test_anomaly_labels_first_match_wins(spark):
    df = spark.createDataFrame(DIRTY, COLUMNS)
    found = {r.n: r.anomaly_type for r in checks.anomalies(df).collect()}
    assert found == {2: "INVALID_SPEED", 4: "OVER_SPEED", 5: "OVER_SPEED", 6: "OVER_SPEED", 7: "LOW_FUEL",
                     8: "ENGINE_COLD", 12: "OVERHEATING", 13: "LOW_FUEL"}
    # Row 4 is also too hot, which shows once its speed is allowed.
    raised = {r.n: r.anomaly_type for r in checks.anomalies(df, speed_max=300).collect()}
    assert raised == {n: tag for n, tag in found.items() if n not in (4, 5, 6)} | {4: "OVERHEATING"}


def test_unknown_label(spark):
    df = spark.createDataFrame(DIRTY[:1], COLUMNS).withColumn("t", checks.anomaly_type())
    assert df.first().t == "UNKNOWN"
