import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from haulmark.schemas import ENTITIES, schema_for
from haulmark.session import run_dir, shared_root
from haulmark.sources import envelopes, tables

SMALL = "/root/testdata/sf0.001"


def test_shared_root_follows_the_setting(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "a") != run_dir(spark, "a")


def test_time_filter_reaches_the_scan(spark, capsys):
    recent = tables.load(spark, SMALL, "telemetry").filter(F.col("timestamp") >= F.lit("2024-01-30").cast("timestamp"))
    recent.select("vehicle_id", "speed").explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(ts,2024-01-30" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp,user_id:bigint,value:double>" in plan


def test_views_answer_plain_sql(spark):
    tables.register_views(spark, SMALL)
    text = """
        WITH seen AS (SELECT driver_id, vehicle_id, avg(speed) AS mean FROM telemetry_events
                      WHERE timestamp >= TIMESTAMP '2024-01-02' GROUP BY driver_id, vehicle_id)
        SELECT v.make, count(*) AS pairs, round(max(mean), 1) AS fastest FROM seen
        JOIN dim_vehicles v USING (vehicle_id) LEFT JOIN dim_drivers d USING (driver_id) GROUP BY v.make"""
    assert spark.sql(text).count() > 0
    for names in tables.SQL_NAMES.values():
        for name in names:
            assert spark.table(name).count() > 0


def test_load_reads_whole_tables(spark):
    assert tables.load(spark, SMALL, "telemetry").count() == 1000
    assert set(tables.VIEWS) == set(ENTITIES)


def test_decode_broken_messages(spark):
    good = json.dumps({"vehicle_id": "V1", "timestamp": "2025-12-14T10:30:00Z", "speed": 55.5, "rpm": 3.7})
    bad_field = json.dumps({"vehicle_id": "V2", "speed": "fast"})
    data = [("k1", good, 0, 1), ("k2", bad_field, 0, 2), ("k3", "{not json", 0, 3), (None, None, 0, 4)]
    raw = spark.createDataFrame(data, "key string, value string, partition int, offset long")
    out = {r.offset: r for r in envelopes.decode(raw, schema_for("telemetry")).collect()}
    assert len(out) == 4
    assert (out[1].vehicle_id, out[1].speed, out[1].rpm) == ("V1", 55.5, 3.7)
    assert (out[2].vehicle_id, out[2].speed) == ("V2", None)
    assert out[3].vehicle_id is None and out[3].key == "k3"
    assert out[4].vehicle_id is None


def test_completion_message_fits_the_delivery_schema(spark):
    text = json.dumps({"delivery_id": "D1", "vehicle_id": "V", "completion_time": "2025-12-14T11:00:00",
                       "status": "Completed", "duration_minutes": 30})
    raw = spark.createDataFrame([(text,)], "value string")
    row = envelopes.decode(raw, schema_for("delivery")).first()
    assert (row.delivery_id, row.duration_minutes, row.distance_km) == ("D1", 30.0, None)


def test_encode_decode_round_trip(spark, rows):
    df = spark.createDataFrame([("V1", 10.0), ("V2", None)], "vehicle_id string, speed double")
    coded = envelopes.encode_envelope(df, F.col("vehicle_id"), topic="t", offset=F.lit(5))
    assert coded.columns == ["topic", "key", "value", "offset"]
    assert rows(envelopes.decode(coded, df.schema).select("vehicle_id", "speed")) == [("V1", 10.0), ("V2", None)]


def test_publish_to_files(spark, tmp_path):
    df = spark.createDataFrame([("V1", 10.0)], "vehicle_id string, speed double")
    coded = envelopes.encode_envelope(df, F.col("vehicle_id"))
    envelopes.publish(coded, path=str(tmp_path / "topic"))
    envelopes.publish(coded, path=str(tmp_path / "topic"))
    assert spark.read.parquet(str(tmp_path / "topic")).count() == 2


def test_peek_limits_before_the_shuffle(spark, rows, capsys):
    data = [("a", i, f"k{i}", "x" * 300) for i in range(50)] + [("b", 1, "k", "short")]
    df = spark.createDataFrame(data, "topic string, offset long, key string, value string")
    out = envelopes.peek(df, 3, 200)
    assert rows(out, "topic", "rank", "offset") == [("a", 1, 49), ("a", 2, 48), ("a", 3, 47), ("b", 1, 1)]
    assert out.agg(F.max(F.length("preview"))).first()[0] == 200
    out.explain()
    assert "WindowGroupLimit" in capsys.readouterr().out


def test_topic_counts(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "topic string")
    assert rows(envelopes.topic_counts(df)) == [("a", 2, 66.67), ("b", 1, 33.33)]
    assert envelopes.route(df, "a").count() == 2


def test_flatten_and_coerce(spark, rows):
    df = spark.createDataFrame(
        [(1, (24.5, None), "7.5"), (2, None, "n/a"), (3, (1.0, 2.0), None)],
        "id int, location struct<latitude:double,longitude:double>, fuel string",
    )
    flat = envelopes.coerce_double(envelopes.flatten_location(df, prefix="at_"), ["fuel"])
    assert rows(flat) == [(1, 7.5, 24.5, 0.0), (2, None, 0.0, 0.0), (3, None, 1.0, 2.0)]


def test_extract_dimension_writes_iso_text(spark):
    df = spark.sql("SELECT 1 AS id, TIMESTAMP '2024-05-06 07:08:09.123456' AS t, DATE '2024-05-06' AS d")
    row = envelopes.extract_dimension(df).first()
    assert (row.t, row.d) == ("2024-05-06T07:08:09.123456", "2024-05-06T00:00:00.000000")


def test_extract_recent_is_inclusive(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h),) for h in range(4)], "timestamp timestamp")
    assert envelopes.extract_recent(df, F.lit("2024-01-01 02:00:00").cast("timestamp")).count() == 2


def test_broker_source_needs_the_connector(spark):
    with pytest.raises(PySparkException):
        envelopes.read_stream(spark, "vehicle-telemetry", "telemetry", servers="localhost:9092")
