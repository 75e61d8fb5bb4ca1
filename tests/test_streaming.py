import datetime as dt
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from haulmark.operators import checks, joins, rollups
from haulmark.schemas import schema_for
from haulmark.session import run_dir
from haulmark.sources import envelopes
from haulmark.streaming import lateness, sinks

START = dt.datetime(2024, 1, 1)


def readings(spark, minutes, first=0):
    data = [(first + i, 1, START + dt.timedelta(minutes=m), 10.0 * i, 50.0, 80.0) for i, m in enumerate(minutes)]
    return spark.createDataFrame(
        data, "event_id long, vehicle_id long, timestamp timestamp, speed double, fuel_level double, engine_temp double"
    )


def test_sliding_windows_on_batch(spark, rows):
    out = rollups.sliding_rollup(readings(spark, [0, 1, 7]))
    starts = sorted({r.window_start for r in out.collect()})
    assert len(starts) == 11
    first = out.filter(F.col("window_start") == F.lit("2023-12-31 23:57:00").cast("timestamp")).first()
    assert (first.record_count, first.avg_speed, first.max_speed) == (2, 5.0, 10.0)
    tumbling = rollups.sliding_rollup(readings(spark, [0, 1, 7]), slide=None)
    assert rows(tumbling, "record_count") == [(1,), (2,)]


def test_append_holds_back_open_windows_and_late_rows_are_dropped(spark, rows):
    root = run_dir(spark, "t-late")
    late = []
    log = sinks.watch(spark)
    for phase, part in enumerate((readings(spark, [0, 1]), readings(spark, [60], 10), readings(spark, [2], 20))):
        sinks.lit_phase(part, f"{root}/src", phase)
        windows = rollups.sliding_rollup(sinks.phase_stream(spark, f"{root}/src", part), slide=None)
        query = sinks.start(windows, "late", f"{root}/out", f"{root}/ckpt")
        sinks.await_all(query)
        late.append(sum(r[3] for r in log.of(query)))
    spark.streams.removeListener(log)
    assert rows(spark.read.parquet(f"{root}/out"), "record_count") == [(2,)]
    assert late == [0, 0, 1]


@pytest.mark.parametrize("files", [1, 6])
def test_late_rows_are_counted_one_by_one(spark, files):
    """The same figure however the rows are dealt over files, where Spark's own counts rows after partial aggregation."""
    root = run_dir(spark, "t-counted")
    log, arrivals = sinks.watch(spark), lateness.Arrivals()
    for phase, minutes in enumerate(([0, 1, 2], [60], [2, 2, 3, 4, 58, 61])):
        part = readings(spark, minutes, 10 * phase).repartition(files)
        sinks.lit_phase(part, f"{root}/src", phase)
        query = lateness.start_counted_windows(sinks.phase_stream(spark, f"{root}/src", part), f"{root}/out", "late", f"{root}/ckpt")
        sinks.await_all(query)
        arrivals.add(log, query)
    spark.streams.removeListener(log)
    assert arrivals.rows == 10
    # 50 minutes is the watermark: the window of the first minutes is closed with its three readings, four came later
    assert lateness.late_report(spark, f"{root}/out", arrivals).first()[:] == (1, 3, 4)


def test_interval_join_of_two_streams(spark, rows):
    root = run_dir(spark, "t-interval")
    kinds = ("event_id long, driver_id long, timestamp timestamp", "incident_id long, driver_id long, timestamp timestamp")
    at = lambda m: START + dt.timedelta(minutes=m)
    steps = (
        ([(1, 1, at(0)), (2, 1, at(30)), (3, 2, at(30)), (4, None, at(31))], [(1, 1, at(0)), (2, 1, at(29)), (3, None, at(30))]),
        ([(5, 1, at(60)), (6, 1, at(90)), (7, 2, at(95))], [(4, 2, at(94)), (5, 2, at(96))]),
        ([(8, 9, at(9000))], [(9, 9, at(9000))]),
        ([(9, 9, at(20000))], [(10, 9, at(20000))]),
    )
    tables = [[], []]
    for phase, parts in enumerate(steps):
        streams = []
        for side, (part, kind, all_rows) in enumerate(zip(parts, kinds, tables, strict=True)):
            df = spark.createDataFrame(part, kind)
            all_rows += part
            sinks.lit_phase(df, f"{root}/{side}", phase)
            streams.append(sinks.phase_stream(spark, f"{root}/{side}", df).drop("phase"))
        sinks.await_all(sinks.start(joins.interval_pairs(*streams), "pairs", f"{root}/out", f"{root}/ckpt"))
    streamed = spark.read.parquet(f"{root}/out").filter("event_id < 8").select("event_id", "incident_id")
    batch = joins.interval_pairs(*(spark.createDataFrame(t, k) for t, k in zip(tables, kinds, strict=True)))
    wanted = [(1, 1), (2, 1), (2, 2), (3, None), (4, None), (5, 1), (5, 2), (6, None), (7, 4)]
    assert sorted(rows(streamed), key=repr) == sorted(wanted, key=repr)
    assert rows(batch.filter("event_id < 8"), "event_id", "incident_id") == sorted(wanted, key=repr)


def test_progress_is_complete_beyond_the_recent_entries(spark, tmp_path):
    src = str(tmp_path / "src")
    for i in range(115):
        spark.range(i, i + 3).coalesce(1).write.mode("append").parquet(src)
    log = sinks.watch(spark)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src)
    query = sinks.to_memory(stream, "many", "append", rows=None)
    sinks.await_all(query)
    table = sinks.progress_table(spark, log, query)
    assert table.agg(F.sum("input_rows"), F.count_distinct("batch_id")).first()[:] == (345, 115)


def test_a_failing_batch_fails_the_query(spark):
    root = run_dir(spark, "t-fail")
    sinks.lit_phase(readings(spark, [0]), f"{root}/src", 0)

    def broken(batch, batch_id):
        raise ValueError("cannot write")

    stream = sinks.phase_stream(spark, f"{root}/src", readings(spark, [0]))
    with pytest.raises(StreamingQueryException, match="cannot write"):
        sinks.await_all(sinks.per_batch(stream, broken, "fails", f"{root}/ckpt"))


def test_json_folder_as_a_topic(spark, tmp_path, rows):
    folder = tmp_path / "topic"
    folder.mkdir()
    lines = [{"vehicle_id": "a", "timestamp": "2024-01-01T00:00:00Z", "speed": 150.0, "fuel_level": 50},
             {"vehicle_id": "b", "timestamp": "2024-01-01T00:00:00Z", "speed": 500, "fuel_level": 50}]
    (folder / "part.json").write_text("\n".join(json.dumps(x) for x in lines))
    stream = envelopes.read_stream(spark, str(folder), "telemetry")
    assert stream.isStreaming and stream.schema == schema_for("telemetry")
    tagged = checks.anomalies(checks.validate(stream, "telemetry")).select("vehicle_id", "anomaly_type")
    query = sinks.to_memory(tagged, "tagged", "append")
    sinks.await_all(query)
    assert rows(spark.table("tagged")) == [("a", "OVER_SPEED")]
    # Progress counts rows that leave the scan, so it is read off a query without filters to push down.
    log = sinks.watch(spark)
    plain = sinks.to_memory(stream, "plain", "append", rows=None)
    sinks.await_all(plain)
    assert rows(sinks.progress_table(spark, log, plain), "query", "input_rows") == [("plain", 2)]


def test_the_memory_sink_is_bounded(spark):
    root = run_dir(spark, "t-memory")
    sinks.lit_phase(readings(spark, range(50)), f"{root}/src", 0)
    stream = sinks.phase_stream(spark, f"{root}/src", readings(spark, [0]))
    sinks.await_all(sinks.to_memory(stream, "few", "append", rows=7))
    sinks.await_all(sinks.to_memory(stream.groupBy("event_id").count(), "groups", "complete", rows=9))
    assert (spark.table("few").count(), spark.table("groups").count()) == (7, 9)


def test_console_runs(spark, tmp_path):
    root = run_dir(spark, "t-console")
    sinks.lit_phase(readings(spark, [0]), f"{root}/src", 0)
    stream = sinks.phase_stream(spark, f"{root}/src", readings(spark, [0]))
    sinks.await_all(sinks.to_console(stream, "console"))


def test_counted_append(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.append_counted(readings(spark, [0, 1, 2]), path) == 3
    assert sinks.append_counted(readings(spark, []), path) == 0
    assert spark.read.parquet(path).count() == 3


def test_one_batch_feeds_several_outputs(spark, tmp_path):
    write = sinks.append_batches((str(tmp_path / "all"), lambda b: b), (str(tmp_path / "fast"), lambda b: b.filter("speed > 5")))
    for _ in range(2):
        write(readings(spark, [0, 1, 2]), 0)
    assert spark.read.parquet(str(tmp_path / "all")).count() == 3
    assert spark.read.parquet(str(tmp_path / "fast")).count() == 2


def test_update_mode_may_leave_out_the_batch_that_only_drops_states(spark, rows):
    root = run_dir(spark, "t-closing")
    df = readings(spark, [0, 1, 7, 60])
    sinks.lit_phase(df, f"{root}/src", 0)
    batches = {}
    for closing in (True, False):
        log = sinks.watch(spark)
        windows = rollups.sliding_rollup(sinks.phase_stream(spark, f"{root}/src", df))
        write = sinks.append_batches((f"{root}/out{closing}", lambda b: b))
        query = sinks.per_batch(windows, write, f"w{closing}", f"{root}/checkpoints", mode="update", closing=closing)
        sinks.await_all(query)
        batches[closing] = len([r for r in log.of(query) if r[1] > 0])
        spark.streams.removeListener(log)
    assert batches == {True: 1, False: 0}
    assert rows(spark.read.parquet(f"{root}/outTrue").drop("batch_id")) == rows(spark.read.parquet(f"{root}/outFalse").drop("batch_id"))
    assert spark.conf.get(sinks.CLOSING) == "true" and all(spark.conf.get(k, None) is None for k in sinks.STATE)


def test_a_batch_of_one_output_is_not_copied(spark, monkeypatch):
    root = run_dir(spark, "t-copies")
    copies = []
    kind = type(readings(spark, [0]))
    monkeypatch.setattr(kind, "persist", lambda self: copies.append(self) or self)
    monkeypatch.setattr(kind, "unpersist", lambda self: self)
    for outputs in ([(f"{root}/a", lambda b: b)], [(f"{root}/b", lambda b: b), (f"{root}/c", lambda b: b)]):
        sinks.append_batches(*outputs)(readings(spark, [0]), 0)
    assert len(copies) == 1
