"""Starting stream queries: files, console, memory and keyed upserts."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from haulmark.streaming.keyed import upsert_batch


# Large states are not read a second time to count their keys, and a commit writes what changed instead of all files.
STATE = {
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
CLOSING = "spark.sql.streaming.noDataMicroBatches.enabled"


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings for the queries that start inside; what the session has set itself stays."""
    own = {k: v for k, v in wanted.items() if spark.conf.get(k, None) is None or k == CLOSING}
    before = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _trigger(spark: SparkSession, writer, every: str | None, closing: bool = True) -> StreamingQuery:
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    with _settings(spark, STATE if closing else STATE | {CLOSING: "false"}):
        return writer.start()


def start(
    df: DataFrame, name: str, out: str, checkpoint_root: str, mode: str = "append", every: str | None = None
) -> StreamingQuery:
    """Named query into Parquet files with its own checkpoint folder.

    Without ``every`` the query works off what is there and ends.
    """
    writer = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", out)
        .option("checkpointLocation", f"{checkpoint_root}/{name}")
        .queryName(name)
    )
    return _trigger(df.sparkSession, writer, every)


def to_console(df: DataFrame, name: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Debug sink with full column width."""
    writer = df.writeStream.format("console").outputMode(mode).option("truncate", "false").queryName(name)
    return _trigger(df.sparkSession, writer, every)


def to_memory(
    df: DataFrame, name: str, mode: str = "complete", every: str | None = None, rows: int | None = 10_000
) -> StreamingQuery:
    """The first rows of a result as an in-memory table of that name; they live on the driver, so their number is bounded."""
    shown = df if rows is None else df.limit(rows)
    writer = shown.writeStream.format("memory").outputMode(mode).queryName(name)
    return _trigger(df.sparkSession, writer, every)


def per_batch(
    df: DataFrame, fn: Callable[[DataFrame, int], None], name: str, checkpoint_root: str, mode: str = "append",
    every: str | None = None, closing: bool = True,
) -> StreamingQuery:
    """Run a function on every batch. An error fails the query, so no batch is lost.

    A last batch without rows drops the states that the watermark has passed. In
    update mode it delivers nothing; ``closing=False`` leaves it out.
    """
    writer = (
        df.writeStream.foreachBatch(fn)
        .outputMode(mode)
        .option("checkpointLocation", f"{checkpoint_root}/{name}")
        .queryName(name)
    )
    return _trigger(df.sparkSession, writer, every, closing)


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def start_upsert(
    df: DataFrame, target: str, name: str, checkpoint_root: str, keys: list[str], order: list[str],
    every: str | None = None,
) -> StreamingQuery:
    """Keyed upsert of partial rows: the latest by the order columns (time, offset) wins, NULL never overwrites."""
    return per_batch(df, upsert_batch(target, keys, order), name, checkpoint_root, every=every)


def append_counted(df: DataFrame, path: str) -> int:
    """Append rows and return how many were written, counted on the way."""
    counter = Observation()
    df.observe(counter, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return counter.get["rows"]


def append_batches(*outputs: tuple[str, Callable[[DataFrame], DataFrame]]) -> Callable[[DataFrame, int], None]:
    """Callback that feeds several outputs from one read of each batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        shared = len(outputs) > 1  # a batch that is read once needs no copy
        if shared:
            batch.persist()
        try:
            for path, view in outputs:
                view(batch).write.mode("overwrite").parquet(batch_folder(path, batch_id))
        finally:
            if shared:
                batch.unpersist()

    return write


class ProgressLog(StreamingQueryListener):
    """Keeps the progress of every batch: name, batch, input rows and late rows, one tuple each.

    details: by run and batch, the observed metrics and the watermark that the batch used.
    """

    def __init__(self):
        self.rows: dict[str, list[tuple[str, int, int, int]]] = {}
        self.details: dict[str, dict[int, tuple[dict[str, dict], str | None]]] = {}
        self.ended: set[str] = set()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
        self.rows.setdefault(str(p.runId), []).append((p.name, p.batchId, p.numInputRows, late))
        metrics = {name: row.asDict() for name, row in p.observedMetrics.items()}
        self.details.setdefault(str(p.runId), {})[p.batchId] = metrics, p.eventTime.get("watermark")

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.add(str(event.runId))

    def of(self, *queries: StreamingQuery, seconds: float = 60) -> list[tuple[str, int, int, int]]:
        """Batches of ended queries; waits until their last report has arrived."""
        until = time.monotonic() + seconds
        while not all(str(q.runId) in self.ended for q in queries):
            if time.monotonic() > until:
                raise TimeoutError("progress of an ended query has not arrived")
            time.sleep(0.05)
        return [row for q in queries for row in self.rows.get(str(q.runId), [])]


def watch(spark: SparkSession) -> ProgressLog:
    """Start to log progress; call before the queries start."""
    log = ProgressLog()
    spark.streams.addListener(log)
    return log


PROGRESS = "query string, batch_id bigint, input_rows bigint, late_rows bigint"


def progress_table(spark: SparkSession, log: ProgressLog, *queries: StreamingQuery) -> DataFrame:
    rows = log.of(*queries)
    spark.streams.removeListener(log)
    return spark.createDataFrame(rows, PROGRESS)


def await_all(*queries: StreamingQuery) -> None:
    """Wait for every query, so a failure in any of them is raised."""
    for q in queries:
        q.awaitTermination()


def lit_phase(df: DataFrame, src: str, phase: int) -> None:
    """Add one folder of files for a file stream to pick up."""
    df.write.mode("overwrite").parquet(f"{src}/phase={phase}")


def phase_stream(spark: SparkSession, src: str, like: DataFrame) -> DataFrame:
    schema = like.withColumn("phase", F.lit(0)).schema
    return spark.readStream.schema(schema).parquet(src)
