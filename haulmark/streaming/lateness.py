"""Exact count of rows that come too late for their window.

Spark counts late rows after partial aggregation, so its figure depends on how
files are cut. Here every row is counted as it arrives, by a metric observed
before the aggregate, and every row that a window took is in that window's
count. A tumbling window takes a row or drops it, so the difference is the
number of late rows, whatever the files, batches or restarts were.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from haulmark.operators.rollups import sliding_rollup
from haulmark.streaming import sinks
from haulmark.streaming.keyed import read_upserted, upsert_batch

ARRIVALS = "arrivals"
KEYS = ["window_start", "window_end", "vehicle_id"]


def start_counted_windows(
    stream: DataFrame, out: str, name: str, checkpoint_root: str, time: str = "timestamp", every: str | None = None
) -> StreamingQuery:
    """Tumbling windows, upserted as they grow, of rows that are counted on arrival. Rows without time are in no window."""
    arriving = stream.observe(ARRIVALS, F.count(time).alias("rows"))
    windows = sliding_rollup(arriving, slide=None, time=time).withColumn("seen", F.col("record_count"))
    write = upsert_batch(out, KEYS, ["seen"])
    return sinks.per_batch(windows, write, name, checkpoint_root, mode="update", every=every)


@dataclass
class Arrivals:
    """Rows that arrived and the watermark, over all runs of a query."""

    rows: int = 0
    watermark: str | None = None

    def add(self, log: sinks.ProgressLog, query: StreamingQuery) -> None:
        """Take in a run that has ended."""
        log.of(query)
        for metrics, watermark in log.details[str(query.runId)].values():
            self.rows += metrics.get(ARRIVALS, {}).get("rows", 0)
            self.watermark = max(filter(None, (self.watermark, watermark)), default=None)


def late_report(spark, out: str, arrivals: Arrivals) -> DataFrame:
    """Windows that the watermark has closed and their records, and the rows that were too late for theirs."""
    windows = read_upserted(spark, out, KEYS)
    closed = F.col("window_end") <= F.to_timestamp(F.lit(arrivals.watermark))
    return windows.agg(
        F.count_if(closed).alias("windows"),
        F.sum(F.when(closed, F.col("record_count"))).alias("records"),
        (F.lit(arrivals.rows).cast("bigint") - F.sum("record_count")).alias("late_rows"),
    )
