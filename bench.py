"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Each query is timed
three times after a warm-up of the session; the median counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path
from statistics import median

sys.path.insert(0, str(Path(__file__).resolve().parent))

from haulmark.plans.registry import QUERIES  # noqa: E402
from haulmark.session import build_session  # noqa: E402

HEADLINE = (
    "showcase_q1", "showcase_q2", "showcase_q3", "showcase_q4", "showcase_q5",
    "doc_q1", "doc_q2", "doc_q3", "doc_q4", "doc_q5",
    "kpi_fleet", "kpi_realtime", "kpi_sql", "kpi_driver_score",
    "sliding_rollup", "tumbling_rollup", "anomaly_classify", "join_interval", "join_vehicle_day",
    "route_distance", "ar1_check", "speed_profile_stats", "normality_check", "incident_dispersion",
    "dq_schema_rules", "dq_foreign_keys", "merge_partial_updates", "archive_warm", "archive_cold",
    "stream_upsert", "stream_anomalies", "stream_append_vs_update",
)

RUNS = 3

# Run once before timing, so that JVM start-up is not part of any query.
WARM_UP = ("table_counts", "showcase_q5", "route_distance", "stream_anomalies")


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    width = "8" if cpus == "*" else cpus
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=width, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    for name in WARM_UP:
        run(spark, name, sf_dir)
    times = {name: round(median(run(spark, name, sf_dir) for _ in range(RUNS)), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
