"""Time the headline queries: one warm-up, then the median of three runs."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog.queries import QUERIES  # noqa: E402
from sensorloom.session import build_session  # noqa: E402

HEADLINE = [
    "dash_window",
    "dash_sensor",
    "ods_count",
    "long_counts",
    "window_consistency",
    "consistency_metrics",
    "kpi_window_wide",
    "kpi_sensor_wide",
    "interval_stats",
    "state_transitions",
    "downsample",
    "average_precision",
    "threshold_sweep",
    "lead_time",
    "minute_features",
    "rolling_stats",
    "feature_table",
    "compressor_feature_table",
    "validate_contract",
    "risk_enrich",
    "kpi_1m",
    "stream_fanout",
    "mad_anomaly",
    "model_logistic",
]
RUNS = 3
SLOW = {"model_logistic", "stream_fanout", "compressor_feature_table"}  # one timed run


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        int(cpus),
        {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in chosen:
        laps = []
        try:
            for _ in range(2 if name in SLOW else RUNS + 1):
                begun = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                laps.append(time.perf_counter() - begun)
        except Exception as error:  # one failing query does not throw away the figures of the others
            failed[name] = f"{type(error).__name__}: {error}"[:300]
            continue
        times[name] = round(statistics.median(laps[1:]), 3)
    spark.stop()
    out = {
        "metric": "total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()
