"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on $BENCH_SF_DIR (default /root/testdata/sf0.1)
with local[$BENCH_CPUS] and prints one JSON line:
{"metric": "...", "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Every run writes the full result through the ``noop`` sink, so all columns and
rows are computed (``count()`` would let Catalyst prune columns). First every
query runs once (warm-up of the JVM and code generation for all of them), then
each gets the same number of timed runs, ``BENCH_RUNS`` (default 1), and the
median is reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "training_panel", "time_series", "daily_cases", "district_statistics", "national_statistics",
    "alert_statistics", "dashboard_summary", "top_districts", "cases_with_district", "district_rollup",
    "dq_report", "dq_district", "panel_gate", "dq_unique_key", "fk_orphans",
    "generate_alerts", "upsert_predictions", "acknowledge_alert", "retain",
    "arima_111_forecast", "seasonal_trend_forecast", "ensemble_predictions",
    "sequence_forecast", "boosted_forecast", "daily_job", "weekly_training",
    "stream_ingest_cases", "stream_daily_cases", "stream_alerts",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    from riskpanel import catalog
    from riskpanel.session import get_session
    scratch = tempfile.mkdtemp(prefix="bench-")
    spark = get_session(f"local[{cpus}]", int(cpus), extra={
        "spark.driver.memory": "16g",
        "spark.checkpoint.dir": os.path.join(scratch, "checkpoints")})
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))
    def once(n):
        t0 = time.perf_counter()
        catalog.run(n, spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for n in names:
        once(n)
    out = {n: round(statistics.median([once(n) for _ in range(runs)]), 3) for n in names}
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(out.values()), 3),
                      "unit": "sec", "queries": out, "sf": float(sf.group(1)) if sf else sf_dir,
                      "cpus": int(cpus), "runs": runs}))


if __name__ == "__main__":
    main()
