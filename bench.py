"""Seconds per headline query; prints one JSON line.

Each query runs once to warm up and is then timed ``BENCH_RUNS`` times; the
best time counts.  Results go to the no-op sink, so that every row and column
is computed and nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulsegrid.session import local_session
from pulsegrid.suite import load

HEADLINE = """
scan_history_range scan_trends_range snapshot_dims join_fact_dims semi_active_items alarm_chain_left
minute_pivot hourly_pivot join_hourly_trends dedup_keep_last ffill_limit3 upsert_matrix
rolling_avg rolling_std rolling_trend asof_last_alarm interval_label interval_first_label
enriched_features incremental_features coverage_gaps sequence_windows feature_variance feature_corr scaler_stats
event_quantiles quantile_threshold zscore_detector threshold_flags prf_metrics window_comparison detection_latency
alert_summary comparison_summary metric_reconcile summary_report alert_rate_5m iforest_scores stream_minute_avg
ocsvm_scores seqrecon_scores retrain_report stream_rolling stream_alerts
sequence_on_grid asof_by_day archive_days sketch_thresholds fleet_pivot fleet_rolling fleet_asof fleet_labels fleet_quantiles fleet_detector
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("OFF")
    queries, _ = load()

    def once(name: str) -> float:
        begin = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    took = {}
    for name in names:
        once(name)
        took[name] = round(min(once(name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
