"""Time the headline queries: ``BENCH_SF_DIR`` (default sf0.1) on ``local[BENCH_CPUS]``, one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskmart.plans.queries import QUERIES  # noqa: E402
from riskmart.session import build_session  # noqa: E402

# the stages whose shape dominates at scale: star join and segments, cube, dedup, side join,
# features, one-pass thresholds, exact ranks and areas, profiles, boosting, stream
HEADLINE = [
    "segment_risk", "metric_bundle", "daily_cube", "kpis_daily", "global_kpis", "dedup_by_key", "left_join_presence",
    "side_coverage", "distinct_profile", "null_profile", "duplicate_count", "describe_numeric", "correlation_matrix",
    "percentiles_by_class", "box_stats", "amount_histogram", "score_histogram", "threshold_curve", "optimal_threshold",
    "cost_scenarios", "roc_auc", "pr_auc", "headline", "segment_lift", "rolling_rate", "feature_table", "class_weights",
    "stratified_sample", "csv_scan", "ingest_once", "write_partitioned", "train_baseline", "train_gbt", "stream_score", "run_stages", "score_stream",
    "bucketed_join", "percentile_sketches", "distinct_sketches", "keyed_dedup", "stream_compaction", "rolling_calendar",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = build_session(
        "riskmart-bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["kpis_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start-up is not a query
    seconds = {}
    for name in only:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    sf = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": float(sf)}))
    spark.stop()


if __name__ == "__main__":
    main()
