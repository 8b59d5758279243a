"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the table directory, BENCH_CPUS the local cores, BENCH_RUNS
the timed runs per query (the median counts), BENCH_QUERIES a comma-separated
choice of other queries. Every query is built anew and run in full into a sink
that discards the rows.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "proj_parse_stats", "val_stats", "route_stats", "join_enrich", "join_salted_enrich",
    "join_baseline_asof", "sc_ingest", "sc_flatline_merge", "agg_site_hour", "gold_site_health",
    "agg_minute_latest", "gold_anomaly_windows", "set_union_anomalies", "agg_flatline_window",
    "doc_flatline_sliding", "doc_rolling_iqr", "op_latest_by_key", "dedup_last_wins",
    "win_total_per_hour", "agg_baseline", "agg_if_features", "psi_score", "job_psi",
    "job_backfill", "job_dlq", "job_pending", "job_gold", "job_validation", "rpt_health_trend",
    "rpt_ingest_stall", "if_score",
)


def main() -> None:
    from telemark.registry import registered
    from telemark.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(HEADLINE)
    spark = build_session(
        "telemark-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
           "spark.driver.memory": "8g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    build = registered()

    def once(name: str) -> float:
        begin = time.perf_counter()
        build[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    times: dict[str, float] = {}
    for name in chosen:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
