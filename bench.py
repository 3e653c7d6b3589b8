"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Mirrors the reference's pipeline: one typed full-refresh load of the payments
tables (timed as ``load_warehouse``), then every headline query over the
loaded warehouse. Each query is executed with the ``noop`` sink (full plan, no
driver collect): one warm-up, then the median of three timed runs.
Prints one JSON line on stdout.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans import analysis, dashboard, evaluation, features, kpis, quality  # noqa: E402
from ledgerlens.session import build_session, cleanup_work_dirs, shared_work_dir  # noqa: E402
from ledgerlens.sources.fixtures import Tables  # noqa: E402
from ledgerlens.sources.warehouse import load_warehouse  # noqa: E402

HEADLINE = {
    **kpis.MARTS,
    **analysis.QUERIES,
    "run_summary": quality.run_summary,
    "top_industries_by_gpv": quality.top_industries_by_gpv,
    "dq_report": quality.dq_report,
    "merchant_week_features": features.merchant_week_features,
    "training_table": features.training_table,
    "lift_table": evaluation.q_lift_table,
    "roc_auc": evaluation.q_roc_auc,
    "outreach_scores": evaluation.q_outreach_scores,
    "top_n_gpv_share": dashboard.top_n_gpv_share,
    "decline_rate_decomposition": dashboard.decline_rate_decomposition,
    "retention_by_size_region": dashboard.retention_by_size_region,
    "rolling_28d_gpv": dashboard.rolling_28d_gpv,
}


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeats: int = 3) -> float:
    fn()  # warm-up
    times = []
    for _ in range(repeats):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    raw = Tables.from_raw(spark, sf_dir)
    t0 = time.perf_counter()
    wh = load_warehouse(raw, shared_work_dir(spark, "bench-warehouse"))
    load_s = time.perf_counter() - t0

    results = {"load_warehouse": round(load_s, 3)}
    rows = {}
    for name, fn in HEADLINE.items():
        results[name] = round(timed(lambda fn=fn: run(fn(wh))), 3)
        print(f"{name}: {results[name]}s", file=sys.stderr)
    total = round(sum(v for k, v in results.items() if k != "load_warehouse"), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf_val = float(sf)
    except ValueError:
        sf_val = sf
    _ = rows
    print(json.dumps({"metric": "headline_queries_total_median_sec", "value": total, "unit": "sec",
                      "queries": results, "sf": sf_val, "cpus": cpus,
                      "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions"))}))
    cleanup_work_dirs(spark)
    spark.stop()


if __name__ == "__main__":
    main()
