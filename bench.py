"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``, forcing full evaluation with a ``noop`` write: one
warm-up pass over all queries, then per query the median of ``$BENCH_RUNS`` (default 3) timed runs.  Prints
one JSON line.  ``BENCH_QUERIES=all`` (or a comma list) widens the set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelforge.plans.catalog import REGISTRY  # noqa: E402
from panelforge.session import build_session, drop_scratch  # noqa: E402

HEADLINE = [
    "signals_panel", "signals_panel_monthly", "period_mean",
    "fct_complaints_total",
    "fct_complaints_by_type", "fct_socio", "fct_price", "unpivot_months",
    "prices_clean", "complaints_clean", "socio_clean", "json_matrix",
    "type_distribution", "table_counts", "full_load_dedup",
    "missing_periods", "daily_load_counts",
]


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - t0
    drop_scratch(spark)
    return took


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    sel = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if sel == "all" else \
        [s for s in sel.split(",") if s] or HEADLINE
    spark = build_session(f"local[{cpus}]", app="panelforge-bench",
                          shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    # One warm-up pass over every query first (JVM JIT, codegen caches,
    # file listings), so the first timed query is not charged for them.
    for name in names:
        run_once(spark, REGISTRY[name], sf_dir)
    out = {}
    for name in names:
        fn = REGISTRY[name]
        out[name] = round(statistics.median(
            run_once(spark, fn, sf_dir) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_median_query_time", "value":
                      round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf}))


if __name__ == "__main__":
    main()
