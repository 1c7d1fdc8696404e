"""Time alternative plans for the same result (median of N noop runs) and
count their shuffles.  Usage: python tools/compare_forms.py [sf_dir] [runs]"""

from __future__ import annotations

import re
import statistics
import sys
import time

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from panelforge.operators import model, reshape  # noqa: E402
from panelforge.plans import bindings as B  # noqa: E402
from panelforge.plans.catalog import build_panel  # noqa: E402
from panelforge.session import build_session  # noqa: E402


def stats(name, make):
    df = make()
    rows = df.count()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    ex = len(re.findall(r"Exchange (hashpartitioning|SinglePartition|RoundRobin)", plan))
    return rows, ex, plan.count("ReusedExchange")


def run_all(variants, runs):
    """Warm every variant up first, then interleave the timed runs
    round-robin, so JIT warm-up and machine drift hit all variants alike."""
    for _, make in variants:
        make().write.format("noop").mode("overwrite").save()
    times = {name: [] for name, _ in variants}
    for _ in range(runs):
        for name, make in variants:
            t0 = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            times[name].append(time.perf_counter() - t0)
    for name, make in variants:
        rows, ex, reused = stats(name, make)
        print(f"| {name} | {statistics.median(times[name]):.2f} | {rows} | {ex} | {reused} |")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 5
    spark = build_session("local[8]", shuffle_partitions=16,
                          extra={"spark.driver.memory": "16g"})
    print("| variant | median s | rows | hash exchanges | reused |")
    print("|---|---|---|---|---|")
    wide = lambda: B.prices_wide(spark, sf)

    def stacked():
        w = wide()
        months = reshape.period_columns(w)
        args = ", ".join(f"'{m}', `{m}`" for m in months)
        return w.selectExpr("RegionName", f"stack({len(months)}, {args}) as (date_str, cell)") \
                .filter(F.col("cell").isNotNull())

    def expand():
        w = wide()
        months = reshape.period_columns(w)
        return w.unpivot(["RegionName"], months, "date_str", "cell") \
                .filter(F.col("cell").isNotNull())

    c = lambda: B.complaints(spark, sf)

    def separate():
        return (model.fct_complaints_total(c()).select(F.lit("t").alias("f"), "zip_code", "year", "complaint_count")
                .unionByName(model.fct_complaints_by_type(c()).select(F.lit("b").alias("f"), "zip_code", "year", "complaint_count")))

    def shared():
        x = c()
        return (model.fct_complaints_total(x).select(F.lit("t").alias("f"), "zip_code", "year", "complaint_count")
                .unionByName(model.fct_complaints_by_type(x).select(F.lit("b").alias("f"), "zip_code", "year", "complaint_count")))

    run_all([
        ("signals_panel, aggregate + join, checkpointed (default)", lambda: build_panel(spark, sf)),
        ("signals_panel, aggregate + join, lazy", lambda: build_panel(spark, sf, checkpoint=False)),
        ("signals_panel, window, lazy", lambda: build_panel(spark, sf, mean_method="window", checkpoint=False)),
    ], runs)
    run_all([("unpivot months, DataFrame.unpivot (Expand)", expand),
             ("unpivot months, stack (Generate)", stacked)], runs)
    run_all([("complaint facts total + by type, separate source frames", separate),
             ("complaint facts total + by type, one shared source frame", shared)], runs)


if __name__ == "__main__":
    main()
