"""A period holding a third of all rows: the aggregate-form period mean stays
correct and, when the means cannot be broadcast, AQE splits the hot
partition of the sort-merge join instead of giving it to one task."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from panelforge.operators import panel

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@contextmanager
def conf(spark, values):
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def hot_panel(spark, n=30000):
    ids = spark.range(n)
    period = F.when(F.col("id") < n // 3, F.lit(2000)) \
              .otherwise(F.lit(2001) + (F.col("id") % 40)).cast("int")
    return ids.select(F.col("id").cast("string").alias("zip_code"),
                      period.alias("year"),
                      ((F.col("id") * 7919) % 1000 / 100.0).alias("delta_p"))


def test_hot_period_mean_is_split_and_correct(spark):
    with conf(spark, SKEW_CONF):
        df = hot_panel(spark)
        out = panel.period_mean(df, ["delta_p"], method="aggregate")
        got = {r.year: r.m for r in out.groupBy("year").agg(F.max("city_avg_delta_p").alias("m")).collect()}
        res = out.select("zip_code", "year", "city_avg_delta_p")
        res.collect()
        plan = res._jdf.queryExecution().executedPlan().toString()
    expect = {r.year: r.m for r in df.groupBy("year").agg(F.avg("delta_p").alias("m")).collect()}
    assert got.keys() == expect.keys()
    for y in expect:
        assert got[y] == pytest.approx(expect[y])
    assert "SortMergeJoin" in plan and "skew=true" in plan, plan[:3000]


def test_hot_slice_has_several_writers(spark, tmp):
    """A day that holds a third of all rows is split by size among writers."""
    import os
    from panelforge.sources import sinks
    n = 60_000
    day = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(1 + F.col("id") % 50)
    df = spark.range(0, n, 1, 24).select("id", F.xxhash64("id").alias("x"),
                               F.date_add(F.lit("2024-01-01").cast("date"), day.cast("int")).alias("day"))
    with conf(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
                      "spark.sql.shuffle.partitions": "16"}):
        sinks.overwrite_slices(df, f"{tmp}/t", "day")
    hot = [f for f in os.listdir(f"{tmp}/t/day=2024-01-01") if f.startswith("part-")]
    assert len(hot) > 4
    assert spark.read.parquet(f"{tmp}/t").count() == n


def test_period_means_beyond_the_bound_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(panel, "BROADCAST_PERIODS", 3)
    with conf(spark, SKEW_CONF):
        out = panel.period_mean(hot_panel(spark), ["delta_p"], materialise=True)
        out.collect()
        assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
