"""The signals panel: join per-period facts, lag, relative change, period
means, demeaning and paired-change signals.

Shuffle plan at scale (entity x period facts of any size):

* the three facts come out of aggregates hash-partitioned on
  (entity, period); the equi-joins on exactly those keys reuse that
  partitioning (sort-merge without a new exchange), and AQE turns them into
  broadcast joins at runtime only when a fact is measured to be small;
* LAG needs rows of one entity together: one exchange by entity.  A panel has
  one row per (entity, period), so no entity can be hot;
* the period mean is *not* a window over ``PARTITION BY period`` by default:
  with a handful of periods that puts every entity of a period into a single
  task.  Instead a grouped aggregate (map-side partial sums, one row per
  period after the shuffle) is materialised, counted and broadcast if it is
  under a stated bound, so the panel is not shuffled; beyond the bound the join
  is a skew-split sort-merge join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rate_per_k, relative_change, signal_product
from ..session import ensure_checkpoint_dir

ENTITY, PERIOD = "zip_code", "year"

# Period means that may be broadcast (five numbers each: under 1 MB).
BROADCAST_PERIODS = 10_000

# Metric -> name of its lagged copy, in output order.
LAGGED = {
    "avg_home_price": "prev_avg_home_price",
    "complaints_per_1k_population": "prev_complaints_per_1k_population",
    "median_income": "prev_median_income",
    "higher_edu_count_per_1k_population":
        "prev_higher_edu_count_per_1k_population",
}
# Change column -> metric it is computed from.
DELTAS = {
    "delta_p": "avg_home_price",
    "delta_c": "complaints_per_1k_population",
    "delta_income": "median_income",
    "delta_edu": "higher_edu_count_per_1k_population",
}


def join_facts(price: DataFrame, socio: DataFrame, complaints: DataFrame,
               how: str = "inner", entity: str = ENTITY,
               period: str = PERIOD) -> DataFrame:
    """Price x socio (inner) x complaint total (``how``, inner by default).

    With the default inner join an (entity, period) without complaints is
    dropped, so the COALESCE to 0 only matters for ``how="left"``.
    """
    keys = [entity, period]
    s = socio.select(*keys, "median_income", "total_pop_over_25",
                     "bachelors_degree", "masters_degree",
                     "professional_degree", "doctorate_degree",
                     "higher_edu_count_per_1k_population")
    c = complaints.select(*keys, "complaint_count")
    joined = (price.select(*keys, "avg_home_price")
                   .join(s, keys, "inner")
                   .join(c, keys, how))
    return joined.select(
        *keys, "avg_home_price", "median_income", "total_pop_over_25",
        "bachelors_degree", "masters_degree", "professional_degree",
        "doctorate_degree", "higher_edu_count_per_1k_population",
        F.coalesce(F.col("complaint_count"), F.lit(0).cast("bigint"))
         .alias("total_complaint_count"))


def add_complaint_rate(df: DataFrame, count: str = "total_complaint_count",
                       den: str = "total_pop_over_25",
                       out: str = "complaints_per_1k_population") -> DataFrame:
    """Complaints per thousand of the denominator population (NULL when the
    population is unknown or not positive)."""
    return df.withColumn(out, rate_per_k(count, den))


def _calendar_index(df: DataFrame, period: str, unit: str):
    """An integer that steps by one per calendar period: the period itself
    for integer periods (years), ``year*12+month`` for month periods given as
    dates, days since the epoch for day periods."""
    p = F.col(period)
    is_date = dict(df.dtypes)[period] in ("date", "timestamp", "timestamp_ntz")
    if unit == "auto":
        unit = "month" if is_date else "number"
    if unit == "number":
        return p
    if unit == "month":
        return F.year(p) * 12 + F.month(p)
    if unit == "day":
        return F.unix_date(p.cast("date"))
    raise ValueError(f"unknown calendar unit {unit!r}")


def lag_metrics(df: DataFrame, metrics: Mapping[str, str] = LAGGED,
                entity: str = ENTITY, period: str = PERIOD,
                mode: str = "row", unit: str = "auto") -> DataFrame:
    """Previous value of each metric within an entity, ordered by period.

    ``mode="row"``: the previous *row* (a missing period is skipped over).
    ``mode="calendar"``: the value of exactly one calendar step earlier
    (NULL across a gap).  ``unit`` says what a step is: ``number`` (integer
    periods such as years), ``month`` (date periods, the default for dates)
    or ``day``.
    All metrics share one window specification, so Spark evaluates them in a
    single Window operator after a single exchange by entity.
    """
    if mode == "row":
        w = Window.partitionBy(entity).orderBy(F.col(period).asc())
        cols = {out: F.lag(m, 1).over(w) for m, out in metrics.items()}
    elif mode == "calendar":
        wr = (Window.partitionBy(entity)
                    .orderBy(_calendar_index(df, period, unit).asc())
                    .rangeBetween(-1, -1))
        cols = {out: F.first(m).over(wr) for m, out in metrics.items()}
    else:
        raise ValueError(f"unknown lag mode {mode!r}")
    return df.withColumns(cols)


def add_relative_changes(df: DataFrame, deltas: Mapping[str, str] = DELTAS,
                         lagged: Mapping[str, str] = LAGGED) -> DataFrame:
    """``(x - prev) / prev`` per metric, NULL when prev is NULL or zero."""
    return df.withColumns({out: relative_change(m, lagged[m])
                           for out, m in deltas.items()})


def add_signal(df: DataFrame, out: str = "correlation_signal",
               a: str = "delta_p", b: str = "delta_c") -> DataFrame:
    """Product of two same-period changes."""
    return df.withColumn(out, signal_product(a, b))


def period_mean(df: DataFrame, cols: Sequence[str] = tuple(DELTAS),
                period: str = PERIOD, prefix: str = "city_avg_",
                method: str = "aggregate",
                materialise: bool = False) -> DataFrame:
    """Unweighted mean of each column over all entities of the same period,
    attached to every row (NULLs ignored; all-NULL period -> NULL).

    ``method="window"`` is ``AVG(c) OVER (PARTITION BY period)``;
    ``method="aggregate"`` computes the same numbers as a grouped aggregate
    joined back on the period (null-safe), which keeps partial aggregation and
    never routes a whole period through one task.

    ``materialise=True`` checkpoints the means (one row per period) and counts
    them first: up to ``BROADCAST_PERIODS`` of them are broadcast, so the frame
    itself is not shuffled; beyond that the join is an ordinary one, which the
    adaptive planner splits at hot periods.
    """
    names = {c: f"{prefix}{c}" for c in cols}
    if method == "window":
        w = Window.partitionBy(period)
        return df.withColumns({names[c]: F.avg(c).over(w) for c in cols})
    if method != "aggregate":
        raise ValueError(f"unknown period-mean method {method!r}")
    key = "__period_key"
    means = (df.groupBy(F.col(period).alias(key))
               .agg(*[F.avg(c).alias(names[c]) for c in cols]))
    if materialise:
        ensure_checkpoint_dir(df.sparkSession)
        means = means.checkpoint(eager=True)
        if means.count() <= BROADCAST_PERIODS:
            means = F.broadcast(means)
    out = df.join(means, F.col(period).eqNullSafe(F.col(key)), "left")
    return out.drop(key)


def demean(df: DataFrame, cols: Sequence[str] = tuple(DELTAS),
           mean_prefix: str = "city_avg_",
           prefix: str = "adjusted_") -> DataFrame:
    """Column minus its period mean."""
    return df.withColumns({f"{prefix}{c}": F.col(c) - F.col(f"{mean_prefix}{c}")
                           for c in cols})


PANEL_COLUMNS = [
    "zip_code", "year", "avg_home_price", "median_income",
    "total_pop_over_25", "bachelors_degree", "masters_degree",
    "professional_degree", "doctorate_degree",
    "higher_edu_count_per_1k_population", "total_complaint_count",
    "complaints_per_1k_population",
    *LAGGED.values(), *DELTAS, "correlation_signal",
    *[f"city_avg_{d}" for d in DELTAS],
    *[f"adjusted_{d}" for d in DELTAS],
    "adjusted_correlation_signal",
]


def panel_columns(entity: str = ENTITY, period: str = PERIOD) -> list[str]:
    """The 30 output columns, with the given entity/period column names."""
    return [entity, period, *PANEL_COLUMNS[2:]]


def signals_panel(price: DataFrame, socio: DataFrame, complaints: DataFrame,
                  how: str = "inner", lag_mode: str = "row",
                  mean_method: str = "aggregate",
                  upto: str | None = None, entity: str = ENTITY,
                  period: str = PERIOD, checkpoint: bool = False) -> DataFrame:
    """The full 30-column (entity, period) signals panel.

    The three facts must carry ``entity`` and ``period`` columns (any grain:
    zip x year, supplier x month, ...).  ``upto`` cuts the pipeline after a
    named step (``join``, ``rate``, ``lag``, ``delta``, ``signal``, ``mean``,
    ``demean``) – used to check each step on its own.

    ``checkpoint=True`` writes the panel after the signal step to the
    cluster's shared checkpoint folder (``spark.checkpoint.dir``) before the
    period-mean self-join: both join branches then read the materialised
    rows instead of re-evaluating the joined and lagged facts, and a lost
    executor no longer forces the raw fact aggregations to be recomputed.
    This runs a job when called (an eager checkpoint).
    """
    steps = ["join", "rate", "lag", "delta", "signal", "mean", "demean",
             "adjusted"]
    stop = steps.index(upto) if upto else len(steps) - 1
    df = join_facts(price, socio, complaints, how=how, entity=entity,
                    period=period)
    if stop >= 1:
        df = add_complaint_rate(df)
    if stop >= 2:
        df = lag_metrics(df, entity=entity, period=period, mode=lag_mode)
    if stop >= 3:
        df = add_relative_changes(df)
    if stop >= 4:
        df = add_signal(df)
    if stop >= 5:
        if checkpoint:
            ensure_checkpoint_dir(df.sparkSession)
            df = df.checkpoint(eager=True)
        df = period_mean(df, period=period, method=mean_method,
                         materialise=checkpoint)
    if stop >= 6:
        df = demean(df)
    if stop >= 7:
        df = add_signal(df, "adjusted_correlation_signal",
                        "adjusted_delta_p", "adjusted_delta_c")
        df = df.select(*panel_columns(entity, period))
    return df
