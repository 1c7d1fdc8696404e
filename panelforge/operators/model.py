"""Dimensions and per-period facts of an (entity, period) panel.

Each fact collapses its source to one row per (entity, period).  All of them
are plain grouped aggregates, so Spark plans a map-side partial aggregate
before the only shuffle: what crosses the network is at most one partial row
per (task, group), not the raw rows.  Distinct counts use Spark's two-phase
rewrite, whose first shuffle is keyed by (entity, period, id) and therefore
spreads even a group holding a third of all rows over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import guarded_ratio, period_of, trimmed_key

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------ dimensions ----

def dim_entity(df: DataFrame, key: str = "zip_code",
               attrs: Sequence[str] = ("city", "countyname", "metro", "state",
                                       "statename", "regiontype"),
               out_key: str = "zip_code") -> DataFrame:
    """Distinct (trimmed key, attributes).  Not unique per key when the
    attributes of one key vary – that is the model's definition."""
    return (df.filter(F.col(key).isNotNull())
              .select(trimmed_key(key).alias(out_key), *attrs)
              .distinct())


def dim_category(df: DataFrame, col: str = "complaint_type") -> DataFrame:
    """Distinct non-NULL category values."""
    return df.filter(F.col(col).isNotNull()).select(col).distinct()


def dim_period(*sources: tuple[DataFrame, ColumnOrName],
               name: str = "year") -> DataFrame:
    """Distinct union of period values taken from several sources.

    ``sources`` are (frame, period expression) pairs, e.g.
    ``(prices, "year"), (socio, "data_year"), (events, F.year("created_date"))``.
    The distinct is one aggregate over the union; partial aggregation runs on
    every branch before the shuffle.
    """
    frames = [df.select(_c(expr).alias(name)) for df, expr in sources]
    unioned = reduce(DataFrame.union, frames)
    return unioned.filter(F.col(name).isNotNull()).distinct()


# ----------------------------------------------------------------- facts ----

def fct_mean(df: DataFrame, key: str, period: ColumnOrName, value: str,
             out: str, out_key: str = "zip_code",
             out_period: str = "year") -> DataFrame:
    """AVG(value) per (trimmed key, period); rows with a NULL key, period or
    value are ignored."""
    p = _c(period)
    return (df.filter(F.col(key).isNotNull() & p.isNotNull()
                      & F.col(value).isNotNull())
              .groupBy(trimmed_key(key).alias(out_key), p.alias(out_period))
              .agg(F.avg(value).alias(out)))


def fct_price(prices: DataFrame) -> DataFrame:
    """Average price per entity and year."""
    return fct_mean(prices, "zip_code", "year", "price", "avg_home_price")


SOCIO_MEASURES = ("median_income", "total_pop_over_25", "bachelors_degree",
                  "masters_degree", "professional_degree", "doctorate_degree")
EDU_PARTS = ("bachelors_degree", "masters_degree", "professional_degree",
             "doctorate_degree")


def fct_socio(socio: DataFrame, key: str = "zip_code",
              period: str = "data_year", name: str = "NAME",
              measures: Sequence[str] = SOCIO_MEASURES,
              rate_parts: Sequence[str] = EDU_PARTS,
              rate_den: str = "total_pop_over_25",
              rate_out: str = "higher_edu_count_per_1k_population",
              out_key: str = "zip_code", out_period: str = "year") -> DataFrame:
    """MAX of the name and every measure per (trimmed key, period) – collapses
    duplicate rows – plus a per-thousand rate built from the maxima.

    The rate numerator is summed in double so that large counts never hit
    ANSI integer overflow.
    """
    grouped = (socio.filter(F.col(key).isNotNull() & F.col(period).isNotNull())
                    .groupBy(trimmed_key(key).alias(out_key),
                             F.col(period).alias(out_period))
                    .agg(F.max(name).alias("area_name"),
                         *[F.max(m).alias(m) for m in measures]))
    num = reduce(lambda a, b: a + b,
                 [F.col(p).cast("double") for p in rate_parts])
    return grouped.withColumn(rate_out, guarded_ratio(num, rate_den, 1000.0))


def fct_distinct_count(df: DataFrame, key: str, ts: str, uid: str,
                       extra_keys: Sequence[str] = (),
                       out: str = "complaint_count",
                       out_key: str = "zip_code",
                       out_period: str = "year",
                       grain: str = "year") -> DataFrame:
    """COUNT(DISTINCT uid) per (trimmed key, period of ts, extra keys);
    ``grain`` is ``year`` (int), ``month`` (first day, date) or ``day``.

    Overlapping loads (a row present in a daily and a yearly file) are
    counted once.  NULL keys, timestamps and extra keys are ignored.
    """
    cond = F.col(key).isNotNull() & F.col(ts).isNotNull()
    for k in extra_keys:
        cond = cond & F.col(k).isNotNull()
    return (df.filter(cond)
              .groupBy(trimmed_key(key).alias(out_key),
                       period_of(ts, grain).alias(out_period), *extra_keys)
              .agg(F.countDistinct(uid).alias(out)))


def fct_complaints_total(complaints: DataFrame) -> DataFrame:
    return fct_distinct_count(complaints, "incident_zip", "created_date",
                              "unique_key")


def fct_complaints_by_type(complaints: DataFrame) -> DataFrame:
    return fct_distinct_count(complaints, "incident_zip", "created_date",
                              "unique_key", extra_keys=("complaint_type",))
