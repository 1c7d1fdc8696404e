"""Data-quality checks: grain, counts, missingness, NULL keys, periods, load
counts, landing caps, missing periods and overlapping-load de-duplication.

Every check is an aggregate over the whole input, returned as a small
DataFrame; nothing is collected inside the library.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Fail fast on an empty input (a job that would silently publish an
    empty dataset).  Costs one ``LIMIT 1`` probe, not a count."""
    if df.isEmpty():
        raise ValueError(f"no usable rows in {what}")
    return df


def grain_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations occurring more than once (expected: none),
    most duplicated first, keys as tie-break."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
              .filter(F.col("row_count") > 1)
              .orderBy(F.col("row_count").desc(),
                       *[F.col(k).asc_nulls_last() for k in keys]))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One (table_name, row_count) row per named frame, in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionAll, parts)


def missingness(df: DataFrame, columns: Mapping[str, str],
                total: str = "total_rows") -> DataFrame:
    """Total rows and non-NULL counts of several columns in one pass."""
    return df.agg(F.count(F.lit(1)).alias(total),
                  *[F.count(F.col(c)).alias(out) for out, c in columns.items()])


def null_key_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, null_keys): rows whose key column is NULL, per table."""
    parts = [df.agg(F.count_if(F.col(key).isNull()).alias("null_keys"))
               .select(F.lit(name).alias("table_name"), "null_keys")
             for name, (df, key) in tables.items()]
    return reduce(DataFrame.unionAll, parts)


def distinct_periods(tables: Mapping[str, tuple[DataFrame, ColumnOrName]],
                     name: str = "year") -> DataFrame:
    """(source, period) for every distinct period of every source, ordered
    (a NULL period sorts last)."""
    parts = [df.select(F.lit(src).alias("source"), _c(expr).alias(name))
               .distinct()
             for src, (df, expr) in tables.items()]
    return (reduce(DataFrame.unionAll, parts)
            .orderBy("source", F.col(name).asc_nulls_last()))


def load_counts(df: DataFrame, ts: str, grain: str = "day") -> DataFrame:
    """Raw row count per calendar day (``load_date``) or year
    (``load_year``) – overlapping loads are counted every time."""
    if grain == "day":
        key = F.to_date(ts).alias("load_date")
        out = "daily_count"
    elif grain == "year":
        key = F.year(ts).alias("load_year")
        out = "yearly_count"
    else:
        raise ValueError(f"unknown grain {grain!r}")
    res = df.groupBy(key).agg(F.count(F.lit(1)).alias(out))
    return res.orderBy(F.col(res.columns[0]).asc_nulls_last())


def cap_check(df: DataFrame, ts: str, cap: int) -> DataFrame:
    """Per-day row count and whether it reached a landing cap (a capped pull
    silently truncates, so reaching the cap means rows may be missing)."""
    daily = df.groupBy(F.to_date(ts).alias("day")) \
              .agg(F.count(F.lit(1)).alias("n_rows"))
    return daily.withColumn("at_cap", F.col("n_rows") >= F.lit(cap))


def missing_periods(candidates: DataFrame, present: DataFrame,
                    keys: Sequence[str]) -> DataFrame:
    """Candidate (entity, period, ...) combinations absent from ``present``:
    a distinct left-anti join, so nothing already landed is redone."""
    return (candidates.select(*keys).distinct()
            .join(present.select(*keys).distinct(), list(keys), "left_anti"))


def overlap_dedup_counts(loaded: DataFrame, key: str, ts: str) -> DataFrame:
    """Per year: raw loaded rows vs distinct keys.  The difference is the
    double counting a raw COUNT(*) would report after overlapping loads."""
    return (loaded.filter(F.col(ts).isNotNull())
                  .groupBy(F.year(ts).alias("year"))
                  .agg(F.count(F.lit(1)).alias("raw_rows"),
                       F.countDistinct(key).alias("distinct_keys")))
