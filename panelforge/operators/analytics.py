"""Analytic extracts over the panel and the facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def preview(df: DataFrame, n: int, order_keys: Sequence[str]) -> DataFrame:
    """First ``n`` rows in grain order (deterministic, unlike a bare LIMIT).
    Planned as a top-k (TakeOrderedAndProject): each task keeps ``n`` rows."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in order_keys]).limit(n)


def top_k(df: DataFrame, metric: str, k: int, columns: Sequence[str],
          tie_keys: Sequence[str]) -> DataFrame:
    """``k`` rows with the largest non-NULL ``metric``; ties broken by the
    grain keys so the result is deterministic."""
    return (df.filter(F.col(metric).isNotNull())
              .select(*columns)
              .orderBy(F.col(metric).desc(),
                       *[F.col(t).asc_nulls_last() for t in tie_keys])
              .limit(k))


def complete_cases(df: DataFrame, columns: Sequence[str],
                   required: Sequence[str]) -> DataFrame:
    """Rows where every ``required`` column is known, projected to
    ``columns`` – a correlation-ready extract."""
    return df.dropna(how="any", subset=list(required)).select(*columns)


def distribution(df: DataFrame, period: str, category: str, value: str,
                 out: str = "total_complaints") -> DataFrame:
    """SUM(value) per (period, category), ordered by period then largest."""
    return (df.groupBy(period, category)
              .agg(F.sum(value).alias(out))
              .orderBy(F.col(period).asc_nulls_last(), F.col(out).desc(),
                       F.col(category).asc_nulls_last()))
