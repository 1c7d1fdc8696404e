"""Column-level building blocks (all JVM-side, codegen friendly; no UDFs).

Every helper takes and returns ``Column`` objects so they compose inside a
single ``select`` / ``withColumns`` and stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- typing ----

def safe_cast(c: ColumnOrName, to: str | T.DataType) -> Column:
    """Cast that yields NULL for unparsable input instead of failing.

    ANSI mode is on in Spark 4, so a plain ``cast`` raises on bad strings;
    ``try_cast`` keeps the tolerant behaviour.  ``' 12 '`` parses as 12,
    ``'12.7'`` and ``'N/A'`` become NULL for integral targets.
    """
    return _c(c).try_cast(to)


def safe_cast_columns(df: DataFrame, columns: Iterable[str],
                      to: str | T.DataType) -> DataFrame:
    """``try_cast`` a list of columns in one projection."""
    return df.withColumns({c: safe_cast(c, to) for c in columns})


def parse_timestamp(c: ColumnOrName, fmt: str | None = None) -> Column:
    """Zone-less timestamp parse; NULL for junk (never raises)."""
    if fmt is None:
        return _c(c).try_cast("timestamp_ntz")
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("timestamp_ntz")


def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """Date parse with a pattern; NULL for junk (never raises)."""
    return F.try_to_date(_c(c), fmt) if hasattr(F, "try_to_date") else \
        F.to_date(F.try_to_timestamp(_c(c), F.lit(fmt)))


def utc_instant(c: ColumnOrName) -> Column:
    """A zone-less timestamp's wall clock read as UTC, as a ``TIMESTAMP``.

    Streaming watermarks need ``TIMESTAMP``; a plain cast would read the wall
    clock in the session time zone (and shift day windows with it).  Built
    from the wall-clock parts with an explicit UTC zone, the instant – and any
    window over it – is the same in every session."""
    x = _c(c)
    return F.make_timestamp(F.year(x), F.month(x), F.dayofmonth(x), F.hour(x),
                            F.minute(x), F.date_part(F.lit("SECOND"), x),
                            F.lit("UTC"))


def utc_date(instant: ColumnOrName) -> Column:
    """Calendar date (UTC) of a ``TIMESTAMP``, independent of the session."""
    return F.date_from_unix_date(
        F.floor(F.unix_seconds(_c(instant)) / 86400).cast("int"))


def trimmed_key(c: ColumnOrName) -> Column:
    """Entity keys are compared trimmed."""
    return F.trim(_c(c))


def period_of(c: ColumnOrName, grain: str = "year") -> Column:
    """Calendar period of a timestamp/date: year (int), month (date of the
    month's first day) or day (date)."""
    if grain == "year":
        return F.year(_c(c))
    if grain == "month":
        return F.trunc(_c(c), "month")
    if grain == "day":
        return F.to_date(_c(c))
    raise ValueError(f"unknown period grain {grain!r}")


# ------------------------------------------------------------ arithmetic ----

def guarded_ratio(num: ColumnOrName, den: ColumnOrName,
                  scale: float = 1.0) -> Column:
    """``num / den * scale`` when ``den`` is known and positive, else NULL.

    Division is always double (``int / int`` is double in Spark SQL).
    """
    n, d = _c(num), _c(den)
    return F.when(d.isNotNull() & (d > 0),
                  n.cast("double") / d.cast("double") * F.lit(float(scale)))


def rate_per_k(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Rate per thousand with a zero/NULL denominator guard."""
    return guarded_ratio(num, den, 1000.0)


def relative_change(cur: ColumnOrName, prev: ColumnOrName) -> Column:
    """``(cur - prev) / prev`` when ``prev`` is known and non-zero, else NULL.

    A negative ``prev`` passes the guard (no range check), as in the model.
    """
    c, p = _c(cur), _c(prev)
    return F.when(p.isNotNull() & (p != 0),
                  (c.cast("double") - p.cast("double")) / p.cast("double"))


def signal_product(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Same-period product of two changes; NULL if either is NULL."""
    return _c(a) * _c(b)


# ------------------------------------------------------------ predicates ----

def closed_window(c: ColumnOrName, lo, hi) -> Column:
    """``lo <= c <= hi`` (both ends included, like a 00:00:00..23:59:59 day
    window, which loses the last fractional second)."""
    return _c(c).between(F.lit(lo), F.lit(hi))


def half_open_window(c: ColumnOrName, lo, hi) -> Column:
    """``lo <= c < hi`` – the loss-free day window."""
    x = _c(c)
    return (x >= F.lit(lo)) & (x < F.lit(hi))


def days_ago(n: int) -> Column:
    """The date ``n`` days before today (e.g. the default load date of a
    daily run: data of two days ago)."""
    return F.date_sub(F.current_date(), n)


def run_day(run_date, back: int = 0) -> Column:
    """The date ``back`` days before a run date, which may be a date, a
    ``yyyy-MM-dd`` string, a Column (also a scalar subquery) or None for today."""
    d = F.current_date() if run_date is None else \
        run_date if isinstance(run_date, Column) else F.lit(run_date)
    return F.date_sub(d.cast("date"), back)


def rolling_days(day: ColumnOrName, run_date=None, back: int = 2, days: int = 1) -> Column:
    """Rows of ``days`` days ending ``back`` days before the run date.  On a day
    partition column the bounds prune partitions, at planning time for a literal
    run date, at run time for a scalar subquery."""
    x = _c(day)
    return (x >= run_day(run_date, back + days - 1)) & (x <= run_day(run_date, back))


def rolling_year(year: ColumnOrName, run_date=None, back: int = 0) -> Column:
    """Rows of the year ``back`` years before the run date's."""
    return _c(year) == F.year(run_day(run_date)) - back


def day_bounds(day: str | Column, closed: bool = False):
    """Zone-less timestamp bounds of one calendar day (a ``yyyy-MM-dd``
    string or a date Column): ``[00:00:00, next midnight)``, or on request the
    closed ``[00:00:00, 23:59:59]``, which loses the last fractional second."""
    d = F.lit(day).cast("date") if isinstance(day, str) else day.cast("date")
    lo = d.cast("timestamp_ntz")
    if closed:
        return lo, lo + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")
    return lo, F.date_add(d, 1).cast("timestamp_ntz")


def in_day(c: ColumnOrName, day: str | Column, closed: bool = False) -> Column:
    lo, hi = day_bounds(day, closed)
    return _c(c).between(lo, hi) if closed else (_c(c) >= lo) & (_c(c) < hi)


def in_year(c: ColumnOrName, year: int, closed: bool = False) -> Column:
    lo = F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz")
    if closed:
        hi = F.lit(f"{year}-12-31 23:59:59").cast("timestamp_ntz")
        return _c(c).between(lo, hi)
    hi = F.lit(f"{year + 1}-01-01 00:00:00").cast("timestamp_ntz")
    return (_c(c) >= lo) & (_c(c) < hi)


# -------------------------------------------------------------- output ----

def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (for cross-engine comparison only)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
