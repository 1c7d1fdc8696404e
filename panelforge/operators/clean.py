"""Cleaning jobs: raw string-typed inputs -> typed, filtered datasets.

Raw inputs are read as strings by header name (never by position, never with
schema inference) and typed here with tolerant casts, so one bad cell turns
into a NULL instead of failing the job or flipping a column's type.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse_date, parse_timestamp, safe_cast, safe_cast_columns
from .reshape import DATE_COLUMN, period_columns, unpivot_periods

# ---- fixed values: source field names that must match the raw files ------
# Socio matrix variables -> model column names.
SOCIO_RENAMES = {
    "B19013_001E": "median_income",
    "B15003_001E": "total_pop_over_25",
    "B15003_022E": "bachelors_degree",
    "B15003_023E": "masters_degree",
    "B15003_024E": "professional_degree",
    "B15003_025E": "doctorate_degree",
    "zip code tabulation area": "zip_code",
}
# Population payload variables -> model column names.
POPULATION_RENAMES = {
    "DP05_0001E": "total_population",
    "zip code tabulation area": "zip_code",
}
# Wide price file identity columns -> model column names.
PRICE_ID_RENAMES = {
    "RegionID": "RegionID",
    "SizeRank": "SizeRank",
    "RegionName": "zip_code",
    "RegionType": "regiontype",
    "StateName": "statename",
    "State": "state",
    "City": "city",
    "Metro": "metro",
    "CountyName": "countyname",
}
# ---- end of fixed values --------------------------------------------------

SOCIO_INT_COLUMNS = ("median_income", "total_pop_over_25", "bachelors_degree",
                     "masters_degree", "professional_degree",
                     "doctorate_degree")
COMPLAINT_COLUMNS = ("unique_key", "created_date", "complaint_type",
                     "incident_zip", "community_board", "borough")


def rename_map(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns present in ``mapping`` (others pass through)."""
    present = {k: v for k, v in mapping.items() if k in df.columns and k != v}
    return df.withColumnsRenamed(present) if present else df


def complaints_clean(raw: DataFrame, ts_format: str | None = None,
                     keep: Sequence[str] = ()) -> DataFrame:
    """String-typed complaint rows -> typed rows with a known board.

    ``created_date`` parses to a zone-less timestamp (junk -> NULL, and such a
    row later drops out of the facts); a row is kept when the board is not
    NULL – an empty CSV cell is NULL, a whitespace-only cell is kept.
    ``unique_key`` and ``incident_zip`` stay strings: keys may hold letters,
    and leading zeros survive.
    """
    return (raw.filter(F.col("community_board").isNotNull())
               .select(F.col("unique_key").cast("string"),
                       parse_timestamp("created_date", ts_format)
                       .alias("created_date"),
                       F.col("complaint_type").cast("string"),
                       F.col("incident_zip").cast("string"),
                       F.col("community_board").cast("string"),
                       F.col("borough").cast("string"), *keep))


def filter_allowlist(df: DataFrame, col: str | Column,
                     allow: Sequence | DataFrame,
                     allow_col: str | None = None) -> DataFrame:
    """Keep rows whose ``col`` is in the allow-list.

    A literal list becomes an ``In``/``InSet`` predicate evaluated in the scan
    stage.  A DataFrame allow-list becomes a left-semi join; Spark broadcasts
    it only when its measured size is under the broadcast threshold and uses
    a shuffled semi join otherwise.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(allow, DataFrame):
        a = allow_col or allow.columns[0]
        key = "__allow_key"
        left = df.withColumn(key, c)
        return left.join(allow.select(F.col(a).alias(key)), key,
                         "left_semi").drop(key)
    return df.filter(c.isin(list(allow)))


def prices_clean(wide: DataFrame, allow: Sequence | DataFrame | None = None,
                 pattern: str = DATE_COLUMN) -> DataFrame:
    """Wide monthly price file (all strings) -> one row per entity x month.

    Filter to the allow-list *before* the unpivot (fewer rows to expand),
    discover the month columns from the schema by a strict date pattern,
    unpivot in one pass (``stack``), parse dates and prices tolerantly, drop rows with
    no date or no price.
    """
    df = wide
    if allow is not None:
        df = filter_allowlist(df, F.trim(F.col("RegionName")), allow)
    months = period_columns(df, pattern)
    if not months:
        raise ValueError("no month columns found to unpivot")
    ids = [c for c in PRICE_ID_RENAMES if c in df.columns]
    long = unpivot_periods(df, ids, months, pattern, "date_str", "price")
    long = rename_map(long, PRICE_ID_RENAMES)
    d = parse_date("date_str", "yyyy-MM-dd")
    out = (long.withColumn("date", d)
               .withColumn("year", F.year("date"))
               .withColumn("month", F.month("date"))
               .withColumn("price", safe_cast("price", "double"))
               .drop("date_str")
               .filter(F.col("date").isNotNull() & F.col("price").isNotNull()))
    return out.select("RegionID", "SizeRank", F.trim("zip_code").alias("zip_code"),
                      "regiontype", "statename", "state", "city", "metro",
                      "countyname", "price", "date", "year", "month")


def socio_clean(df: DataFrame, renames: Mapping[str, str] = SOCIO_RENAMES,
                int_columns: Sequence[str] = SOCIO_INT_COLUMNS) -> DataFrame:
    """Renamed, integer-typed socio rows (bad numbers -> NULL)."""
    out = rename_map(df, renames)
    return safe_cast_columns(out, [c for c in int_columns if c in out.columns],
                             "int")


def population_clean(df: DataFrame,
                     renames: Mapping[str, str] = POPULATION_RENAMES) -> DataFrame:
    """Renamed population rows: zip_code, NAME, total_population, data_year."""
    out = rename_map(df, renames)
    return out.select("zip_code", "NAME",
                      safe_cast("total_population", "int")
                      .alias("total_population"),
                      F.col("data_year").cast("int").alias("data_year"))
