"""Bind the panel model's inputs to the driver's TPC-H-like test tables.

Every binding is a lazy DataFrame derived from the whole tables, so its work
grows with the data.  The oracle SQL (``plans.oracle``) defines the same
bindings as CTEs.

=============  ===============================================================
model input    built from
=============  ===============================================================
prices (long)  orders x customer x nation x region: entity = customer nation,
               period = order year/month, price = order total
prices (wide)  average order total per nation x month-end, one string column
               per month (months with a single order carry ``n/a``)
socio          lineitem x supplier: entity = supplier nation, period = ship
               year, measures taken from line columns
complaints     lineitem x supplier: key = order key (repeats, so the distinct
               count matters), type = return flag || line status, board NULL
               for flag ``N``, zip NULL on line 7
events         events: key = event id, type = event type, zip = user id
population     customers with orders per nation and order year, as payload
               documents
=============  ===============================================================
"""

from __future__ import annotations

import weakref
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import safe_cast
from ..sources.files import pack_payload_docs
from ..operators.clean import complaints_clean
from ..operators.reshape import pivot_periods

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events")


_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = \
    weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table, resolved once per session (like a catalog table): the
    file listing and Parquet footer read happen once, not per query.  The
    test tables are read-only, so the cached listing never goes stale."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    per_session = _TABLES.setdefault(spark, {})
    if path not in per_session:
        per_session[path] = spark.read.parquet(path)
    return per_session[path]


# ------------------------------------------------------------------ prices --

def _orders_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey",
                                              "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey",
                                                "c_mktsegment")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, c.c_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey))


def prices_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean long price rows (one per order)."""
    g = _orders_geo(spark, sf_dir)
    return g.select(
        F.col("o_custkey").cast("string").alias("RegionID"),
        F.col("n_regionkey").cast("string").alias("SizeRank"),
        F.col("c_nationkey").cast("string").alias("zip_code"),
        F.lit("nation").alias("regiontype"),
        F.col("r_name").alias("statename"),
        F.col("n_regionkey").cast("string").alias("state"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("metro"),
        F.col("c_mktsegment").alias("countyname"),
        F.col("o_totalprice").alias("price"),
        F.to_date("o_orderdate").alias("date"),
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
    )


def month_ends(first: str, last: str) -> list[str]:
    """Month-end dates ``yyyy-MM-dd`` of a calendar range (the wide file's
    column names)."""
    import calendar
    y, m = map(int, first.split("-"))
    y2, m2 = map(int, last.split("-"))
    out = []
    while (y, m) <= (y2, m2):
        out.append(f"{y:04d}-{m:02d}-{calendar.monthrange(y, m)[1]:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


WIDE_IDS = ("RegionID", "SizeRank", "RegionName", "RegionType", "StateName",
            "State", "City", "Metro", "CountyName")


def prices_wide(spark: SparkSession, sf_dir: str,
                months: Sequence[str] | None = None) -> DataFrame:
    """Wide raw price file: identity columns plus one string column per
    month end, by default for every month from the first order to the last (one
    aggregate row of the orders alone).  A cell holds the month's average order total, ``n/a`` when
    the month has a single order, NULL when it has none."""
    g = _orders_geo(spark, sf_dir)
    if months is None:
        lo, hi = table(spark, sf_dir, "orders").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM"),
                       F.date_format(F.max("o_orderdate"), "yyyy-MM")).first()
        months = month_ends(lo, hi) if lo else []
    ids = [F.col("n_nationkey").cast("string").alias("RegionID"),
           F.col("n_regionkey").cast("string").alias("SizeRank"),
           F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("RegionName"),
           F.lit("nation").alias("RegionType"),
           F.col("r_name").alias("StateName"),
           F.col("n_regionkey").cast("string").alias("State"),
           F.col("n_name").alias("City"),
           F.col("r_name").alias("Metro"),
           F.col("r_name").alias("CountyName")]
    monthly = (g.groupBy(*ids, F.date_format(F.last_day("o_orderdate"),
                                             "yyyy-MM-dd").alias("month_end"))
                .agg(F.count(F.lit(1)).alias("n"),
                     F.avg("o_totalprice").alias("avg_price"))
                .withColumn("cell", F.when(F.col("n") > 1,
                                           F.col("avg_price").cast("string"))
                                     .otherwise(F.lit("n/a"))))
    return pivot_periods(monthly.filter(F.col("month_end").isNotNull()), WIDE_IDS,
                         "month_end", "cell", list(months), agg="first")


# ------------------------------------------------------ socio / complaints --

def _lines_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name",
                                                "s_nationkey")
    return li.join(s, li.l_suppkey == s.s_suppkey)


def socio(spark: SparkSession, sf_dir: str,
          keep: Sequence[str] = ()) -> DataFrame:
    """Clean socio rows (one per line item), after the line columns ``keep``."""
    g = _lines_geo(spark, sf_dir)
    return g.select(
        *keep,
        F.col("s_name").alias("NAME"),
        F.floor("l_extendedprice").cast("int").alias("median_income"),
        F.col("l_partkey").cast("int").alias("total_pop_over_25"),
        F.col("l_linenumber").cast("int").alias("bachelors_degree"),
        F.floor("l_quantity").cast("int").alias("masters_degree"),
        F.col("l_suppkey").cast("int").alias("professional_degree"),
        F.lit(1).cast("int").alias("doctorate_degree"),
        F.col("s_nationkey").cast("string").alias("zip_code"),
        F.year("l_shipdate").alias("data_year"),
    )


def socio_raw_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Socio rows as a raw source would carry them: source variable names,
    every value a string; plus the order key (document chunking only)."""
    g = _lines_geo(spark, sf_dir)
    return g.select(
        F.col("l_orderkey"),
        F.year("l_shipdate").alias("data_year"),
        F.col("s_name").alias("NAME"),
        F.floor("l_extendedprice").cast("string").alias("B19013_001E"),
        F.col("l_partkey").cast("string").alias("B15003_001E"),
        F.col("l_linenumber").cast("string").alias("B15003_022E"),
        F.floor("l_quantity").cast("string").alias("B15003_023E"),
        F.col("l_suppkey").cast("string").alias("B15003_024E"),
        F.lit("1").alias("B15003_025E"),
        F.col("s_nationkey").cast("string").alias("zip code tabulation area"),
    )


def complaints_raw(spark: SparkSession, sf_dir: str,
                   zip_from: str = "s_nationkey") -> DataFrame:
    """Raw complaint rows, all strings (as read from CSV).  The entity
    (``incident_zip``) is the supplier's nation, or ``zip_from`` (e.g. the
    supplier key for the supplier x month panel)."""
    g = _lines_geo(spark, sf_dir)
    return g.select(
        F.col("l_orderkey").cast("string").alias("unique_key"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss.SSS")
         .alias("created_date"),
        F.concat("l_returnflag", "l_linestatus").alias("complaint_type"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
         .otherwise(F.col(zip_from).cast("string")).alias("incident_zip"),
        F.when(F.col("l_returnflag") == "N", F.lit(None).cast("string"))
         .otherwise(F.col("l_returnflag")).alias("community_board"),
        F.col("s_name").alias("borough"),
    )


def complaints(spark: SparkSession, sf_dir: str,
               zip_from: str = "s_nationkey") -> DataFrame:
    """Clean complaint rows."""
    return complaints_clean(complaints_raw(spark, sf_dir, zip_from))


# ------------------------------------------- supplier x month panel inputs --

def _supplier_month(g: DataFrame) -> list:
    return [F.col("l_suppkey").cast("string").alias("entity"),
            F.trunc("l_shipdate", "month").alias("period")]


def supplier_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-unit line amount of every line, keyed by supplier and ship month.

    Integer-valued prices keep every sum exact, so the per-group mean is the
    same double in any engine (a fractional price lets summation order decide
    6th-decimal rounding ties)."""
    g = _lines_geo(spark, sf_dir)
    return g.select(*_supplier_month(g),
                    F.floor("l_extendedprice").cast("double").alias("price"))


def supplier_socio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The socio measures of ``socio`` keyed by supplier and ship month."""
    g = _lines_geo(spark, sf_dir)
    return g.select(
        F.col("s_name").alias("NAME"),
        F.floor("l_extendedprice").cast("int").alias("median_income"),
        F.col("l_partkey").cast("int").alias("total_pop_over_25"),
        F.col("l_linenumber").cast("int").alias("bachelors_degree"),
        F.floor("l_quantity").cast("int").alias("masters_degree"),
        F.col("l_suppkey").cast("int").alias("professional_degree"),
        F.lit(1).cast("int").alias("doctorate_degree"),
        *_supplier_month(g))


def event_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table seen as a complaint feed (30 days of January 2024)."""
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").cast("string").alias("unique_key"),
                    F.col("ts").alias("created_date"),
                    F.col("event_type").alias("complaint_type"),
                    F.col("user_id").cast("string").alias("incident_zip"),
                    F.col("event_type").alias("community_board"),
                    F.lit("events").alias("borough"))


# ------------------------------------------------------- JSON documents -----

POP_HEADER = ("NAME", "DP05_0001E", "zip code tabulation area")


def population_docs(spark: SparkSession, sf_dir: str,
                    rows_per_doc: int = 10) -> DataFrame:
    """Payload documents ``{year, header, data}``: customers with orders per
    nation and year.  Rows are aggregated first (partial aggregation), then
    packed into documents of at most ``rows_per_doc`` nations each, so no
    document – and no task building one – grows with the data.
    Columns: data_year, chunk, value (JSON text)."""
    g = _orders_geo(spark, sf_dir)
    per = (g.groupBy(F.year("o_orderdate").alias("data_year"), "c_nationkey",
                     "n_name")
            .agg(F.countDistinct("o_custkey").alias("n")))
    rows = per.select(
        "data_year",
        F.floor(F.col("c_nationkey") / rows_per_doc).alias("chunk"),
        F.col("n_name").alias(POP_HEADER[0]),
        F.col("n").cast("string").alias(POP_HEADER[1]),
        F.col("c_nationkey").cast("string").alias(POP_HEADER[2]))
    return pack_payload_docs(rows, "data_year", POP_HEADER, ["chunk"])


CUSTOMER_FIELDS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                   "c_mktsegment")


def customer_matrix_docs(spark: SparkSession, sf_dir: str,
                         rows_per_doc: int = 1000) -> DataFrame:
    """Matrix documents ``[[header], [row], ...]`` of the customer table,
    one per (nation, key range of ``rows_per_doc``).  Odd documents list
    their columns in reverse order; a negative balance is written ``N/A``.
    Columns: doc_id, value (JSON text)."""
    c = table(spark, sf_dir, "customer")
    cells = {
        "c_custkey": F.col("c_custkey").cast("string"),
        "c_name": F.col("c_name"),
        "c_nationkey": F.col("c_nationkey").cast("string"),
        "c_acctbal": F.when(F.col("c_acctbal") < 0, F.lit("N/A"))
                      .otherwise(F.col("c_acctbal").cast("string")),
        "c_mktsegment": F.col("c_mktsegment"),
    }
    fwd, rev = list(CUSTOMER_FIELDS), list(reversed(CUSTOMER_FIELDS))
    chunk = F.floor(F.col("c_custkey") / rows_per_doc)
    odd = (chunk % 2) == 1
    row = F.when(odd, F.array(*[cells[f] for f in rev])) \
           .otherwise(F.array(*[cells[f] for f in fwd]))
    rows = c.select(F.col("c_nationkey").alias("nation"), chunk.alias("chunk"),
                    row.alias("row"))
    docs = rows.groupBy("nation", "chunk").agg(F.collect_list("row").alias("data"))
    header = F.when((F.col("chunk") % 2) == 1,
                    F.array(*[F.lit(f) for f in rev])) \
              .otherwise(F.array(*[F.lit(f) for f in fwd]))
    return docs.select(
        F.concat_ws("-", "nation", "chunk").alias("doc_id"),
        F.to_json(F.concat(F.array(header), F.col("data"))).alias("value"))


def typed_customer_rows(rows: DataFrame) -> DataFrame:
    """String customer cells -> the table's types (bad numbers -> NULL)."""
    return rows.select(safe_cast("c_custkey", "bigint").alias("c_custkey"),
                       "c_name",
                       safe_cast("c_nationkey", "int").alias("c_nationkey"),
                       safe_cast("c_acctbal", "double").alias("c_acctbal"),
                       "c_mktsegment")
