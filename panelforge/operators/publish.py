"""Publish the whole model: dimensions, facts, the signals panel and a view.

Each table is replaced as a whole on every run (overwrite), like a
create-or-replace of the model.  Facts are written first and the panel is
built from the *written* facts, so every fact is computed exactly once, the
panel's lineage starts at small tables instead of the raw files, and a lost
executor during the panel step never re-reads the raw inputs.

The facts that the panel joins are catalog tables bucketed and sorted by entity.
Joins on (entity, period) and lags per entity both find their rows in the same
bucket, so the panel is built without moving them up to its period means.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import sinks
from . import model, panel


#: Buckets of a fact table: about its bytes / 256 MB, the same for all facts.
BUCKETS = 16
#: Settings of the caller that the panel's own session takes over.
_KEPT = ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions",
         "spark.sql.adaptive.enabled", "spark.sql.ansi.enabled",
         "spark.sql.autoBroadcastJoinThreshold")


def write_bucketed(df: DataFrame, table: str, path: str, entity: str, period: str,
                   buckets: int = BUCKETS) -> None:
    """Replace a catalog table by ``df``, bucketed by entity (one file a bucket)
    and sorted by entity and period."""
    (df.repartition(buckets, entity).write.mode("overwrite").format("parquet")
       .option("path", path).bucketBy(buckets, entity).sortBy(entity, period)
       .saveAsTable(table))


def bucketed_session(spark: SparkSession) -> SparkSession:
    """A session in which tables bucketed by entity count as dealt for joins on
    (entity, period) as well; Spark asks for all join keys otherwise."""
    own = spark.newSession()
    for k in _KEPT:
        own.conf.set(k, spark.conf.get(k))
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return own


def panel_of_tables(spark: SparkSession, price: str, socio: str, complaints: str,
                    **switches) -> DataFrame:
    """The signals panel of three bucketed fact tables."""
    own = bucketed_session(spark)
    return panel.signals_panel(own.table(price), own.table(socio), own.table(complaints),
                               **switches)


@dataclass(frozen=True)
class Published:
    """Where each model table was written, and the catalog names of the facts."""
    base: str
    tables: dict[str, str]
    view: str
    names: dict[str, str]

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.parquet(self.tables[name])


def publish_model(prices: DataFrame, socio: DataFrame, complaints: DataFrame,
                  base: str, view: str = "signals_yearly",
                  how: str = "inner", lag_mode: str = "row",
                  buckets: int = BUCKETS) -> Published:
    """Write the staged sources, dim_entity, dim_category, dim_period, the four
    facts and the signals panel under ``base`` (one Parquet folder each, replaced
    whole; the facts are bucketed catalog tables), then (re)create ``view`` over
    the written panel."""
    spark = prices.sparkSession
    root = base.rstrip("/")
    paths = {}

    def put(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{root}/{name}"
        sinks.write_parquet(df, paths[name])
        return spark.read.parquet(paths[name])

    def staged(name: str, df: DataFrame) -> DataFrame:
        sinks.write_parquet(df, f"{root}/staging/{name}")
        return spark.read.parquet(f"{root}/staging/{name}")

    # each source is worked out once: its rows are needed for dimensions and facts
    prices, socio, complaints = (staged(name, df) for name, df in (
        ("prices", prices), ("socio", socio), ("complaints", complaints)))
    put("dim_entity", model.dim_entity(prices))
    put("dim_category", model.dim_category(complaints))
    put("dim_period", model.dim_period((prices, "year"), (socio, "data_year"),
                                       (complaints, F.year("created_date"))))
    mark = hashlib.sha256(root.encode()).hexdigest()[:12]
    names = {}

    def put_fact(name: str, df: DataFrame) -> str:
        paths[name], names[name] = f"{root}/{name}", f"{name}_{mark}"
        write_bucketed(df, names[name], paths[name], "zip_code", "year", buckets)
        return names[name]

    facts = (put_fact("fct_price", model.fct_price(prices)),
             put_fact("fct_socio", model.fct_socio(socio)),
             put_fact("fct_complaints_total", model.fct_complaints_total(complaints)))
    put_fact("fct_complaints_by_type", model.fct_complaints_by_type(complaints))
    out = put("signals_panel", panel_of_tables(spark, *facts, how=how, lag_mode=lag_mode,
                                               checkpoint=True))
    sinks.create_view(out, view)
    return Published(root, paths, view, names)
