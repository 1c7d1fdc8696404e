"""Stateful streams that lose nothing silently.

* ``window_counts_available_now`` – tumbling windows in append mode; rows that
  come after their window was closed are counted on the side.
* ``dedup_available_now`` – de-duplication against a stored key table, without a
  watermark: a backfill that arrives after newer days is kept.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import utc_instant
from ..operators.clean import complaints_clean
from ..sources.sinks import overwrite_slices
from .ingest import (DELIVERY, EVENT_TIME, FILES_PER_BATCH, KEY_BUCKETS, _bucket, _exists,
                     complaint_file_stream, key_index, latest_per_key, read_key_index,
                     staged_batches)


# ----------------------------------------------------------------- windows --

def window_counts_stream(df: DataFrame, ts: str = "created_date", window: str = "1 day",
                         delay: str = "1 day") -> DataFrame:
    """(window_start, n_rows) of tumbling windows over the event time, read as
    UTC; in append mode a window is given once, when the watermark passes its
    end."""
    return (df.withColumn(EVENT_TIME, utc_instant(ts)).withWatermark(EVENT_TIME, delay)
              .groupBy(F.window(EVENT_TIME, window).alias("w"))
              .agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.col("w.start").alias("window_start"), "n_rows"))


def arrival_counts(batch: DataFrame, ts: str = "created_date",
                   window: str = "1 day") -> DataFrame:
    """(window_start, n_rows) of a batch's rows, late or not; those without an
    event time under a NULL window (Spark's window drops them)."""
    at = batch.select(utc_instant(ts).alias(EVENT_TIME))
    starts = at.filter(F.col(EVENT_TIME).isNotNull()).select(
        F.window(EVENT_TIME, window)["start"].alias("window_start"))
    none = at.filter(F.col(EVENT_TIME).isNull()).select(F.col(EVENT_TIME).alias("window_start"))
    return starts.unionByName(none).groupBy("window_start").agg(F.count(F.lit(1)).alias("n_rows"))


def window_counts_available_now(spark: SparkSession, src_dir: str, out: str, checkpoint: str,
                                ts: str = "created_date", window: str = "1 day",
                                delay: str = "1 day",
                                max_files_per_trigger: int | None = FILES_PER_BATCH) -> DataFrame:
    """Count the files not yet seen into windows and stop; run it again after new
    files land, and it goes on with the open windows it left.  Returns
    ``window_report(spark, out)``.

    Two streams read the same files: one holds the open windows as state and
    appends the closed ones, the other notes every batch's arrivals per window
    (a few rows a batch, overwritten by a replay).  A row that comes after its
    window was closed is in the second only.
    """
    root, state = out.rstrip("/"), checkpoint.rstrip("/")

    def rows() -> DataFrame:
        return complaints_clean(complaint_file_stream(
            spark, src_dir, max_files_per_trigger=max_files_per_trigger))

    def arrivals(batch: DataFrame, epoch_id: int) -> None:
        arrival_counts(batch, ts, window).write.mode("overwrite") \
            .parquet(f"{root}/arrivals/epoch={epoch_id}")

    closed = (window_counts_stream(rows(), ts, window, delay).writeStream
              .outputMode("append").option("checkpointLocation", f"{state}/windows")
              .trigger(availableNow=True).start(f"{root}/windows"))
    seen = (rows().writeStream.foreachBatch(arrivals)
            .option("checkpointLocation", f"{state}/arrivals")
            .trigger(availableNow=True).start())
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda q: q.awaitTermination(), (closed, seen)))
    return window_report(spark, out)


def window_report(spark: SparkSession, out: str) -> DataFrame:
    """(window_start, n_rows, n_late, closed): rows counted in time and rows that
    came too late, per window; an open window has no count yet, and rows without
    an event time (NULL window) never get one."""
    root = out.rstrip("/")
    kind = "window_start timestamp, n_rows long"
    windows = spark.read.schema(kind).parquet(f"{root}/windows")
    arrived = spark.read.schema(kind).parquet(f"{root}/arrivals") \
        .groupBy("window_start").agg(F.sum("n_rows").alias("n_arrived"))
    joined = arrived.join(windows, arrived["window_start"].eqNullSafe(windows["window_start"]), "left")
    closed = F.col("n_rows").isNotNull()
    # a window of which every row came too late was never opened
    last = windows.agg(F.max("window_start").alias("last")).scalar()
    over = closed | (arrived["window_start"] <= last)
    return joined.select(
        arrived["window_start"].alias("window_start"),
        F.when(over, F.coalesce("n_rows", F.lit(0).cast("long"))).alias("n_rows"),
        F.when(over, F.col("n_arrived") - F.coalesce("n_rows", F.lit(0).cast("long")))
         .otherwise(F.lit(0).cast("long")).alias("n_late"),
        F.coalesce(over, F.lit(False)).alias("closed"))


# ----------------------------------------------------------- deduplication --

def dedup_available_now(spark: SparkSession, src_dir: str, target: str, checkpoint: str,
                        key: str = "unique_key", ts: str = "created_date",
                        buckets: int = KEY_BUCKETS,
                        max_files_per_trigger: int | None = FILES_PER_BATCH) -> StreamingQuery:
    """Append the rows of the files not yet seen whose key is not stored yet: the
    first delivery stays.  Rows without a key are all kept.

    The keys stored so far are a table beside the target, bucketed by key hash; a
    batch reads and rewrites the buckets of its keys.  Nothing depends on event
    times, so a year that is backfilled after newer days loses no row.  A batch is
    staged first, so a replay appends nothing twice.
    """
    index = key_index(target, buckets)

    def each(rows: DataFrame, staging: str, epoch_id: int) -> None:
        session = rows.sparkSession
        fresh_path, keys_path = f"{staging}/rows", f"{staging}/keys"
        columns = [c for c in rows.columns if c not in DELIVERY]
        schema = rows.select(*columns).schema
        kind = f"`{key}` {schema[key].dataType.simpleString()}"
        if not _exists(session, f"{keys_path}/_SUCCESS"):
            named = rows.filter(F.col(key).isNotNull()).select(
                key, _bucket(key, buckets).alias("bucket")).distinct()
            hit = [r[0] for r in named.select("bucket").distinct().collect()]
            known = read_key_index(session, index, kind, hit) if _exists(session, index) else \
                session.createDataFrame([], f"{kind}, bucket int")
            new = rows.join(known.select(key), key, "left_anti")
            # the earliest delivery of a key is its latest counted backwards
            order = [(-F.unix_micros("__landed")).alias("__landed"), "__file"]
            latest_per_key(new.select(*columns, *order), key, ("__landed", "__file")) \
                .select(*columns).write.mode("overwrite").parquet(fresh_path)
            known.select(key, "bucket").unionByName(named).distinct() \
                .write.mode("overwrite").parquet(keys_path)
        part = staging.rsplit("/", 1)[1]
        session.read.schema(schema).parquet(fresh_path).write.mode("overwrite") \
            .parquet(f"{target.rstrip('/')}/batch={part}")
        overwrite_slices(session.read.schema(f"{kind}, bucket int").parquet(keys_path),
                         index, "bucket")

    return staged_batches(spark, src_dir, checkpoint, each, ts, max_files_per_trigger)


def deduplicated(spark: SparkSession, target: str, schema) -> DataFrame:
    """The rows that ``dedup_available_now`` has stored."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(target)
