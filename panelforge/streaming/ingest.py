"""Incremental, de-duplicated complaint-file ingest with Structured Streaming.

* ``ingest_available_now`` – new CSV files in a landing folder are cleaned and
  merged into a day-partitioned Parquet table.  Every micro-batch re-writes only
  the days it touches (also days that hold older versions of its keys) and keeps
  one row per key, the latest delivery; which days those are, an index bucketed
  by key hash says.  A batch is staged before it is swapped in, and a finished
  stage is used again by a replay of that batch, so a job that dies in the middle
  of a swap loses nothing.
* ``dedup_stream`` – streaming de-duplication on the event key with a
  watermark (state is bounded by the watermark delay).
* ``daily_counts_stream`` – tumbling one-day counts with a watermark.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import utc_date, utc_instant
from ..operators.clean import COMPLAINT_COLUMNS, complaints_clean
from ..session import delete_path
from ..sources.files import literal_path, read_csv_by_header
from ..sources.sinks import overwrite_slices

#: Files of one micro-batch (a first backfill then comes in several batches).
FILES_PER_BATCH = 1000
#: Buckets of a table's key index, fixed for its life (they are in its name).
KEY_BUCKETS = 256
#: Delivery columns that a batch may carry: the later, the better.
DELIVERY = ("__epoch", "__landed", "__file")


def complaint_file_stream(spark: SparkSession, src_dir: str,
                          columns: Sequence[str] = COMPLAINT_COLUMNS,
                          max_files_per_trigger: int | None = FILES_PER_BATCH) -> DataFrame:
    """Streaming read of header CSV files, every column a string.

    A streaming CSV source binds its schema by position; with
    ``enforceSchema`` off, a file whose header differs fails the query instead
    of being misread.  ``ingest_available_now`` has no such restriction.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    r = (spark.readStream.schema(schema).option("header", "true")
              .option("enforceSchema", "false").option("multiLine", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(src_dir)


def landed_files(spark: SparkSession, src_dir: str,
                 max_files_per_trigger: int | None = FILES_PER_BATCH) -> DataFrame:
    """Streaming (path, modificationTime) of new files; contents are not read."""
    schema = T.StructType([T.StructField("path", T.StringType()),
                           T.StructField("modificationTime", T.TimestampType()),
                           T.StructField("length", T.LongType()),
                           T.StructField("content", T.BinaryType())])
    r = spark.readStream.format("binaryFile").schema(schema) \
        .option("recursiveFileLookup", "true").option("pathGlobFilter", "[!_.]*")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(src_dir).select("path", "modificationTime")


def _exists(spark: SparkSession, path: str) -> bool:
    """Path test through the cluster file system (any scheme)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def latest_per_key(df: DataFrame, key: str, order: str | Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest ``order`` values, then the
    largest content (so ties do not depend on row order).  Rows without a key
    cannot be told apart and are all kept.

    ``max_by`` over a struct of the row is a declarative aggregate, so Spark
    pre-aggregates map-side: many copies of one key (a re-delivered file, a
    hot key) collapse inside each task before the shuffle instead of all
    landing in one task as a window over the key would."""
    order = [order] if isinstance(order, str) else list(order)
    cols = [c for c in df.columns if c != key and c not in order]
    rank = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in cols])
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), rank)
    known = (df.filter(F.col(key).isNotNull()).groupBy(key).agg(best.alias("__best"))
               .select(key, *[F.col(f"__best.{c}").alias(c) for c in cols]))
    return known.unionByName(df.filter(F.col(key).isNull()).select(key, *cols))


def _in_days(day: str, days: Sequence) -> F.Column:
    """Partition predicate for some days, of which NULL may be one."""
    known = [d for d in days if d is not None]
    hit = F.col(day).isin(known) if known else F.lit(False)
    return hit | F.col(day).isNull() if len(known) < len(days) else hit


def key_index(target: str, buckets: int) -> str:
    """Folder of the table's key index: (key, day) by bucket of the key's hash."""
    return f"{target.rstrip('/')}_keys{buckets}"


def _bucket(key: str, buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def read_key_index(spark: SparkSession, index: str, columns: str, touched: Sequence[int]) -> DataFrame:
    """The index rows of some buckets; other buckets' files are not listed."""
    return spark.read.schema(f"{columns}, bucket int").parquet(index) \
        .filter(F.col("bucket").isin(list(touched)))


def _write_index(rows: DataFrame, index: str) -> None:
    overwrite_slices(rows, index, "bucket")


def merge_into_days(batch: DataFrame, target: str, staging: str,
                    key: str = "unique_key", day: str = "day",
                    epoch: int = 0, buckets: int = KEY_BUCKETS) -> None:
    """Merge one batch into a day-partitioned table, one row per key; a key
    delivered again replaces the stored row, also when its day has changed
    (latest delivery wins).  Rows without a day are a slice of their own.

    An index beside the table says which day holds a key.  The days that the
    batch touches and, from the index buckets of its keys, the days that hold
    them so far are read back, reduced to the latest row per key and staged
    together with the list of those days and the new content of those buckets;
    lists of days and of buckets are bounded by the calendar and ``buckets``.
    Then the staged days and buckets replace the stored ones, and a day that has
    no row left is removed.  If the staged folder is complete, the batch was
    staged before: only the swap is done again; delete it once the batch is done.
    A table without an index gets one by one scan of its keys.
    """
    spark = batch.sparkSession
    rows, touched, keys = (f"{staging.rstrip('/')}/{x}" for x in ("rows", "days", "keys"))
    columns = [c for c in batch.columns if c not in DELIVERY]
    schema = batch.select(*columns).schema
    index = key_index(target, buckets)
    pairs = f"`{key}` {schema[key].dataType.simpleString()}, `{day}` {schema[day].dataType.simpleString()}"
    if not _exists(spark, f"{touched}/_SUCCESS"):
        marked = batch.withColumn("__epoch", F.lit(epoch).cast("bigint"))
        order = [c for c in DELIVERY if c in marked.columns]
        days = {r[0] for r in batch.select(day).distinct().collect()}
        if not days:
            return
        known = batch.select(key, _bucket(key, buckets).alias("bucket")) \
            .filter(F.col(key).isNotNull()).distinct()
        hit = [r[0] for r in known.select("bucket").distinct().collect()]
        before = spark.createDataFrame([], f"{pairs}, bucket int")
        # The table folder exists once a first non-empty batch was stored (a
        # dynamic partition overwrite leaves no _SUCCESS marker at the root).
        if _exists(spark, target):
            stored = spark.read.schema(schema).parquet(target)
            if not _exists(spark, index):
                _write_index(stored.filter(F.col(key).isNotNull())
                             .select(key, day, _bucket(key, buckets).alias("bucket")), index)
            if hit and _exists(spark, index):
                before = read_key_index(spark, index, pairs, hit)
            days |= {r[0] for r in before.join(known.select(key), key, "left_semi")
                     .select(day).distinct().collect()}
            older = stored.filter(_in_days(day, list(days))) \
                .withColumn("__epoch", F.lit(-1).cast("bigint"))
            marked = marked.select(*columns, *order).unionByName(
                older, allowMissingColumns=True)
        latest_per_key(marked, key, order).select(*columns) \
            .write.mode("overwrite").parquet(rows)
        now = spark.read.schema(schema).parquet(rows).select(key, day) \
            .join(known, key).select(key, day, "bucket")
        before.join(known.select(key), key, "left_anti").select(key, day, "bucket") \
            .unionByName(now).write.mode("overwrite").parquet(keys)
        spark.createDataFrame([(d,) for d in days], T.StructType([schema[day]])) \
            .coalesce(1).write.mode("overwrite").parquet(touched)
    staged = spark.read.schema(schema).parquet(rows)
    overwrite_slices(staged, target, day)
    left = {r[0] for r in staged.select(day).distinct().collect()}
    for (d,) in spark.read.parquet(touched).collect():
        if d not in left:
            name = "__HIVE_DEFAULT_PARTITION__" if d is None else d
            delete_path(spark, f"{target.rstrip('/')}/{day}={name}")
    _write_index(spark.read.schema(f"{pairs}, bucket int").parquet(keys), index)


def stream_id(spark: SparkSession, state: str) -> str:
    """The id that Spark gave the stream of this checkpoint folder."""
    return json.loads(spark.read.text(f"{state}/metadata").first()[0])["id"]


def ingest_available_now(spark: SparkSession, src_dir: str, target: str,
                         checkpoint: str, key: str = "unique_key",
                         ts: str = "created_date",
                         max_files_per_trigger: int | None = FILES_PER_BATCH,
                         wait: bool = True) -> StreamingQuery:
    """Process every file not yet seen (``availableNow``) and stop.

    The stream delivers file names; a batch reads its files by their own headers,
    so files may order their columns differently or carry more of them.
    Progress (which files were consumed) lives in ``checkpoint``; run it
    again after new files land and only those are read.

    A staged batch is named by its stream, its number and its files (with their
    times), so it is taken up again by a replay of that batch only, never by
    another stream that starts over in the same folder: such a stream reads all
    files again and clears away what it did not stage.
    """
    def each(rows: DataFrame, staging: str, epoch_id: int) -> None:
        merge_into_days(rows, target, staging, key=key, epoch=epoch_id)

    return staged_batches(spark, src_dir, checkpoint, each, ts, max_files_per_trigger, wait)


def staged_batches(spark: SparkSession, src_dir: str, checkpoint: str, each,
                   ts: str = "created_date",
                   max_files_per_trigger: int | None = FILES_PER_BATCH,
                   wait: bool = True) -> StreamingQuery:
    """Run ``each(clean rows, staging folder, epoch)`` on the files not yet seen.
    The folder is the batch's own (see ``ingest_available_now``) and goes once
    ``each`` is done."""
    base = checkpoint.rstrip("/")

    def each_batch(files: DataFrame, epoch_id: int) -> None:
        session = files.sparkSession
        # a set: beside a name with glob characters the source lists files twice
        landed = sorted({(r.path, str(r.modificationTime)) for r in
                         files.select("path", "modificationTime").collect()})
        if not landed:
            return
        named = json.dumps([stream_id(session, f"{base}/state"), epoch_id, landed])
        staging = f"{base}/staging/{hashlib.sha256(named.encode()).hexdigest()[:24]}"
        if not _exists(session, staging):
            delete_path(session, f"{base}/staging")
        raw = read_csv_by_header(session, [literal_path(p) for p, _ in landed],
                                 multiline=True, with_file=True)
        each(landed_complaints(raw, ts), staging, epoch_id)
        delete_path(session, staging)

    q = (landed_files(spark, src_dir, max_files_per_trigger)
         .writeStream.foreachBatch(each_batch)
         .option("checkpointLocation", f"{base}/state")
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def landed_complaints(raw: DataFrame, ts: str = "created_date") -> DataFrame:
    """Clean complaint rows of landed files with their day and delivery.

    ``raw`` has the columns of ``read_csv_by_header(..., with_file=True)``;
    source columns that no file has are NULL."""
    have = {c: (F.col(c) if c in raw.columns else F.lit(None).cast("string"))
            for c in COMPLAINT_COLUMNS}
    rows = raw.select(*[x.alias(c) for c, x in have.items()], "__file", "__landed")
    return (complaints_clean(rows, keep=("__file", "__landed"))
            .withColumn("day", F.to_date(ts)))


EVENT_TIME = "__event_time"


def dedup_stream(df: DataFrame, key: str = "unique_key",
                 ts: str = "created_date", delay: str = "2 days") -> DataFrame:
    """Drop repeats of a key arriving within ``delay`` of each other
    (bounded state; rows older than the watermark are dropped as late).
    The zone-less event time is read as UTC, so results do not depend on the
    session time zone."""
    return (df.withColumn(EVENT_TIME, utc_instant(ts))
              .withWatermark(EVENT_TIME, delay)
              .dropDuplicatesWithinWatermark([key])
              .drop(EVENT_TIME))


def daily_counts_stream(df: DataFrame, ts: str = "created_date",
                        delay: str = "1 day") -> DataFrame:
    """Rows per calendar day (tumbling one-day window over the event time,
    read as UTC).  In append mode a day is emitted once the watermark passes
    its end; in complete mode every day is re-emitted each batch.  A row without
    an event time belongs to no window (``daily_counts_available_now`` counts
    those as well)."""
    return (df.withColumn(EVENT_TIME, utc_instant(ts))
              .withWatermark(EVENT_TIME, delay)
              .groupBy(F.window(EVENT_TIME, "1 day").alias("w"))
              .agg(F.count(F.lit(1)).alias("daily_count"))
              .select(utc_date(F.col("w.start")).alias("load_date"),
                      "daily_count"))


def daily_counts_available_now(spark: SparkSession, src_dir: str, out: str,
                               checkpoint: str,
                               ts: str = "created_date") -> StreamingQuery:
    """Count every landed file's rows per day and keep the complete per-day
    table in ``out`` (each micro-batch rewrites it whole; the table is one row
    per day, so the rewrite is small).  Days are grouped without a window, so
    rows without a date are counted too, under a NULL day, as the batch check
    does."""
    cleaned = complaints_clean(complaint_file_stream(spark, src_dir))
    counts = cleaned.groupBy(F.to_date(ts).alias("load_date")) \
        .agg(F.count(F.lit(1)).alias("daily_count"))
    q = (counts.writeStream.outputMode("complete")
               .foreachBatch(lambda b, _e: b.write.mode("overwrite").parquet(out))
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
