"""Parquet loads that go on past bad files: reconciled with the listing, and
with types that differ between files brought to one target schema."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import safe_cast
from .files import FILE_PATH, literal_path, path_of

REPORT = "file string, status string, expected_rows long, read_rows long"
#: Footers that are asked for at the same time.
PROBES = 16


def _uri():
    return F.regexp_replace(FILE_PATH, r"^([A-Za-z][\w+.-]*):///", "$1:/")


def listing(spark: SparkSession, base: str) -> DataFrame:
    """(uri, file, length) of every file under ``base``, empty ones included;
    ``file`` is the path below it.  Contents are not read."""
    root = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", base).rstrip("/") + "/"
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", "[!_.]*").load(base)
    # readers name a file of no authority now with one slash, now with three
    uris = [re.sub(r"^([A-Za-z][\w+.-]*):///", r"\1:/", u) for u in found.inputFiles()]
    names = spark.createDataFrame([(u, path_of(u).split(root, 1)[-1]) for u in uris],
                                  "uri string, file string")
    # a scan passes over files without bytes
    sizes = found.select(_uri().alias("uri"), "length")
    return names.join(sizes, "uri", "left").withColumn(
        "length", F.coalesce("length", F.lit(0).cast("long")))


def _readable(spark: SparkSession, uri: str) -> bool:
    """Whether a file has a Parquet footer (a one-task read of it)."""
    try:
        spark.read.parquet(literal_path(path_of(uri))).schema
        return True
    except (PySparkException, Py4JJavaError):
        return False


def _fits(spark: SparkSession, uri: str, target: T.StructType) -> bool:
    """Whether a file's columns are nested where the target's are."""
    try:
        have = {f.name.lower(): f.dataType for f in
                spark.read.parquet(literal_path(path_of(uri))).schema.fields}
    except (PySparkException, Py4JJavaError):
        return True  # unreadable files are passed over by the reader
    nested = (T.ArrayType, T.MapType, T.StructType)

    def kind(t):
        return type(t) if isinstance(t, nested) else None

    return all(kind(have[f.name.lower()]) == kind(f.dataType)
               for f in target.fields if f.name.lower() in have)


def _write(reader, paths: Sequence[str], out: str) -> None:
    reader.parquet(*paths).select("*", _uri().alias("__uri")) \
        .write.mode("overwrite").parquet(out)


def tolerant_load(spark: SparkSession, base: str, out: str, schema: T.StructType,
                  expected: Sequence[str] | DataFrame = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, report): what can be loaded, and what became of every file.

    A file counts as a whole or not at all.  The listing (and ``expected``, paths
    below ``base``: names, or a DataFrame with a column ``file``) is reconciled
    with the files' footers and with the rows that were read, which are written
    to ``out`` on the way.  ``status`` is one of

    * ``loaded``, ``no rows``: as many rows as the footer says;
    * ``missing``: expected, not there;
    * ``empty file``: no bytes;
    * ``unreadable``: no usable footer (cut off, or not Parquet);
    * ``damaged``: fewer rows could be read than the footer says, or a column has
      a type that the target cannot take; none of its rows are loaded.
    """
    reader = (spark.read.schema(schema).option("ignoreCorruptFiles", "true")
                   .option("ignoreMissingFiles", "true").option("recursiveFileLookup", "true")
                   .option("pathGlobFilter", "[!_.]*"))
    n = F.count(F.lit(1))
    uri = _uri().alias("uri")
    # no column is read: the counts come from the footers
    footers = reader.parquet(base).select(uri).groupBy("uri").agg(n.alias("expected_rows"))
    try:
        _write(reader, [base], out)
    except (PySparkException, Py4JJavaError) as e:
        if "Invalid Spark read type" not in str(e):
            raise
        # a nested column where the target has a plain one, or the other way
        # round, stops the reader: those files are left out by their footers
        uris = [r["uri"] for r in listing(spark, base).filter("length > 0").select("uri").collect()]
        with ThreadPoolExecutor(PROBES) as pool:
            fits = list(pool.map(lambda u: _fits(spark, u, schema), uris))
        if all(fits):
            raise
        _write(reader.option("recursiveFileLookup", "false"),
               [literal_path(path_of(u)) for u, ok in zip(uris, fits) if ok], out)
    written = spark.read.schema(T.StructType([*schema.fields, T.StructField("__uri", T.StringType())])) \
        .parquet(out)
    read = written.groupBy(F.col("__uri").alias("uri")).agg(n.alias("read_rows"))
    seen = listing(spark, base).join(footers, "uri", "left").join(read, "uri", "left")
    none = seen.filter("expected_rows IS NULL AND length > 0").select("uri").collect()
    with ThreadPoolExecutor(PROBES) as pool:
        fine = [u for u, ok in zip((r["uri"] for r in none), pool.map(
            lambda r: _readable(spark, r["uri"]), none)) if ok]
    has_footer = F.col("uri").isin(fine) if fine else F.lit(False)
    zero = F.lit(0).cast("long")
    files = seen.select(
        "file", F.when(F.col("length") == 0, "empty file")
        .when(F.col("expected_rows").isNull() & has_footer, "no rows")
        .when(F.col("expected_rows").isNull(), "unreadable")
        .when(F.coalesce("read_rows", zero) < F.col("expected_rows"), "damaged")
        .otherwise("loaded").alias("status"),
        F.coalesce("expected_rows", zero).alias("expected_rows"),
        F.coalesce("read_rows", zero).alias("read_rows"), "uri")
    wanted = expected if isinstance(expected, DataFrame) else \
        spark.createDataFrame([(e,) for e in expected], "file string")
    absent = wanted.select("file").distinct().join(files.select("file"), "file", "left_anti") \
        .select("file", F.lit("missing").alias("status"), zero.alias("expected_rows"),
                zero.alias("read_rows"))
    bad = files.filter(F.col("status") == "damaged").select(F.col("uri").alias("__uri"))
    rows = written.join(bad, "__uri", "left_anti").drop("__uri")
    return rows, files.drop("uri").unionByName(absent)


def _merged(spark: SparkSession, uris: Sequence[str]) -> T.StructType | None:
    """The common schema of some files (their footers are read by one job), or
    None if a column has unlike types or spellings."""
    try:
        schema = spark.read.option("mergeSchema", "true").parquet(
            *[literal_path(path_of(u)) for u in uris]).schema
    except (PySparkException, Py4JJavaError) as e:
        if len(uris) == 1 or "MERGE_SCHEMA" not in str(e):
            raise
        return None
    names = [f.name.lower() for f in schema.fields]
    return schema if len(set(names)) == len(names) else None


def schema_groups(spark: SparkSession, uris: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """(schema, files): files whose columns have the same types.  A list of files
    is cut in halves until each part agrees, and parts of one schema come
    together again, so runs of files of one kind cost few jobs."""
    found: dict[tuple, tuple[T.StructType, list[str]]] = {}
    parts = [list(uris)] if uris else []
    while parts:
        part = parts.pop()
        schema = _merged(spark, part)
        if schema is None:
            half = len(part) // 2
            parts += [part[half:], part[:half]]
            continue
        kind = tuple(sorted((f.name, f.dataType.simpleString()) for f in schema.fields))
        found.setdefault(kind, (schema, []))[1].extend(part)
    return list(found.values())


def load_mixed_types(spark: SparkSession, base: str, target: T.StructType) -> DataFrame:
    """Parquet files whose columns differ in type, order, spelling (upper and
    lower case) or presence, as rows of ``target``: files of one kind are read
    together, their columns cast tolerantly (NULL where a value does not convert)
    and the kinds united by name.  Columns outside the target are not read.

    Only the footers are read to tell the kinds apart; what reaches the driver
    are the files' names, as in any listing."""
    uris = sorted(r["uri"] for r in listing(spark, base).select("uri").collect())
    if not uris:
        raise ValueError(f"no input files under {base}")
    out = None
    for schema, files in schema_groups(spark, uris):
        have = {f.name.lower(): f.name for f in schema.fields}
        rows = spark.read.schema(schema).parquet(*[literal_path(path_of(u)) for u in files])
        rows = rows.select(*[
            (safe_cast(F.col(f"`{have[f.name.lower()]}`"), f.dataType)
             if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields])
        out = rows if out is None else out.unionByName(rows)
    return out
