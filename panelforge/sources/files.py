"""File sources: string CSV by header name, JSON matrix / payload documents,
by-name Parquet loads, per-period file sets and reject splitting.

All parsing runs on executors (``from_json``, ``try_cast``); nothing is
collected to the driver but file names and, for CSV folders whose files
disagree on column order, the distinct header lines.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import safe_cast

MATRIX_TYPE = "array<array<string>>"
PAYLOAD_TYPE = "struct<year:int, header:array<string>, data:array<array<string>>>"
FILE_PATH = "_metadata.file_path"


# --------------------------------------------------------------------- CSV --

def read_csv_strings(spark: SparkSession, path: str | Sequence[str],
                     multiline: bool = False, columns: Sequence[str] | None = None,
                     **options) -> DataFrame:
    """Header CSV read with every column as a string (no inference pass);
    ``columns``, where known, are the header's names in order.

    Typing happens afterwards with tolerant casts by column *name*.
    ``multiline`` keeps quoted newlines inside one record at the cost of
    splitting files only at file boundaries.
    """
    reader = (spark.read.option("header", "true")
                   .option("inferSchema", "false")
                   .option("multiLine", str(bool(multiline)).lower())
                   .option("mode", "PERMISSIVE"))
    for k, v in options.items():
        reader = reader.option(k, v)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.csv(path if isinstance(path, str) else list(path))


def literal_path(path: str) -> str:
    """A file's path as a reader's argument (readers take paths for globs)."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def path_of(uri: str) -> str:
    """The path of a ``_metadata.file_path``, which is an encoded URI."""
    return unquote(uri)


#: Files up to this many bytes are scanned for their first line together; of
#: larger ones a task each reads the first buffer.
SMALL_FILE = 8 << 20


def file_headers(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, header, landed): the first line of every file, nested folders
    included, found on executors (compressed files are read like any other).
    Small files are scanned in one job, in which a file's lines collapse to the
    first inside each task; a large file's first line is a limited read of its
    own, so no file costs more than ``SMALL_FILE`` bytes."""
    paths = path if isinstance(path, str) else list(path)
    large = F.col("_metadata.file_size") > SMALL_FILE
    lines = (spark.read.format("text").option("recursiveFileLookup", "true").load(paths)
                  .filter(~large & (F.col("_metadata.file_block_start") == 0))
                  .select("value", F.col(FILE_PATH).alias("file"),
                          F.col("_metadata.file_modification_time").alias("landed")))
    small = (lines.withColumn("n", F.monotonically_increasing_id()).groupBy("file")
                  .agg(F.min_by("value", "n").alias("header"), F.max("landed").alias("landed")))
    rest = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
                 .filter(large).select(F.col(FILE_PATH).alias("file"), "modificationTime").collect())

    def first(file):
        row = spark.read.text(literal_path(path_of(file["file"]))).first()
        return file["file"], row[0] if row else "", file["modificationTime"]

    out = small
    if rest:
        with ThreadPoolExecutor(16) as pool:
            found = list(pool.map(first, rest))
        out = small.unionByName(spark.createDataFrame(found, small.schema))
    return out.withColumn("header", F.regexp_replace("header", "^\ufeff", ""))


def header_columns(header: str, sep: str = ",", quote: str = '"') -> list[str] | None:
    """Column names of a header line; empty and repeated ones get their position,
    as Spark's reader names them.  None if the header goes on in a next line."""
    if header.count(quote) % 2:
        return None
    names = next(csv.reader([header], delimiter=sep, quotechar=quote), [])
    lower = [n.lower() for n in names]
    return [f"_c{i}" if not n else f"{n}{i}" if lower.count(n.lower()) > 1 else n
            for i, n in enumerate(names)]


def read_csv_by_header(spark: SparkSession, path: str | Sequence[str],
                       multiline: bool = False, with_file: bool = False,
                       **options) -> DataFrame:
    """String CSV over folders whose files may order columns differently.

    Spark's CSV reader takes the header of one file and binds the others by
    *position*.  Files are grouped by their header line, each group is read on
    its own, and the groups are unioned by name (a column missing in a group is
    NULL there).  File names may hold any character.  What reaches the driver is one row per header with its files'
    names, like any file listing.  ``with_file`` adds ``__file`` and
    ``__landed`` (the file's modification time).
    """
    groups = (file_headers(spark, path).groupBy("header")
              .agg(F.sort_array(F.collect_set("file")).alias("files"))
              .orderBy("header").collect())
    if not groups:
        raise ValueError(f"no input files under {path}")
    frames = []
    for g in groups:
        # the names are known, so no file is read for them once more
        names = header_columns(g["header"], options.get("sep", ","), options.get("quote", '"'))
        df = read_csv_strings(spark, [literal_path(path_of(f)) for f in g["files"]],
                              multiline, names, **options)
        if with_file:
            df = df.select("*", F.col(FILE_PATH).alias("__file"),
                           F.col("_metadata.file_modification_time").alias("__landed"))
        frames.append(df)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# -------------------------------------------------------------------- JSON --

def _positions(header: Column, names: Sequence[str]) -> Column:
    """Array of each name's position in a document's header (0: not there);
    worked out once per document, so documents may order or extend their
    columns differently."""
    return F.array(*[F.coalesce(F.array_position(header, F.lit(n)), F.lit(0)).cast("int")
                     for n in names])


def _cells(columns: Mapping[str, str]) -> list[Column]:
    """Cells of ``__row`` at ``__at`` (NULL when the header lacks the name)."""
    return [F.when(F.get("__at", F.lit(i)) > 0,
                   F.try_element_at("__row", F.get("__at", F.lit(i)))).alias(out)
            for i, out in enumerate(columns)]


def matrix_rows(docs: DataFrame, doc_col: str, columns: Mapping[str, str],
                keep: Sequence[str] = ()) -> DataFrame:
    """Parsed matrix documents (first row = header) -> one row per data row.

    ``columns`` maps output column -> header name.  A header-only, empty or
    unparsable document yields no rows; ``document_problems`` names those.
    """
    m = F.col(doc_col)
    rows = docs.select(*keep, _positions(m.getItem(0), list(columns.values())).alias("__at"),
                       F.explode(F.slice(m, 2, F.greatest(F.size(m), F.lit(1))))
                       .alias("__row"))
    return rows.select(*keep, *_cells(columns))


def document_problems(docs: DataFrame, text_col: str,
                      columns: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Matrix documents that yield no usable rows, with ``problem``: corrupt
    (not a matrix of strings), no rows, or missing columns."""
    m = F.from_json(F.col(text_col), MATRIX_TYPE)
    lacks = F.size(F.array_except(F.array(*[F.lit(c) for c in columns]),
                                  F.col("__m").getItem(0))) > 0 if columns else F.lit(False)
    why = (F.when(F.col("__m").isNull() | F.exists("__m", lambda r: r.isNull()), "corrupt")
            .when(F.size("__m") < 2, "no rows")
            .when(F.coalesce(lacks, F.lit(True)), "missing columns"))
    return (docs.select(*keep, m.alias("__m")).withColumn("problem", why)
                .filter(F.col("problem").isNotNull()).select(*keep, "problem"))


def parse_matrix_text(df: DataFrame, text_col: str, columns: Mapping[str, str],
                      keep: Sequence[str] = ()) -> DataFrame:
    """JSON text ``[[header...],[row...],...]`` in a column -> typed-later
    string rows, parsed on executors."""
    docs = df.select(*keep, F.from_json(F.col(text_col), MATRIX_TYPE).alias("__m"))
    return matrix_rows(docs, "__m", columns, keep)


def _read_docs(spark: SparkSession, path: str, per_line: bool) -> DataFrame:
    """One row per document: a whole file, or one line of a JSON-lines file."""
    return (spark.read.format("text")
                 .option("wholetext", "false" if per_line else "true")
                 .load(path)
                 .select("value", F.col(FILE_PATH).alias("__file")))


def read_json_matrix(spark: SparkSession, path: str,
                     columns: Mapping[str, str],
                     period_pattern: str | None = None,
                     period_name: str = "data_year",
                     per_line: bool = False, keep_others: bool = False) -> DataFrame:
    """Folder/glob of matrix documents: one document per file (may be
    pretty-printed), or one per line with ``per_line=True``.

    ``keep_others`` adds the columns that documents have beside ``columns``, under
    their own names (a first pass over the documents gathers the distinct ones;
    NULL where a document lacks one).

    ``period_pattern`` is a regex with one group that takes the period out of
    the file path (per-period file template); a period without a file simply
    contributes no rows.  A whole-file document is one record (a JSON array
    cannot be split), so parallelism comes from the number of files.
    """
    raw = _read_docs(spark, path, per_line)
    keep = ["__file"]
    if keep_others:
        names = raw.select(F.explode(F.from_json("value", MATRIX_TYPE)[0]).alias("name")) \
            .where("name IS NOT NULL").distinct().orderBy("name").collect()
        taken = {c.lower() for c in (*columns, *columns.values(), period_name, *keep)}
        columns = {**columns, **{r["name"]: r["name"] for r in names
                                 if r["name"].lower() not in taken}}
    rows = parse_matrix_text(raw, "value", columns, keep)
    if period_pattern:
        rows = rows.withColumn(
            period_name,
            safe_cast(F.regexp_extract("__file", period_pattern, 1), "int"))
    return rows.drop("__file")


def parse_payload_text(df: DataFrame, text_col: str,
                       columns: Mapping[str, str],
                       period_name: str = "data_year") -> DataFrame:
    """JSON text ``{"year": y, "header": [...], "data": [[...], ...]}`` ->
    one row per data row plus the document's period."""
    p = F.from_json(F.col(text_col), PAYLOAD_TYPE)
    docs = df.select(p.alias("__p"))
    rows = docs.select(F.col("__p.year").alias(period_name),
                       _positions(F.col("__p.header"), list(columns.values())).alias("__at"),
                       F.explode("__p.data").alias("__row"))
    return rows.select(*_cells(columns), period_name)


def read_json_payload(spark: SparkSession, path: str,
                      columns: Mapping[str, str],
                      period_name: str = "data_year",
                      per_line: bool = False) -> DataFrame:
    """Folder/glob of payload documents, one per file (or per line)."""
    raw = _read_docs(spark, path, per_line)
    return parse_payload_text(raw, "value", columns, period_name)


# ----------------------------------------------------------------- Parquet --

def load_by_name(spark: SparkSession, path: str | Sequence[str],
                 schema: T.StructType) -> DataFrame:
    """Parquet load matched to a target schema by column name, ignoring case
    and order; target columns absent from the files are NULL."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).parquet(*paths)


def read_parquet_tolerant(spark: SparkSession, path: str | Sequence[str],
                          schema: T.StructType | None = None) -> DataFrame:
    """Parquet load that skips unreadable files instead of failing the job
    (continue-on-error loading); combine with ``flag_rejects`` for rows."""
    r = spark.read.option("ignoreCorruptFiles", "true") \
                  .option("ignoreMissingFiles", "true")
    if schema is not None:
        r = r.schema(schema)
    paths = [path] if isinstance(path, str) else list(path)
    return r.parquet(*paths)


def read_slices(spark: SparkSession, base: str, pattern: str) -> DataFrame:
    """Parquet slices whose folder/file names match a glob under ``base``
    (e.g. ``part_2024-01-15*``).  For partitioned tables prefer a filter on
    the partition column: Spark prunes partitions from the predicate."""
    return spark.read.parquet(f"{base.rstrip('/')}/{pattern}")


def refresh(spark: SparkSession, path: str) -> None:
    """Drop cached file listings/data for ``path`` after an external write."""
    spark.catalog.refreshByPath(path)


def merge_pages(spark: SparkSession, path: str, schema: T.StructType,
                key: str) -> DataFrame:
    """JSON-lines page files whose pages overlap -> one row per ``key`` (copies
    of a row collapse inside each task; unlike versions: the largest one).  Rows
    without a key are all kept."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)
    cols = [c for c in rows.columns if c != key]
    merged = (rows.filter(F.col(key).isNotNull()).groupBy(key)
                  .agg(F.max(F.struct(*cols)).alias("__row")).select(key, "__row.*"))
    return merged.unionByName(rows.filter(F.col(key).isNull())).select(*rows.columns)


# --------------------------------------------------------------- documents --

def pack_matrix_docs(df: DataFrame, header: Sequence[str],
                     doc_keys: Sequence[Column | str]) -> DataFrame:
    """Rows -> matrix documents ``[[header], [row], ...]`` (JSON text), one
    per distinct ``doc_keys`` value.  Choose keys that bound the rows per
    document (e.g. period plus a key range): a document is built by one task.
    Output: the doc keys and ``value``."""
    keys = [F.col(k) if isinstance(k, str) else k for k in doc_keys]
    rows = df.select(*keys, F.array(*[F.col(f"`{h}`").cast("string")
                                      for h in header]).alias("__row"))
    names = rows.columns[:len(keys)]
    docs = rows.groupBy(*names).agg(F.collect_list("__row").alias("__data"))
    head = F.array(F.array(*[F.lit(h) for h in header]))
    return docs.select(*names, F.to_json(F.concat(head, F.col("__data")))
                       .alias("value"))


def pack_payload_docs(df: DataFrame, period: str, header: Sequence[str],
                      doc_keys: Sequence[Column | str]) -> DataFrame:
    """Rows -> payload documents ``{"year", "header", "data"}`` (JSON text),
    one per period and ``doc_keys``, which must bound the rows per document:
    a document is built by one task."""
    if not doc_keys:
        raise ValueError("doc_keys must bound the size of a document")
    keys = [F.col(k) if isinstance(k, str) else k for k in doc_keys]
    rows = df.select(F.col(period).alias("__period"), *keys,
                     F.array(*[F.col(f"`{h}`").cast("string")
                               for h in header]).alias("__row"))
    names = rows.columns[:1 + len(keys)]
    docs = rows.groupBy(*names).agg(F.collect_list("__row").alias("__data"))
    payload = F.struct(F.col("__period").alias("year"),
                       F.array(*[F.lit(h) for h in header]).alias("header"),
                       F.col("__data").alias("data"))
    return docs.select(F.col("__period").alias(period), *names[1:],
                       F.to_json(payload).alias("value"))


# ----------------------------------------------------------------- rejects --

def flag_rejects(df: DataFrame, casts: Mapping[str, str],
                 reason: str = "reject_reason") -> DataFrame:
    """Typed columns plus a reason column naming the first column whose
    non-NULL raw value failed to cast (NULL when the row is clean)."""
    typed = {c: safe_cast(c, t) for c, t in casts.items()}
    why = F.lit(None).cast("string")
    for c in reversed(list(casts)):
        why = F.when(F.col(c).isNotNull() & typed[c].isNull(),
                     F.lit(f"bad {c}")).otherwise(why)
    return df.withColumn(reason, why).withColumns(typed)


def split_rejects(df: DataFrame, casts: Mapping[str, str],
                  reason: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) views of one flagged frame.  Write both from one
    cached/checkpointed flagged frame when the input is expensive."""
    flagged = flag_rejects(df, casts, reason)
    return (flagged.filter(F.col(reason).isNull()).drop(reason),
            flagged.filter(F.col(reason).isNotNull()))
