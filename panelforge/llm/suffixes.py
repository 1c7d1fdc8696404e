"""Suffix-array deduplication by linear grouping construction.

A byte is removed if a ``WINDOW``-byte string that covers it also starts anywhere
else.  Windows that hang on one place of a text (see ``spans``) go together as a
block, and Spark

1. keeps the blocks whose place has a string that is found twice or more,
2. counts equal blocks, so that any number of copies is one string from here on;
   a string that is alone at its kind of place and has copies is repeated whole,
3. gathers the unlike strings around one kind of place and builds their suffix
   array (groups by Lyndon prefix in descending order with previous-smaller
   pointers, then each group's order), in which repeated windows are neighbours,
4. takes the answers back to all blocks, and the texts to their spans.

Counts are pre-aggregated, joins are left to the adaptive skew split, and the
strings of a place with more than ``HOT`` unlike ones are dealt window by window
under the window's own hash, so no task holds a whole hot group.

What is settled by the suffix array, then, are all places with 2 to ``HOT`` unlike
strings: wherever copies differ in what surrounds them.  Not settled by it are
places at which all copies are equal (point 2: their count says that every window
is repeated; there is nothing to compare) and places above ``HOT`` (their windows
are compared by 64-bit hashes).  The array is built in linear steps: letters and
first groups by radix passes of 16 bits, members of a group by the pointers
themselves, parents by buckets of their counts; no comparison sort is left in it.

Defined cases: a null text is empty; texts of any length are taken in stretches;
matches never cross documents; rows that share an id are documents of their own;
equal rows are copies of each other; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from . import spans as S
from .common import same, stored
from .recompress import _BYTE, _LETTER, Rolling
from .texts import keyed, opened_texts, squeezed

WINDOW = 200
#: Bytes of text that the numpy kernels take at a time.
BYTES = 1 << 19
#: Bytes of strings in one suffix array (whole groups; one group may be more).
ARRAY = 1 << 18
#: Unlike strings around one kind of place that share a suffix array.  It bounds
#: a task's memory: a string has under 2 * WINDOW bytes, so a group has 3.3 MB of
#: them at most and some 400,000 cells, whatever the size of the input.  Places
#: above it are dealt window by window, rows in proportion to their strings.
HOT = 4096


def block_rows(texts: list[bytes], window: int):
    """Columns name, context, text number, first window, width, copies, place."""
    out, group, size = [], [], 0

    def flush():
        if group:
            sizes = np.array([len(p) for _, _, p in group])
            name, ctx, t, lo, w, c, place = S.blocks(
                b"".join(p for _, _, p in group), sizes, window)
            number, before = (np.array([g[k] for g in group], np.int64) for k in (0, 1))
            out.append((name.view(np.int64), ctx.view(np.int64), number[t],
                        lo + before[t], w, c, place))

    for n, t in enumerate(texts):
        for at in range(0, max(len(t) - window, 0) + 1, BYTES):
            part = t[at:at + BYTES + window - 1]  # windows that begin in this stretch
            if group and size + len(part) > BYTES:
                flush()
                group, size = [], 0
            group.append((n, at, part))
            size += len(part)
    flush()
    return [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 7


def blocks(rows: DataFrame, window: int) -> DataFrame:
    def run(batches):
        for b in batches:
            name, ctx, t, lo, w, c, place = block_rows(b.column("text").to_pylist(), window)
            yield pa.record_batch(
                [pa.array(name), pa.array(ctx), b.column("row").take(pa.array(t)),
                 *(pa.array(x.astype(np.int32)) for x in (lo, w, c, place))],
                names=["name", "context", "row", "lo", "width", "copies", "place"])

    return rows.select("row", "text").mapInArrow(
        run, "name long, context long, row long, lo int, width int, copies int, place int")


def strings(asked: DataFrame, window: int) -> DataFrame:
    """The wanted strings of texts: for a hot place, the hash of each window."""
    def run(batches):
        for whole in batches:
            for s in range(0, whole.num_rows, 64):
                b = whole.slice(s, 64)
                want = b.column("want")
                w = want.flatten()
                of = np.repeat(np.arange(b.num_rows), np.diff(want.offsets.to_numpy()))
                texts = opened_texts(b.column("text"))
                lo, width, hot = (w.field(f).to_numpy(zero_copy_only=False)
                                  for f in ("lo", "width", "hot"))
                cut, hashes = [], []
                for n, a, k, h in zip(of.tolist(), lo.tolist(), width.tolist(), hot.tolist()):
                    part = texts[n][a:a + k - 1 + window]
                    cut.append(None if h else part)
                    at = np.arange(k)
                    hashes.append(Rolling(_LETTER[np.frombuffer(part, np.uint8)], _BYTE)
                                  .of(at, at + window).view(np.int64) if h else None)
                yield pa.record_batch(
                    [*(w.field(f) for f in ("name", "context", "copies", "width", "place", "hot")),
                     pa.array(cut, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))],
                    names=["name", "context", "copies", "width", "place", "hot", "bytes", "windows"])

    return asked.mapInArrow(run, "name long, context long, copies long, width int, place int,"
                                 " hot boolean, bytes binary, windows array<long>")


def _ranges(c: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, first, how many) of neighbouring windows."""
    by = np.lexsort((w, c))
    c, w = c[by], w[by]
    first = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (w[1:] != w[:-1] + 1)]) \
        if len(c) else np.empty(0, int)
    return c[first], w[first], np.diff(np.r_[first, len(c)])


def by_suffix_array(grouped: DataFrame, window: int) -> DataFrame:
    """(name, context, at, n): repeated windows, from partitions that hold whole
    names in order; as many names share an array as ``ARRAY`` bytes allow."""
    def solve(rows):
        name, ctx, copies, width, place, data = (list(x) for x in zip(*rows))
        c, w = S.repeated(data, np.array(place), np.array(width), np.array(copies),
                          np.array(name), window)
        c, at, n = _ranges(c, w)
        return pa.record_batch(
            [pa.array(np.array(name, np.int64)[c]), pa.array(np.array(ctx, np.int64)[c]),
             pa.array(at.astype(np.int32)), pa.array(n.astype(np.int32))],
            names=["name", "context", "at", "n"])

    def run(batches):
        held, size = [], 0
        for b in batches:
            for r in zip(*(x.to_pylist() for x in b.columns)):
                if size >= ARRAY and r[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[5])
        if held:
            yield solve(held)

    return grouped.select("name", "context", "copies", "width", "place", "bytes") \
        .mapInArrow(run, "name long, context long, at int, n int")


def _beside_unique(hot: DataFrame) -> DataFrame:
    """(name, context, at, n): the repeated windows of hot places, as what lies
    between the windows that are found once.  A window found once is its group's
    only row, so the count itself says where it is and nothing is joined window
    by window."""
    windows = hot.select("name", "context", "copies", F.posexplode("windows").alias("at", "w"))
    once = windows.groupBy("name", "w").agg(
        F.sum("copies").alias("k"), F.min(F.struct("context", "at")).alias("one")) \
        .where("k = 1").select("name", "one.*")
    stops = stored(once.groupBy("name", "context").agg(
        F.sort_array(F.collect_list("at")).alias("stops")), "unique-windows")
    edges = F.concat(F.array(F.lit(-1)), F.coalesce("stops", F.array().cast("array<int>")),
                     F.array("width"))
    gaps = F.transform(F.sequence(F.lit(1), F.size("edges") - 1), lambda i: F.struct(
        (F.get("edges", i - 1) + 1).alias("at"),
        (F.get("edges", i) - F.get("edges", i - 1) - 1).alias("n")))
    return hot.join(stops, ["name", "context"], "left").withColumn("edges", edges) \
        .select("name", "context", F.explode(F.filter(gaps, lambda g: g["n"] > 0)).alias("g")) \
        .select("name", "context", "g.*")


def removed_windows(rows: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """(row, lo, n): runs of repeated window starts of every row key."""
    found = blocks(rows, window)
    # aggregates are stored before they are joined: only a join of two plain
    # exchanges is split where a key is hot
    names = stored(found.groupBy("name").agg(F.sum("copies").alias("k"))
                   .where("k > 1").select("name"), "shared-names")
    shared = stored(found.join(names, "name", "left_semi"), "shared-blocks")
    classes = stored(shared.groupBy("name", "context").agg(
        F.sum("copies").alias("copies"), F.min(F.struct("row", "lo", "width", "place"))
        .alias("first")), "block-classes")
    kinds = stored(classes.groupBy("name").agg(F.count(F.lit(1)).alias("kinds")), "name-kinds")
    known = classes.join(kinds, "name")
    whole = known.where("kinds = 1").select(
        "name", "context", F.lit(0).alias("at"), F.col("first.width").alias("n"))
    wanted = known.where("kinds > 1").groupBy("first.row").agg(F.collect_list(F.struct(
        "name", "context", "copies", "first.lo", "first.width", "first.place",
        (F.col("kinds") > hot).alias("hot"))).alias("want"))
    # rows equal in id and text share a key: their text is fetched once, and so
    # are their spans (collect_set), or M such rows would make M * M
    asked = squeezed(rows.select("row", "text")).dropDuplicates(["row"]).join(wanted, "row")
    found = stored(strings(asked.select("row", "text", "want"), window), "edge-strings")
    cold = by_suffix_array(found.where(~F.col("hot")).repartition("name")
                           .sortWithinPartitions("name"), window)
    many = _beside_unique(found.where("hot"))
    answers = whole.unionByName(cold).unionByName(many)
    return shared.join(answers, ["name", "context"]).select(
        "row", (F.col("lo") + F.col("at")).alias("lo"),
        (F.col("n") + F.col("copies") - 1).alias("n"))


def kept_bytes(text: bytes, lo: np.ndarray, n: np.ndarray, window: int) -> tuple[bytes, list]:
    """The kept bytes and the maximal removed runs (start, end)."""
    if not len(lo):
        return text, []
    by = np.argsort(lo, kind="stable")
    start, end = lo[by], np.maximum.accumulate((lo + n - 1 + window)[by])
    first = np.flatnonzero(np.r_[True, start[1:] > end[:-1]])
    runs = list(zip(start[first].tolist(), end[np.r_[first[1:] - 1, len(end) - 1]].tolist()))
    out, at = [], 0
    for a, b in runs:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]]), runs


def dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
          text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, kept binary, spans array of removed (start, end))."""
    rows = keyed(docs, id_col, text_col)
    spans = removed_windows(rows, window, hot) \
        .groupBy("row").agg(F.collect_set(F.struct("lo", "n")).alias("runs"))
    both = squeezed(rows.select("row", "doc_id", "text")).join(spans, "row", "left") \
        .select("doc_id", "text", "runs")
    return both.mapInArrow(
        cutter(window), "doc_id long, n_bytes long, kept binary,"
                        " spans array<struct<start: long, end: long>>")


def cutter(window: int):
    """Map of (doc_id, compressed text, runs) to what is kept of it."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for whole in batches:
            for s in range(0, whole.num_rows, 256):
                b = whole.slice(s, 256)
                runs = b.column("runs")
                per = np.r_[0, np.cumsum(np.nan_to_num(
                    pa.compute.list_value_length(runs).to_numpy(zero_copy_only=False)))].astype(int)
                flat = runs.flatten()
                lo, n = (flat.field(f).to_numpy().astype(np.int64) for f in ("lo", "n"))
                texts = opened_texts(b.column("text"))
                out = [kept_bytes(t, lo[i:j], n[i:j], window) for t, i, j in
                       zip(texts, per[:-1].tolist(), per[1:].tolist())]
                yield pa.record_batch(
                    [b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                     pa.array([o[0] for o in out], pa.binary()),
                     pa.array([[{"start": x, "end": y} for x, y in o[1]] for o in out], kind)],
                    names=["doc_id", "n_bytes", "kept", "spans"])

    return run


def cut(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
        text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``docs``, all columns, with the repeated spans cut from their texts; bytes
    that no longer make a whole character go with them, a null text stays null."""
    names = docs.columns
    row, runs = "row", f"c{len(names)}"  # beside c0, c1 and so on
    spans = removed_windows(keyed(docs, id_col, text_col), window, hot).groupBy(
        F.col("row").alias(row)).agg(F.collect_set(F.struct("lo", "n")).alias(runs))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    at = names.index(text_col)
    # texts travel to their spans compressed
    plain = [c.cast("binary") if i == at else c for i, c in enumerate(same(docs))]
    sent = docs.select(*plain, F.xxhash64(F.col(id_col).cast("long"), text)) \
        .toDF(*(f"c{i}" for i in range(len(names))), row)
    both = squeezed(sent, f"c{at}").join(spans.hint("shuffle_hash"), row, "left").drop(row)
    kept = StructType([StructField(f.name, StringType()) if i == at else f
                       for i, f in enumerate(both.schema.fields[:-1])])

    def run(batches):
        for whole in batches:
            for s in range(0, whole.num_rows, 256):
                b = whole.slice(s, 256)
                texts = opened_texts(b.column(at))
                lists = b.column(b.num_columns - 1).to_pylist()
                out = []
                for t, found in zip(texts, lists):
                    if t is not None and found:
                        lo, n = (np.array([r[f] for r in found], np.int64) for f in ("lo", "n"))
                        t = kept_bytes(t, lo, n, window)[0]
                    out.append(None if t is None else t.decode("utf-8", "ignore"))
                cols = [*b.columns[:-1]]
                cols[at] = pa.array(out, pa.string())
                yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    return both.mapInArrow(run, kept).toDF(*names)
