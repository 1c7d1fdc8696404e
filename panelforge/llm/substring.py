"""Substring deduplication by recompression.

A window of ``WINDOW`` words is removed if its words also start in a document of
smaller id.  Every task recompresses its texts with the same global names (see
``recompress``), and windows that share a high-level symbol go together as a
block: one row says where the block lies, which symbol it hangs on and the hash
of all its words.  Then Spark

1. keeps the blocks whose symbol occurs in two documents or more,
2. groups equal blocks (symbol and words): all but those of the smallest id go,
3. and only where one symbol stands in unlike surroundings (the edges of a
   repeat) compares single windows, by their hashes, among the blocks' first
   documents, and takes the answers back to every equal block of that id.

Counts and minima are pre-aggregated and joins are left to the adaptive skew
split, so a passage that a third of all documents share is no task's burden; the
single windows of a symbol with more than ``HOT`` unlike surroundings are dealt
by their own hash.  Texts are moved compressed, by a key of row content.

Defined cases: a null text has no words; texts of any length are taken whole, in
stretches; a null id neither removes nor is
removed; rows that share an id are judged each and never by one another; equal
rows have equal results; an empty table gives no rows; other columns are unread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from . import recompress as R
from .common import stored
from .texts import keyed, opened_texts, squeezed

WINDOW = 50
#: Bytes of text and words that the numpy kernels take at a time.
BYTES, WORDS = 1 << 19, 1 << 17
#: Unlike surroundings of one symbol that are compared in one group.
HOT = 2000


def _pieces(texts: list[bytes]):
    """Lists of (text number, bytes) of about BYTES; longer texts are cut."""
    group, size = [], 0
    for n, t in enumerate(texts):
        at = 0
        while at < len(t) or at == 0:
            end = at + BYTES
            while end < len(t) and not R._SPACE[t[end]]:
                end += 1
            part = t[at:end] if at or end < len(t) else t
            if group and size + len(part) > BYTES:
                yield group
                group, size = [], 0
            group.append((n, part))
            size += len(part)
            at = end
    if group:
        yield group


def named_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Names of the words of all texts, and how many words each has."""
    names, of = [np.empty(0, R.U)], [np.empty(0, np.int64)]
    for group in _pieces(texts):
        start, end, piece, data = R.words([p for _, p in group])
        names.append(R.word_names(data, start, end))
        of.append(np.array([n for n, _ in group])[piece])
    return np.concatenate(names), np.bincount(np.concatenate(of), minlength=len(texts))


def block_rows(texts: list[bytes], window: int):
    """Columns name, context, text number, first window, windows."""
    names, size = named_words(texts)
    text = np.repeat(np.arange(len(texts)), size)
    out, at, step = [], 0, max(WORDS, 2 * window)
    start = np.cumsum(size) - size
    while at < len(names):
        end = min(at + step, len(names))
        name, ctx, t, lo, n = R.blocks(names[at:end], text[at:end] - text[at], window)
        t = t + text[at]
        # the first text of a piece may have begun before the piece
        lo = lo + np.where(t == text[at], at - start[text[at]], 0)
        out.append((name, ctx, t, lo, n))
        if end == len(names):
            break
        # windows that lie whole before the cut are done
        at = max(start[text[end]], end - window + 1)
    if not out:
        return [np.empty(0, np.int64)] * 5
    return [np.concatenate(c) for c in zip(*out)]


def blocks(rows: DataFrame, window: int) -> DataFrame:
    """(name, context, row, doc_id, lo, n) of every block."""
    def run(batches):
        for b in batches:
            name, ctx, t, lo, n = block_rows(b.column("text").to_pylist(), window)
            pick = pa.array(t)
            yield pa.record_batch(
                [pa.array(name.astype(R.U).view(np.int64)), pa.array(ctx.astype(R.U).view(np.int64)),
                 b.column("row").take(pick), b.column("doc_id").take(pick),
                 pa.array(lo.astype(np.int32)), pa.array(n.astype(np.int32))],
                names=["name", "context", "row", "doc_id", "lo", "n"])

    return rows.select("row", "doc_id", "text").mapInArrow(
        run, "name long, context long, row long, doc_id long, lo int, n int")


def window_hashes(asked: DataFrame, window: int) -> DataFrame:
    """(name, context, doc_id, hot, windows) from texts joined with ``want``."""
    def run(batches):
        for whole in batches:
            for s in range(0, whole.num_rows, 64):
                b = whole.slice(s, 64)
                names, size = named_words(opened_texts(b.column("text")))
                start, roll = np.cumsum(size) - size, R.Rolling(names)
                want = b.column("want")
                per = np.diff(want.offsets.to_numpy())
                w = want.flatten()
                lo, n = (w.field(f).to_numpy() for f in ("lo", "n"))
                of = np.repeat(np.arange(b.num_rows), per)
                ends = np.cumsum(n)
                at = np.repeat(start[of] + lo - (ends - n), n) + np.arange(n.sum())
                hashes = roll.of(at, at + window).view(np.int64)
                yield pa.record_batch(
                    [*(w.field(f) for f in ("name", "context", "doc_id", "hot")),
                     pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)),
                                              pa.array(hashes))],
                    names=["name", "context", "doc_id", "hot", "windows"])

    return asked.mapInArrow(
        run, "name long, context long, doc_id long, hot boolean, windows array<long>")


def removed_windows(rows: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """(row, lo, n): runs of removed window starts of every row key."""
    found = stored(blocks(rows, window), "blocks")  # read twice
    # aggregates are stored before they are joined: only a join of two plain
    # exchanges is split where a key is hot
    names = stored(found.groupBy("name").agg(
        F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        .where("a < b").select("name"), "shared-names")
    shared = stored(found.join(names, "name", "left_semi"), "shared-blocks")
    classes = stored(shared.groupBy("name", "context").agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "row", "lo", "n")))
        .alias("first")).where("first is not null"), "block-classes")
    whole = shared.join(classes.select("name", "context", F.col("first.doc_id").alias("least")),
                        ["name", "context"]).where("doc_id > least").select("row", "lo", "n")
    unlike = stored(classes.groupBy("name").agg(F.count(F.lit(1)).alias("k"))
                    .where("k > 1"), "unlike-names")
    edge = classes.join(unlike, "name").select(
        "first.row", F.struct("name", "context", "first.doc_id", "first.lo", "first.n",
                              (F.col("k") > hot).alias("hot")).alias("w"))
    wanted = edge.groupBy("row").agg(F.collect_list("w").alias("want"))
    # rows equal in id and text share a key: their text is fetched once
    asked = squeezed(rows.select("row", "text")).dropDuplicates(["row"]).join(wanted, "row")
    single = stored(window_hashes(asked.select("row", "text", "want"), window), "edge-windows")

    def opened(df):
        return df.select("name", "context", "doc_id", F.posexplode("windows").alias("at", "w"))

    same = W.Window.partitionBy("name", "w")
    cold = opened(single.where(~F.col("hot")).repartition("name")) \
        .withColumn("least", F.min("doc_id").over(same)).where("doc_id > least")
    order = W.Window.partitionBy("name", "context").orderBy("at")
    cold = cold.withColumn("run", F.col("at") - F.row_number().over(order)) \
        .groupBy("name", "context", "doc_id", "run") \
        .agg(F.min("at").alias("at"), F.count(F.lit(1)).cast("int").alias("n")).drop("run")
    many = opened(single.where("hot"))
    least = stored(many.groupBy("name", "w").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .where("least < most"), "hot-windows")
    many = many.join(least, ["name", "w"]).where("doc_id > least") \
        .select("name", "context", "doc_id", "at", F.lit(1).alias("n"))
    # the class's other blocks of its least id have the first one's answers
    answers = stored(cold.unionByName(many), "edge-answers")
    edges = shared.drop("n").join(answers, ["name", "context", "doc_id"]) \
        .select("row", (F.col("lo") + F.col("at")).alias("lo"), "n")
    return whole.unionByName(edges)


def kept_words(text: bytes, lo: np.ndarray, n: np.ndarray, window: int) -> tuple[int, int, bytes]:
    """Words, removed words and the kept ones joined by a space."""
    words = text.split()
    if not len(lo):
        return len(words), 0, b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, lo, 1)
    np.add.at(edge, lo + n - 1 + window, -1)
    keep = np.cumsum(edge[:-1]) == 0
    left = [words[i] for i in np.flatnonzero(keep).tolist()]
    return len(words), len(words) - len(left), b" ".join(left)


def dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
          text_col: str = "text", hot: int = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row."""
    rows = keyed(docs, id_col, text_col)
    spans = removed_windows(rows, window, hot) \
        .groupBy("row").agg(F.collect_set(F.struct("lo", "n")).alias("spans"))
    both = squeezed(rows.select("row", "doc_id", "text")).join(spans, "row", "left") \
        .select("doc_id", "text", "spans")

    def run(batches):
        for whole in batches:
            for s in range(0, whole.num_rows, 256):
                b = whole.slice(s, 256)
                spans = b.column("spans")
                per = np.r_[0, np.cumsum(np.nan_to_num(
                    pa.compute.list_value_length(spans).to_numpy(zero_copy_only=False)))].astype(int)
                flat = spans.flatten()
                lo, n = flat.field("lo").to_numpy(), flat.field("n").to_numpy()
                out = [kept_words(t, lo[i:j], n[i:j], window) for t, i, j in
                       zip(opened_texts(b.column("text")), per[:-1].tolist(), per[1:].tolist())]
                yield pa.record_batch(
                    [b.column("doc_id"), pa.array([o[0] for o in out], pa.int64()),
                     pa.array([o[1] for o in out], pa.int64()),
                     pa.array([o[2].decode() for o in out], pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"])

    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
