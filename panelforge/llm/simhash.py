"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into as few segments as make one of them differ
by at most one bit: with a distance of 4, three segments (5 differing bits at
least would be needed to put two into each).  Every segment is indexed under its
one-wildcard variants, one key for each of its bits left out; two fingerprints
within the distance share a key.  Keys are joined by equality (one shuffle) and
every candidate is verified on all bits.

Equal fingerprints are one index row whatever number of documents has them.  A
key with more than ``BLOCK`` fingerprints is cut into blocks, and pairs of
blocks are separate groups, so no task holds a whole hot key; a group gives back
a spanning forest of its links, never all pairs.  Components are found by star
contraction over stored edges.

Defined cases: a null or blank text has fingerprint zero and is linked like any
other; a null id takes part and gets its component's smallest id; repeated rows
each come out; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored
from .components import components
from .texts import keyed

#: Fixed by the contract.
SHINGLE, DISTANCE, SEED = 4, 4, 42
#: Fingerprints of one key that are compared in one group.
BLOCK = 4096
#: Shingles hashed at a time (a very long text takes several turns).
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Bits set in over half of the XXH64 hashes of the word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    starts, ends = starts[:n].tolist(), ends[len(words) - n:].tolist()
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        h = np.array([digest(joined[a:b], SEED) for a, b in
                      zip(starts[at:at + CHUNK], ends[at:at + CHUNK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                              bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int.from_bytes(bits.tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row, fp) of every row: its key (see ``keyed``) and fingerprint, a
    signed long."""
    rows = keyed(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), b.column("row"), pa.array(fps, pa.int64())],
                                  names=["doc_id", "row", "fp"])

    return rows.mapInArrow(run, "doc_id long, row long, fp long")


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the fewest segments of which one differs by <= 1."""
    n = distance // 2 + 1
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def variants(reps: DataFrame, distance: int) -> DataFrame:
    """(key, fp): every fingerprint under the one-wildcard variants."""
    keys = []
    for first, width in segments(distance):
        seg = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1))
        for bit in range(width):
            left = seg.bitwiseAND(F.lit(((1 << width) - 1) & ~(1 << bit)))
            keys.append(F.shiftleft(left, 6).bitwiseOR(F.lit(first + bit).cast("long")))
    return reps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node that each of 0..n-1 reaches over the links (a, b)."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, low[a], m)
        np.minimum.at(new, low[b], m)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _links(fps: np.ndarray, first: np.ndarray, distance: int) -> tuple[list, list]:
    """Links inside groups; ``first`` marks the first row of each group."""
    fps = fps.view(np.uint64)  # the bit count of a negative number is another
    n, rows_a, rows_b = len(fps), [], []
    group = np.cumsum(first)
    size = np.bincount(group)[group]
    rows = np.flatnonzero(size > 1)
    step = 1
    while len(rows) and step < 64:  # all small groups at once, by distance of rows
        rows = rows[rows + step < n]
        rows = rows[group[rows] == group[rows + step]]
        near = np.bitwise_count(fps[rows] ^ fps[rows + step]) <= distance
        rows_a.append(rows[near])
        rows_b.append(rows[near] + step)
        step += 1
    starts = np.flatnonzero(first)
    for s, e in zip(starts, np.append(starts[1:], n)):
        if e - s > 64:  # the rest of a large group, some rows against all
            part, low = fps[s:e], np.arange(e - s)
            for at in range(0, e - s, 256):
                x, y = np.nonzero(np.bitwise_count(
                    part[at:at + 256, None] ^ part[None, :]) <= distance)
                x += at
                up = low[x] != low[y]
                low = _forest(e - s, low[x[up]], low[y[up]])[low] if up.any() else low
            linked = np.flatnonzero(low != np.arange(e - s))
            rows_a.append(s + low[linked])
            rows_b.append(s + linked)
    return rows_a, rows_b


def candidate_links(reps: DataFrame, distance: int = DISTANCE,
                    block: int = BLOCK) -> DataFrame:
    """(a, b): links between fingerprints; together they span every component."""
    index = variants(reps, distance)
    hot = index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block) \
        .select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    cut = index.join(stored(hot, "hot-keys"), "key", "left") \
        .withColumn("blocks", F.coalesce("blocks", F.lit(1))) \
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .select("key", F.least("own", "other").alias("i"),
                F.greatest("own", "other").alias("j"), "fp")
    parts = cut.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")

    def run(batches):
        held = [np.empty(0, np.int64)] * 4

        def links(cols):
            key, i, j, fp = cols
            first = np.ones(len(fp), bool)
            first[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            a, b = _links(fp, first, distance)
            a, b = np.concatenate([[], *a]).astype(int), np.concatenate([[], *b]).astype(int)
            low = _forest(len(fp), a, b)
            linked = np.flatnonzero(low != np.arange(len(fp)))
            return pa.record_batch([pa.array(fp[low[linked]]), pa.array(fp[linked])],
                                   names=["a", "b"])

        for batch in batches:
            cols = [np.concatenate([h, c.to_numpy(zero_copy_only=False).astype(np.int64)])
                    for h, c in zip(held, batch.columns)]
            same = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1]) & (cols[2] == cols[2][-1])
            cutoff = int(np.argmax(same))  # the last group may go on
            held = [c[cutoff:] for c in cols]
            if cutoff:
                yield links([c[:cutoff] for c in cols])
        if len(held[0]):
            yield links(held)

    return parts.mapInArrow(run, "a long, b long").where("a <> b") \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _named(docs: DataFrame, id_col: str, text_col: str, shingle: int,
           distance: int) -> DataFrame:
    """(doc_id, row, fp, root, component_id) of every row."""
    prints = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    reps = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "fp-classes")
    edges = stored(candidate_links(reps.select("fp"), distance), "fp-links")
    roots = components(edges)
    classes = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    names = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(classes.join(names, "root").select("fp", "root", "component_id"),
                   "fp-components")
    return prints.join(named, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id) of every row."""
    return _named(docs, id_col, text_col, shingle, distance) \
        .select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all its columns: that of smallest id, null
    ids last, and of rows that share this id the one of smallest key."""
    found = stored(_named(docs, id_col, text_col, SHINGLE, DISTANCE), "near-duplicates")
    rows = found.groupBy("root", "doc_id", "row").agg(F.count(F.lit(1)).alias("n"))
    stay = stored(rows.groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("last"), "doc_id", "row", "n")).alias("one"))
        .select("one.row", "one.n"), "survivors")
    (row,) = fresh(docs, "__row")
    key = F.xxhash64(F.col(id_col).cast("long"),
                     F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    have = docs.withColumn(row, key)
    # the keys are the hashed side, so texts are moved once and not sorted
    once = have.join(stay.where("n = 1").select(F.col("row").alias(row)).hint("shuffle_hash"),
                     row, "left_semi")
    if stay.where("n > 1").isEmpty():
        return once.drop(row)
    # only rows that repeat a survivor are moved once more
    more = have.join(stay.where("n > 1").select(F.col("row").alias(row)), row, "left_semi")
    return once.unionByName(more.dropDuplicates([row])).drop(row)
