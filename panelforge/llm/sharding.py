"""Sharding by fixed virtual slots.

A record's slot is a hash of its id and content, and of its number among equal
records, so repeated rows spread over slots like any others; there are always
``N_SLOTS`` slots, whatever the table's size.  Bytes and rows are summed per slot.
The slot-to-shard map is a stored table with versions: the first one deals the
slots out in turn, every later one is the newest stored one, loaded and edited:
some slots move so that the shards' bytes come closer, or to shards that were
added, or from shards that are gone.  Only the map (``N_SLOTS`` rows, a fixed
bound) is ever worked on by the driver or broadcast.

Defined cases: a null text has 0 bytes and the checksum of the empty string; a
null id is an id like any other; rows that are equal in id, size and checksum are
numbered, in any order, and each is a record of its own; texts of any length are
measured whole; an empty table gives no rows.  Columns other than the named ones
are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import window as W

from panelforge.session import scratch_path

from .common import stored

#: Fixed for the life of a data set; shards may come and go, slots do not.
N_SLOTS = 16_384
#: Bytes that a record costs besides its text.
RECORD_BYTES = 16


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            n_slots: int = N_SLOTS) -> DataFrame:
    """id, size, text_crc32 and virtual slot of every record."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = ["id", "size", "text_crc32"]
    rows = stored(docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(RECORD_BYTES)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.monotonically_increasing_id().alias("rid")), "shard-rows") \
        .withColumn("part", F.shiftrightunsigned("rid", 33))
    # equal records are numbered inside their input partition, on from those of
    # the partitions before, so no task holds all of them
    per_part = rows.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.Window.partitionBy(*key).orderBy("part")
    offsets = stored(per_part.withColumns({
        "total": F.sum("n").over(W.Window.partitionBy(*key)),
        "base": F.sum("n").over(before) - F.col("n")}).where("total > 1")
        .select(*(F.col(c).alias(f"o_{c}") for c in (*key, "part")), "base"), "equal-records")
    if offsets.isEmpty():
        numbered = rows.withColumn("number", F.lit(0).cast("long"))
    else:
        same = [F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in (*key, "part")]
        inside = F.row_number().over(W.Window.partitionBy(*key, "part").orderBy("rid")) - 1
        joined = rows.join(offsets, same, "left")
        numbered = joined.where("base IS NULL").withColumn("number", F.lit(0).cast("long")) \
            .unionByName(joined.where("base IS NOT NULL")
                         .withColumn("number", F.col("base") + inside))
    return numbered.select(*key, "number", F.pmod(
        F.xxhash64(*key, "number"), F.lit(n_slots)).cast("int").alias("vslot"))


def slot_weights(recs: DataFrame) -> DataFrame:
    """Bytes and rows per slot (at most ``N_SLOTS`` rows)."""
    return recs.groupBy("vslot").agg(F.sum("size").alias("bytes"),
                                     F.count(F.lit(1)).alias("rows"))


def first_map(n_slots: int, n_shards: int) -> np.ndarray:
    """Version 0: slots are dealt out in turn."""
    return np.arange(n_slots) % n_shards


def rebalance(shard_of: np.ndarray, weight: np.ndarray,
              n_shards: int) -> np.ndarray:
    """The next version of a map: slots leave shards above the mean load and
    go, largest first, to the lightest shard; then the heaviest and the
    lightest shard swap or pass slots while that narrows their difference."""
    shard_of = shard_of.copy()
    gone = np.flatnonzero(shard_of >= n_shards)  # of shards that are no more
    shard_of[gone] = gone % n_shards
    load = np.bincount(shard_of, weights=weight, minlength=n_shards).astype("int64")
    mean = int(weight.sum()) // n_shards
    moved: list[int] = []
    by_size = np.argsort(-weight, kind="stable")
    for slot in by_size:
        shard, w = shard_of[slot], int(weight[slot])
        if w and load[shard] - w >= mean:
            moved.append(slot)
            load[shard] -= w
    heap = [(int(x), s) for s, x in enumerate(load)]
    heapq.heapify(heap)
    for slot in moved:
        x, shard = heapq.heappop(heap)
        shard_of[slot] = shard
        load[shard] += int(weight[slot])
        heapq.heappush(heap, (int(load[shard]), shard))
    for _ in range(20 * n_shards):
        hi, lo = int(load.argmax()), int(load.argmin())
        gap = int(load[hi] - load[lo])
        mine = np.flatnonzero((shard_of == hi) & (weight > 0))
        theirs = np.flatnonzero((shard_of == lo) & (weight > 0))
        theirs_w = np.concatenate([[0], weight[theirs]])  # 0: pass, no swap
        order = np.argsort(theirs_w, kind="stable")
        # of all exchanges, the one that moves nearest to half the gap
        near = np.searchsorted(theirs_w[order], weight[mine] - gap / 2)
        near = np.clip(near, 0, len(order) - 1)
        step = weight[mine] - theirs_w[order[near]]
        gain = np.where((step > 0) & (step < gap), np.minimum(step, gap - step), 0)
        if not len(gain) or gain.max() <= 0:
            break
        k = int(gain.argmax())
        back = order[near[k]]
        shard_of[mine[k]] = lo
        if back:
            shard_of[theirs[back - 1]] = hi
        load[hi] -= step[k]
        load[lo] += step[k]
    return shard_of


MAP = "version int, vslot int, shard int, bytes long, rows long, first long"


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """A version of the stored map, the newest by default; None if there is none."""
    try:
        rows = spark.read.schema(MAP).parquet(path)
        last = rows.agg(F.max("version")).first()[0] if version is None else version
    except AnalysisException:
        return None
    return None if last is None else rows.where(F.col("version") == last)


def next_map(weights: DataFrame, path: str, n_shards: int, n_slots: int = N_SLOTS) -> DataFrame:
    """Load the newest version of the map at ``path``, edit it for today's slot
    weights and number of shards, store the result as the next version and return
    it.  Without a stored version the edited one starts from slots dealt in turn,
    which is stored as version 0.

    ``first`` is the position within the shard of the slot's first record.
    """
    spark = weights.sparkSession
    size, rows = np.zeros(n_slots, "int64"), np.zeros(n_slots, "int64")
    for r in weights.collect():  # one row a slot: a fixed bound
        size[r["vslot"]], rows[r["vslot"]] = r["bytes"], r["rows"]
    stored_map = load_map(spark, path)
    if stored_map is None:
        newest, old = 0, first_map(n_slots, n_shards)
        _save(spark, path, 0, old, size, rows, n_shards)
    else:
        kept = stored_map.select("version", "vslot", "shard").collect()  # one row a slot
        newest, old = kept[0]["version"], np.zeros(n_slots, "int64")
        for r in kept:
            old[r["vslot"]] = r["shard"]
    _save(spark, path, newest + 1, rebalance(old, size, n_shards), size, rows, n_shards)
    return load_map(spark, path, newest + 1)


def _save(spark, path: str, version: int, shard_of: np.ndarray, size: np.ndarray,
          rows: np.ndarray, n_shards: int) -> None:
    n_slots = len(shard_of)
    order = np.lexsort((np.arange(n_slots), shard_of))
    before = np.cumsum(rows[order]) - rows[order]
    start = np.zeros(max(n_shards, int(shard_of.max()) + 1), "int64")
    seen, at = np.unique(shard_of[order], return_index=True)
    start[seen] = before[at]
    first = np.empty(n_slots, "int64")
    first[order] = before - start[shard_of[order]]
    out = [(version, i, int(shard_of[i]), int(size[i]), int(rows[i]), int(first[i]))
           for i in range(n_slots)]
    # a version is a folder of its own; a run that dies leaves it without rows to
    # be seen, and the next run writes it again
    spark.createDataFrame(out, MAP).drop("version").coalesce(1).write.mode("overwrite") \
        .parquet(f"{path.rstrip('/')}/version={version}")


def shard(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id",
          text_col: str = "text", n_slots: int = N_SLOTS,
          map_path: str | None = None) -> DataFrame:
    """id, size, text_crc32, vslot, shard and position (gapless in a shard).

    ``map_path`` is the folder of the data set's map, whose next version this run
    writes; without one the map is made anew."""
    recs = stored(records(docs, id_col, text_col, n_slots), "shard-records")
    slots = next_map(slot_weights(recs), map_path or scratch_path(docs.sparkSession, "slot-map"),
                     n_shards, n_slots).select("vslot", "shard", "first")
    in_slot = W.Window.partitionBy("vslot").orderBy("id", "size", "text_crc32", "number")
    return (recs.withColumn("n", F.row_number().over(in_slot) - 1)
            .join(F.broadcast(slots), "vslot")
            .select("id", "size", "text_crc32", "vslot", "shard",
                    (F.col("first") + F.col("n")).alias("position")))
