"""Exact top-k inner products by KD-trees per shard.

The space is cut into cells by median splits on the widest dimension of a bounded
sample, and every row goes to its cell; a cell with more rows than a shard takes
(many copies of one vector, say) is dealt over several shards.  Each shard is one
stored tree: median splits on the widest dimension (of equal vectors, by id), a
tight bounding box for every node.  Queries travel in blocks of neighbours.  First a
block visits a shard of its own cell to learn a kth score and its id; then each of
its queries visits the shards of those cells whose tight box can reach that score,
and there a best-first walk opens leaves by their largest possible product with the
block's queries, each for the queries that it can still improve.  A leaf's scores
are one matrix product: in single precision for the choice of what may reach the kth
score (with its rounding allowed for), then exactly.  Nothing is approximated: the
sample decides where cells end, not what is searched.

The driver holds counts, splits and boxes of the cells only; the sample is split in
a task.  Queries meet a shard by cogrouping, so neither side is ever broadcast or
repeated for each meeting, and at most ``LOT`` numbers of queries meet it at once.

Defined cases: vectors that are null or hold null or non-finite components, and
rows without an id, take no part; only vectors of a query's own length are
scored; a score beyond 64 bits is given as the nearest 64-bit number; ties go to
the smaller id; repeated query rows are answered each; every candidate row counts,
also one that repeats another; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

SCALE, SHARD_ROWS, QUERY_ROWS, LEAF = 1024, 8192, 256, 512
#: Shards beyond which they get larger, as every query may have to visit each, and
#: the numbers that one gets then, at most; numbers of queries that meet it at once.
SHARDS, NUMBERS, LOT = 128, 1 << 22, 1 << 22
#: Numbers in the sample that places the cells; cells of one vector length, at most
#: (their boxes are all that the driver and every task hold of the table), and the
#: numbers of their lower corners.
SAMPLE, CELLS, CORNERS = 1 << 22, 2048, 1 << 18
#: Largest sum of products that float64 holds exactly.
EXACT = float(1 << 53)
_LAST = np.iinfo(np.int64).max


def _pack(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _load(blob: bytes) -> dict:
    with np.load(io.BytesIO(blob)) as z:
        return dict(z)


def whole(vectors: pa.Array, dim: int) -> np.ndarray:
    """floor(SCALE * x) of a list array, as float64 (whole numbers)."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).reshape(-1, dim)


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest type that holds them."""
    most = np.abs(x).max(initial=0)
    return x.astype(np.int16 if most < 1 << 15 else np.float32 if most <= 1 << 24 else np.float64)


def build(ids: np.ndarray, vecs: np.ndarray) -> dict:
    """KD-tree arrays: rows in leaf order; per node box, row range, children."""
    order = np.lexsort((ids,))
    lo, hi, span, kids = [], [], [], []

    def node(a: int, b: int) -> int:
        at, part = len(span), vecs[order[a:b]]
        lo.append(part.min(axis=0))
        hi.append(part.max(axis=0))
        span.append((a, b))
        kids.append((-1, -1))
        wide = hi[at] - lo[at]
        if b - a > LEAF:
            mid = (a + b) // 2
            if wide.max(initial=0) > 0:
                by = np.argpartition(part[:, int(wide.argmax())], mid - a)
            else:
                by = np.argsort(ids[order[a:b]], kind="stable")
            order[a:b] = order[a:b][by]
            kids[at] = (node(a, mid), node(mid, b))
        return at

    node(0, len(ids))
    return {"ids": ids[order], "vecs": _narrow(vecs[order]), "lo": _narrow(np.array(lo)),
            "hi": _narrow(np.array(hi)), "span": np.array(span), "kids": np.array(kids)}


def opened(blob: bytes) -> dict:
    """A stored tree with what the search of many blocks shares."""
    tree = _load(blob)
    at = np.flatnonzero(tree["kids"][:, 0] < 0)
    span, vecs = tree["span"][at], tree["vecs"]
    size = np.sqrt(np.square(vecs, dtype=np.float64).sum(axis=1)).max(initial=0)
    return tree | {"leaves": span, "rough": vecs.astype(np.float32), "size": float(size),
                   "most": float(np.abs(vecs.astype(np.float64)).max(initial=0)),
                   "low": tree["lo"][at].astype(np.float64), "high": tree["hi"][at].astype(np.float64),
                   "least": np.array([tree["ids"][a:b].min() for a, b in span])}


def _scores(vecs: np.ndarray, q: np.ndarray) -> np.ndarray:
    if vecs.size == 0 or np.abs(vecs).max() * np.abs(q).sum() < EXACT:
        return (vecs @ q).astype(np.int64)
    return np.array([sum(int(x) * int(y) for x, y in zip(v, q)) for v in vecs], object)


def search(tree: dict, own: int, q: np.ndarray, bounds: np.ndarray, k: int,
           kth: float) -> list[tuple[int, int]]:
    """Best (score, vec_id) of one shard, k at most, none below ``kth``."""
    best: list[tuple[int, int]] = []  # heap of (score, -vec_id)
    todo = [(-bounds[0], 0)]
    while todo:
        bound, at = heapq.heappop(todo)
        floor = max(kth, best[0][0]) if len(best) == k else kth
        if -bound < floor:
            break
        left, right = tree["kids"][at]
        if left >= 0:
            for c in (int(left), int(right)):
                if bounds[c] >= floor:
                    heapq.heappush(todo, (-bounds[c], c))
            continue
        a, b = tree["span"][at]
        got, ids = _scores(tree["vecs"][a:b], q), tree["ids"][a:b]
        for r in np.flatnonzero((got >= floor) & (ids != own)):
            item = (int(got[r]), -int(ids[r]))
            if len(best) < k:
                heapq.heappush(best, item)
            elif item > best[0]:
                heapq.heapreplace(best, item)
    return [(s, -i) for s, i in best]


def _walk(tree: dict, block: dict, k: int) -> list[tuple[int, list]]:
    """Every query by itself, with scores that float64 cannot hold."""
    q = block["vecs"].astype(np.float64)
    lo, hi = tree["lo"].astype(np.float64), tree["hi"].astype(np.float64)
    bounds = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
    bounds += np.abs(bounds) * 1e-9  # rounding never closes a box
    tree = tree | {"vecs": tree["vecs"].astype(np.float64)}
    for n in range(len(q)):
        yield n, search(tree, int(block["ids"][n]), q[n], bounds[n], k,
                        float(block["kth"][n]))


def _below(score: int) -> float:
    """The score, or the next smaller number that float64 holds."""
    out = float(score)
    return out if int(out) <= score else float(np.nextafter(out, -np.inf))


class Best:
    """The k best (score, id) of every query so far, and what a row must reach."""

    def __init__(self, kth: np.ndarray, kid: np.ndarray, k: int):
        self.score = np.full((len(kth), k), -np.inf)
        self.id = np.full((len(kth), k), _LAST)
        self.kth, self.kid, self.k = kth.copy(), kid.copy(), k
        self.new: list = []
        self.many = 0

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self.new.append((query, score, ids))
        self.many += len(query)
        if self.many > 2 * self.kth.size:
            self.merge()

    def merge(self) -> None:
        if not self.new:
            return
        query, score, ids = (np.concatenate(x) for x in zip(*self.new))
        self.new, self.many = [], 0
        at = np.unique(query)
        query = np.concatenate([query, np.repeat(at, self.k)])
        score = np.concatenate([score, self.score[at].ravel()])
        ids = np.concatenate([ids, self.id[at].ravel()])
        order = np.lexsort((ids, -score, query))
        query = query[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        top = rank < self.k
        query, rank, order = query[top], rank[top], order[top]
        self.score[query, rank], self.id[query, rank] = score[order], ids[order]
        kth, kid = self.score[at, -1], self.id[at, -1]
        up = (kth > self.kth[at]) | (kth == self.kth[at]) & (kid < self.kid[at])
        self.kth[at[up]], self.kid[at[up]] = kth[up], kid[up]


def search_block(tree: dict, block: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's number in the block, score, vec_id) of the rows of one shard that are
    among its k best for a query and not behind the query's (kth, kid)."""
    q, own = block["vecs"].astype(np.float64), block["ids"]
    if tree["most"] * np.abs(q).sum(axis=1).max(initial=0) >= EXACT:
        out = [(n, min(max(s, -(1 << 63)), (1 << 63) - 1), i)
               for n, hits in _walk(tree, block, k) for s, i in hits]
        return tuple(np.array([x[c] for x in out], np.int64) for c in range(3))
    bounds = np.maximum(q, 0) @ tree["high"].T + np.minimum(q, 0) @ tree["low"].T
    rough, dim = q.astype(np.float32), q.shape[1]
    slack = (dim + 8) * 2.0 ** -23 * np.sqrt(np.square(q).sum(axis=1)) * tree["size"]
    best = Best(block["kth"], block["kid"], k)
    wide = int((tree["leaves"][:, 1] - tree["leaves"][:, 0]).max(initial=0))
    room, hit = np.empty(len(q) * wide, np.float32), np.empty(len(q) * wide, bool)
    for leaf in np.argsort(-bounds.max(axis=0, initial=-np.inf), kind="stable").tolist():
        reach = bounds[:, leaf]
        mine = np.flatnonzero((reach > best.kth) | (reach == best.kth)
                              & (tree["least"][leaf] <= best.kid))
        if not len(mine):
            continue
        a, b = tree["leaves"][leaf]
        kth = best.kth[mine]
        if np.isfinite(kth).all():
            least = (kth - slack[mine]).astype(np.float32)
            size = len(mine) * (b - a)
            near = np.matmul(rough if len(mine) == len(q) else rough[mine], tree["rough"][a:b].T,
                             out=room[:size].reshape(len(mine), b - a))
            over = np.greater_equal(near, least[:, None], out=hit[:size].reshape(near.shape))
            r, c = np.divmod(np.flatnonzero(over), b - a)
            got = np.einsum("ij,ij->i", q[mine[r]], tree["vecs"][a + c].astype(np.float64))
        else:
            all_got = q[mine] @ tree["vecs"][a:b].astype(np.float64).T
            r, c = np.nonzero(all_got >= kth[:, None])
            got = all_got[r, c]
        query, ids = mine[r], tree["ids"][a + c]
        ok = ((got > kth[r]) | (got == kth[r]) & (ids <= best.kid[query])) & (ids != own[query])
        if ok.any():
            best.add(query[ok], got[ok], ids[ok])
    best.merge()
    query, rank = np.nonzero(np.isfinite(best.score))
    return query, best.score[query, rank].astype(np.int64), best.id[query, rank]


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    ok = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x)
                  & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()) \
        .where(ok).select(F.col(id_col).cast("long").alias("id"),
                          F.size(vec_col).alias("dim"), F.col(vec_col).alias("vec"))


def split(vecs: np.ndarray, cells: int) -> dict:
    """Median splits on the widest dimension: arrays dim, at, kids per node; a leaf
    has the number of its cell in ``kids``, and neighbours have near numbers."""
    dims, ats, kids, leaves = [], [], [], [0]

    def node(part: np.ndarray, want: int) -> int:
        n = len(dims)
        dims.append(-1), ats.append(0.0), kids.append((leaves[0], -1))
        if want > 1 and part.size:
            wide = np.ptp(part, axis=0)
            d = int(wide.argmax())
            if wide[d] > 0:
                at = np.median(part[:, d])
                at = at if (part[:, d] < at).any() else part[part[:, d] > at, d].min()
                right = part[:, d] >= at
                dims[n], ats[n] = d, at
                kids[n] = (node(part[~right], want // 2), node(part[right], want - want // 2))
                return n
        leaves[0] += 1
        return n

    node(vecs, cells)
    return {"dim": np.array(dims), "at": np.array(ats), "kids": np.array(kids),
            "cells": leaves[0]}


def cells_of(tree: dict | None, vecs: np.ndarray) -> np.ndarray:
    """The cell of every vector (0 for lengths that the sample has not met)."""
    if tree is None:
        return np.zeros(len(vecs), np.int64)
    at = np.zeros(len(vecs), np.int64)
    while True:
        d = tree["dim"][at]
        inner = np.flatnonzero(d >= 0)
        if not len(inner):
            return tree["kids"][at, 0]
        right = vecs[inner, d[inner]] >= tree["at"][at[inner]]
        at[inner] = tree["kids"][at[inner], right.astype(int)]


def _by_dim(b: pa.RecordBatch):
    """(dim, rows of the batch, their whole vectors) of every vector length."""
    dims, vec = b.column("dim").to_numpy(), b.column("vec")
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        part = vec.take(pa.array(at))
        yield dim, at, whole(part, dim) if dim else np.zeros((len(at), 0))


def shard_rows(n: int, dim: int, limits: tuple | None = None) -> int:
    """Rows of a shard, if there are ``n`` in all."""
    least, shards, numbers = limits or (SHARD_ROWS, SHARDS, NUMBERS)
    return max(least, min(n // shards, numbers // max(dim, 1)))


def split_trees(rows: DataFrame) -> dict[int, dict]:
    """dim -> split of the space, from a sample of at most ``SAMPLE`` numbers that one
    task reads."""
    n, size = rows.agg(F.count(F.lit(1)), F.max("dim")).first()
    most, limits = max(1, SAMPLE // (size or 1)), (SHARD_ROWS, SHARDS, NUMBERS)

    def run(batches):
        for b in pa.Table.from_batches(list(batches), schema).combine_chunks().to_batches():
            for dim, at, vecs in _by_dim(b):
                share = -(-n * len(at) // b.num_rows)
                cells = min(CELLS, max(1, CORNERS // max(dim, 1)),
                            max(1, -(-share // shard_rows(share, dim, limits))))
                yield pa.record_batch([pa.array([dim], pa.int32()),
                                       pa.array([_pack(**split(vecs, cells))], pa.binary())],
                                      names=["dim", "tree"])

    some = rows.select("dim", "vec").sample(min(1.0, 1.2 * most / max(n, 1)), seed=7).limit(most)
    schema = pa.schema([("dim", pa.int32()), ("vec", to_arrow_type(some.schema["vec"].dataType))])
    found = some.mapInArrow(run, "dim int, tree binary").collect()
    return {r["dim"]: _load(r["tree"]) for r in found}


def cell_counts(rows: DataFrame, trees: dict[int, dict]) -> dict[int, np.ndarray]:
    """dim -> rows of every cell."""
    def run(batches):
        seen = {dim: np.zeros(int(t["cells"]), np.int64) for dim, t in trees.items()}
        for b in batches:
            for dim, _, vecs in _by_dim(b):
                if dim in seen:
                    seen[dim] += np.bincount(cells_of(trees[dim], vecs), minlength=len(seen[dim]))
        for dim, n in seen.items():
            cell = np.flatnonzero(n)
            yield pa.record_batch([pa.array(np.full(len(cell), dim, np.int32)),
                                   pa.array(cell.astype(np.int32)), pa.array(n[cell])],
                                  names=["dim", "cell", "n"])

    found = rows.select("dim", "vec").mapInArrow(run, "dim int, cell int, n long") \
        .groupBy("dim", "cell").agg(F.sum("n").alias("n")).toArrow()
    dims, cell, n = (found.column(c).to_numpy() for c in ("dim", "cell", "n"))
    out = {}
    for dim in np.unique(dims).tolist():
        out[dim] = np.zeros(int(trees[dim]["cells"]), np.int64)
        out[dim][cell[dims == dim]] = n[dims == dim]
    return out


def cell_boxes(rows: DataFrame, trees: dict[int, dict]) -> dict[int, dict]:
    """dim -> rows and tight box (lo, hi) of every cell."""
    def run(batches):
        seen: dict = {}
        for b in batches:
            for dim, _, vecs in _by_dim(b):
                if dim not in trees:
                    continue
                cell = cells_of(trees[dim], vecs)
                order = np.argsort(cell, kind="stable")
                which, first = np.unique(cell[order], return_index=True)
                for c, part in zip(which.tolist(), np.split(vecs[order], first[1:])):
                    n, lo, hi = seen.get((dim, c), (0, np.inf, -np.inf))
                    seen[dim, c] = (n + len(part), np.minimum(lo, part.min(axis=0)),
                                    np.maximum(hi, part.max(axis=0)))
        for (dim, c), (n, lo, hi) in seen.items():
            k = max(dim, 1)  # an empty vector has a row for its count
            lo, hi = (np.broadcast_to(x, dim) if dim else np.zeros(1) for x in (lo, hi))
            yield pa.record_batch(
                [pa.array(np.full(k, x, np.int32)) for x in (dim, c)]
                + [pa.array(np.arange(k, dtype=np.int32)), pa.array(np.full(k, n)),
                   pa.array(lo), pa.array(hi)], names=["dim", "cell", "d", "n", "lo", "hi"])

    parts = rows.select("dim", "vec").mapInArrow(
        run, "dim int, cell int, d int, n long, lo double, hi double")
    found = parts.groupBy("dim", "cell", "d").agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow()
    all_of = {c: found.column(c).to_numpy() for c in found.column_names}
    boxes = {}
    for dim in np.unique(all_of["dim"]).tolist():
        t = {c: x[all_of["dim"] == dim] for c, x in all_of.items()}
        cells = int(trees[dim]["cells"])
        n, lo, hi = np.zeros(cells, np.int64), np.full((cells, dim), np.inf), np.full((cells, dim), -np.inf)
        n[t["cell"]] = t["n"]
        if dim:
            lo[t["cell"], t["d"]], hi[t["cell"], t["d"]] = t["lo"], t["hi"]
        boxes[dim] = {"n": n, "lo": lo, "hi": hi}
    return boxes


def _dealt(rows: DataFrame, trees: dict, per_cell: dict[int, np.ndarray], rows_per,
           join_cells: bool) -> tuple[DataFrame, dict[int, dict]]:
    """(id, dim, vec, part): rows dealt by cell.  A cell of many rows has several
    parts; with ``join_cells`` neighbouring cells of few rows share one.  Also, per
    dim, the first part and number of parts of every cell."""
    plan = {}
    for dim, n in per_cell.items():
        most = rows_per(int(n.sum()), dim)
        parts = np.maximum(1, -(-n // most))
        if join_cells:
            first = (np.cumsum(n) - n) // most
            parts = np.where(n > most, parts, 1)
        else:
            first = np.cumsum(parts) - parts
        plan[dim] = {"first": first, "parts": parts}

    def run(batches):
        for b in batches:
            out = np.zeros(b.num_rows, np.int32)
            deal = b.column("deal").to_numpy()
            for dim, at, vecs in _by_dim(b):
                if dim in plan:
                    cell = cells_of(trees[dim], vecs)
                    p = plan[dim]
                    out[at] = p["first"][cell] + deal[at] % p["parts"][cell]
            yield pa.record_batch([b.column("id"), b.column("dim"), b.column("vec"), pa.array(out)],
                                  names=["id", "dim", "vec", "part"])

    # by row, not by id: rows may repeat
    deal = F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(1 << 40))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.withColumn("deal", deal).mapInArrow(run, f"{kinds}, part int"), plan


def _grouped(dealt: DataFrame, name: str, make) -> DataFrame:
    """One stored blob for each (dim, part)."""
    def run(key, t):
        dim = key[0].as_py()
        t = t.combine_chunks()
        vec = pa.concat_arrays(t.column("vec").chunks) if t.num_rows else None
        blob = make(t.column("id").to_numpy(), whole(vec, dim) if dim
                    else np.zeros((t.num_rows, 0)))
        return pa.table({"dim": pa.array([dim], pa.int32()),
                         "part": pa.array([key[1].as_py()], pa.int32()),
                         "blob": pa.array([blob], pa.binary())})

    made = dealt.groupBy("dim", "part").applyInArrow(run, "dim int, part int, blob binary")
    return stored(made, name)


_QUERY = pa.schema([("dim", pa.int32()), ("block", pa.int32()), ("part", pa.int32()),
                    ("q", pa.binary())])
_HITS = pa.schema([("dim", pa.int32()), ("block", pa.int32()), ("hits", pa.binary())])


def _bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Largest product of every query with every box; rounding never closes one."""
    lo, hi = np.where(np.isfinite(lo), lo, 0), np.where(np.isfinite(hi), hi, 0)
    out = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
    return out + np.abs(out) * 1e-9


def visits(bounded: DataFrame, boxes: dict[int, dict], plan: dict[int, dict]) -> DataFrame:
    """(dim, block, part, q): every shard that some query of a block must visit,
    with those queries only."""
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                block, box = _load(r["q"]), boxes.get(r["dim"])
                if box is None:  # a length that the sample has not met: one shard
                    wants = [(0, 1, np.ones(len(block["ids"]), bool))]
                else:
                    near = _bounds(block["vecs"], box["lo"], box["hi"]) >= block["kth"][:, None]
                    p = plan[r["dim"]]
                    wants = [(int(p["first"][c]), int(p["parts"][c]), near[:, c])
                             for c in np.flatnonzero(near.any(axis=0) & (box["n"] > 0))]
                for first, parts, mine in wants:
                    part = _pack(**{k: v[mine] for k, v in block.items()})
                    yield pa.RecordBatch.from_pylist(
                        [{"dim": r["dim"], "block": r["block"], "part": first + k, "q": part}
                         for k in range(parts)], schema=_QUERY)

    return bounded.mapInArrow(run, "dim int, block int, part int, q binary")


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id",
          vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows whose id ``every`` divides."""
    return search_index(*prepare(vectors, k, every, id_col, vec_col), k)


def prepare(vectors: DataFrame, k: int, every: int, id_col: str, vec_col: str):
    """(index, bounded query blocks, cell boxes, plan of shards), stored."""
    rows = usable(vectors, id_col, vec_col)
    asked = rows.where(F.pmod("id", F.lit(every)) == 0)
    trees = split_trees(rows)
    boxes = cell_boxes(rows, trees)
    dealt, plan = _dealt(rows, trees, {d: b["n"] for d, b in boxes.items()}, shard_rows, False)
    index = _grouped(dealt, "kd-trees", lambda i, v: _pack(**build(i, v)))
    blocks, asks = _dealt(asked, trees, cell_counts(asked, trees), lambda n, dim: QUERY_ROWS, True)
    for dim, p in asks.items():
        plan[dim]["blocks"] = int((p["first"] + p["parts"]).max(initial=1))
    start = _grouped(blocks, "queries", lambda i, v: _pack(
        ids=i, vecs=_narrow(v), pos=np.arange(len(i)), kth=np.full(len(i), -np.inf),
        kid=np.full(len(i), _LAST)))

    def settle(batches):  # the shard that a block learns from: its middle query's
        for b in batches:
            for r in b.to_pylist():
                block, part = _load(r["blob"]), 0
                if r["dim"] in plan:
                    mid = block["vecs"][len(block["ids"]) // 2:][:1]
                    part = int(plan[r["dim"]]["first"][cells_of(trees[r["dim"]], mid)[0]])
                yield pa.RecordBatch.from_pylist(
                    [{"dim": r["dim"], "block": r["part"], "part": part, "q": r["blob"]}],
                    schema=_QUERY)

    def learn(key, asked, shard):  # the kth score in one shard bounds the rest
        tree = opened(shard.column("blob")[0].as_py()) if shard.num_rows else None
        out = []
        for blob in asked.column("q").to_pylist():
            block = _load(blob)
            if tree is not None:
                n, score, ids = search_block(tree, block, k)
                last = np.flatnonzero(np.bincount(n, minlength=len(block["ids"])) == k)
                for p in last.tolist():
                    mine = n == p
                    block["kth"][p] = _below(int(score[mine].min()))
                    if block["kth"][p] < EXACT:
                        block["kid"][p] = ids[mine][score[mine] == score[mine].min()].max()
            out.append(_pack(**block))
        return pa.table([asked.column("dim"), asked.column("block"), pa.array(out, pa.binary())],
                        names=["dim", "block", "q"])

    home = start.mapInArrow(settle, "dim int, block int, part int, q binary")
    bounded = stored(home.groupBy("dim", "part").cogroup(index.groupBy("dim", "part"))
                     .applyInArrow(learn, "dim int, block int, q binary"), "bounded-queries")
    return index, bounded, boxes, plan


def search_index(index: DataFrame, bounded: DataFrame, boxes: dict, plan: dict,
                 k: int) -> DataFrame:
    def answer(key, asked, shard):
        if not (asked.num_rows and shard.num_rows):
            return _HITS.empty_table()
        tree, hits = opened(shard.column("blob")[0].as_py()), []
        for blob in asked.column("q").to_pylist():
            block = _load(blob)
            n, score, ids = search_block(tree, block, k)
            hits.append(_pack(pos=block["pos"][n], query=block["ids"][n], score=score, id=ids))
        return pa.table([asked.column("dim"), asked.column("block"), pa.array(hits, pa.binary())],
                        schema=_HITS)

    def best(key, t):
        hits = [_load(x) for x in t.column("hits").to_pylist()]
        pos, query, score, ids = (np.concatenate([h[c] for h in hits])
                                  for c in ("pos", "query", "score", "id"))
        order = np.lexsort((ids, ~score, pos))
        pos = pos[order]
        rank = np.arange(len(pos)) - np.searchsorted(pos, pos) + 1
        top = order[rank <= k]
        return pa.table([pa.array(query[top]), pa.array(rank[rank <= k].astype(np.int32)),
                         pa.array(ids[top]), pa.array(score[top])],
                        names=["query_id", "rank", "vec_id", "score"])

    # a shard meets the queries of one lot at a time
    lots, lot = F.lit(1), F.lit(0)
    for dim, p in plan.items():
        per = max(1, LOT // (QUERY_ROWS * max(dim, 1)))
        if p.get("blocks", 1) > per:
            lots = F.when(F.col("dim") == dim, -(-p["blocks"] // per)).otherwise(lots)
            lot = F.when(F.col("dim") == dim, F.floor(F.col("block") / per).cast("int")).otherwise(lot)
    shards = index.withColumn("lot", F.explode(F.sequence(F.lit(0), lots - 1)))
    asked = visits(bounded, boxes, plan).withColumn("lot", lot)
    keys = ["dim", "part", "lot"]
    found = asked.groupBy(*keys).cogroup(shards.groupBy(*keys)) \
        .applyInArrow(answer, "dim int, block int, hits binary")
    return found.groupBy("dim", "block").applyInArrow(
        best, "query_id long, rank int, vec_id long, score long")
