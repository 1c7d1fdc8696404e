import math
import random

import numpy as np

from panelforge.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10, every=100):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows
          if i is not None and v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for i, q in ok:
        if i % every == 0:
            hits = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok
                          if j != i and len(v) == len(q))[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(hits)}
    return out


def check(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    rows = [tuple(r) for r in df.collect()]  # as 32-bit floats
    got = topk.top_k(df, **how).collect()
    assert {tuple(r) for r in got} == brute(rows, **how) and len(got) == len({tuple(r) for r in got})


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 300)
    monkeypatch.setattr(topk, "QUERY_ROWS", 7)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 5, 1) / 8 for _ in range(16)], 0) for i in range(1500)]
    rows += [(2000 + i, rows[100][1], 0) for i in range(40)]  # ties
    rows += [(5000, None, 0), (5100, [1.0, None], 0), (5200, [float("nan")] * 16, 0),
             (5300, [float("inf")] * 16, 0), (None, [0.0] * 16, 0), (5400, [1.0, 2.0], 0),
             (5401, [3.0, -2.0], 0), (5500, [], 0), (5501, [], 0), (5600, [0.0] * 16, 0)]
    check(spark, rows)
    check(spark, rows, k=3, every=50)


def test_large_numbers_stay_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 2**19 for _ in range(4)], 0) for i in range(200)]
    check(spark, rows)


def test_empty(spark):
    assert topk.top_k(spark.createDataFrame([], SCHEMA)).count() == 0


def test_visits_are_pruned_by_cell_boxes(spark, monkeypatch):
    """Clustered vectors: a block of queries visits few of the shards."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 100)
    monkeypatch.setattr(topk, "QUERY_ROWS", 10)
    rng = random.Random(9)
    axes = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(20)]
    rows = [(i, [a + rng.gauss(0, .05) for a in axes[i % 20]], 0) for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    index, bounded, boxes, plan = topk.prepare(df, 10, 7, "vec_id", "embedding")
    shards, blocks = index.count(), bounded.count()
    made = topk.visits(bounded, boxes, plan)
    assert shards >= 40 and blocks >= 40
    assert made.count() < 0.4 * shards * blocks
    check(spark, rows, every=7)


def test_copies_of_one_vector_or_id_are_dealt_over_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 50)
    rng = random.Random(2)
    rows = [(i, [1.0, 2.0, 3.0], 0) for i in range(400)]
    rows += [(700, [rng.random(), 0.5, 0.25], 0) for _ in range(400)]  # one id
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "2 as dim", "3 as part", "4 as vec")
    index, _, boxes, plan = topk.prepare(df, 3, 100, "vec_id", "embedding")
    sizes = [len(topk._load(r.blob)["ids"]) for r in index.collect()]
    assert sum(sizes) == 800 and max(sizes) < 150
    got = topk.top_k(spark.createDataFrame(rows[:400], SCHEMA), k=3).collect()
    assert {(r.query_id, r["rank"], r.vec_id) for r in got if r.query_id == 0} == {(0, 1, 1), (0, 2, 2), (0, 3, 3)}


def test_driver_and_joins_hold_no_vectors(spark, monkeypatch):
    """No join repeats or broadcasts the index or the queries, whatever the sizes say,
    and the driver gets no sampled vectors."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 100)
    monkeypatch.setattr(topk, "QUERY_ROWS", 20)
    monkeypatch.setattr(topk, "LOT", 8 * 40)  # two blocks meet a shard at once
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], 0) for i in range(1000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got, real = [], type(df).toArrow
    monkeypatch.setattr(type(df), "toArrow",
                        lambda self: (got.append(real(self)), got[-1])[1])
    out = topk.top_k(df, every=10)
    assert got and not any(str(f.type).startswith("list") for t in got for f in t.schema)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "BroadcastExchange" not in plan
    check(spark, rows, every=10)


def test_equal_vectors_are_split_by_id(spark, monkeypatch):
    """Of many copies few are looked at: a leaf of larger ids is not opened."""
    ids = np.random.default_rng(1).permutation(5000)
    tree = topk.opened(topk._pack(**topk.build(ids, np.full((5000, 3), 700.0))))
    assert len(tree["leaves"]) > 8 and (np.sort(ids)[:len(tree["ids"])] == tree["ids"]).all()
    block = {"ids": ids[:4], "vecs": np.full((4, 3), 700.0), "pos": np.arange(4),
             "kth": np.full(4, -np.inf), "kid": np.full(4, topk._LAST)}
    n, score, found = topk.search_block(tree, block, 10)
    for q in range(4):
        assert found[n == q].tolist() == [i for i in range(11) if i != ids[q]][:10]
    assert (score == 3 * 700 ** 2).all()
