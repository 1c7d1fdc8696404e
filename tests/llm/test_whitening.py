import math

import numpy as np
import pytest

from panelforge.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def check(spark, rows, top=16):
    df = spark.createDataFrame(rows, SCHEMA)
    rows = [tuple(r) for r in df.collect()]  # as 32-bit floats
    ok = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v, _ in rows
          if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(x) for _, x in ok]
    dim = max(set(lengths), key=lambda d: (lengths.count(d), d))
    ok = [(i, x) for i, x in ok if len(x) == dim]
    fit = np.array(sorted({x for _, x in ok}))
    n, s = len(fit), [int(y) for y in fit.sum(axis=0)]
    c = (fit * n - np.array(s)) / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(top, int((e > whitening.FLOOR * np.trace(v)).sum()))
    out = whitening.whiten(df, top).collect()
    assert len(out) == k * len(ok)
    by = {}
    for r in out:
        by.setdefault((r.vec_id, r.deviation), []).append(r)
    dev = sorted((i, sum((n * a - b) ** 2 for a, b in zip(x, s))) for i, x in ok if i is not None)
    assert sorted((r.vec_id, r.deviation) for r in out
                  if r.component == 1 and r.vec_id is not None) == dev
    assert {r.n for r in out} == {n} and all(0 <= r.identity_error < 1e-4 for r in out)
    for r in out:
        assert abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-6
    got = {(r.vec_id, r.component): r.whitened for r in out}
    one = {i: x for i, x in ok}
    if len(one) == len(ok):  # ids repeat nowhere
        ids = sorted(one)
        w = np.array([[got[i, j + 1] for j in range(k)] for i in ids])
        want = (np.array([one[i] for i in ids]) - np.array(s) / n) @ u[:, :k] / np.sqrt(e[:k])
        gap = np.abs(np.diff(e))[:k].min() / e[0] if k > 1 else 1
        if gap > 1e-6:
            assert np.allclose(w * np.sign((w * want).sum(axis=0)), want, atol=1e-6)
    return out


@pytest.mark.parametrize("blocks", [(1024, 1024, 16), (32, 5, 2)])
def test_against_numpy(spark, monkeypatch, blocks):
    for name, x in zip(("BLOCK_ROWS", "BLOCK_COLS", "GROUP"), blocks):
        monkeypatch.setattr(whitening, name, x)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(700, 24)) * np.linspace(3, .2, 24)
    check(spark, [(i, [float(y) for y in x], 0) for i, x in enumerate(base)])


def test_edge_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(y) for y in x], None) for i, x in enumerate(rng.normal(size=(300, 6)))]
    rows += [(1000 + i, rows[7][1], 0) for i in range(200)]  # copies count once in the fit
    rows += [(None, rows[3][1], 0), (5, rows[5][1], 0), (900, None, 0), (901, [], 0),
             (902, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (903, [float("nan")] * 6, 0),
             (904, [float("-inf")] * 6, 0), (905, [1.0, 2.0], 0)]
    out = check(spark, rows)
    ids = {r.vec_id for r in out}
    assert 905 not in ids and None in ids and sum(r.vec_id == 5 for r in out) == 12
    check(spark, rows, top=2)


def test_without_variance(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)] * 3, [(1, None, 0)]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).count() == 0
    line = [(i, [float(i), 2.0 * i, 0.0], 0) for i in range(9)]
    assert {r.component for r in check(spark, line)} == {1}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, [i * 1.0, (i * i) % 7 * 1.0], i, "a") for i in range(20)],
                               "vec_id long, embedding array<double>, index long, x string")
    assert whitening.whiten(df).count() == 40


def test_deviation_beyond_64_bits_is_an_error(spark):
    rows = [(i, [(-1.0) ** i * 1e9 * (i + 1), 0.0], 0) for i in range(40)]
    with pytest.raises(Exception):
        whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
