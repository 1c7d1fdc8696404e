import random

import numpy as np
import pytest

from panelforge.llm import spans, suffixes


def brute(rows, window):
    count = {}
    texts = [(d, (t or "").encode()) for d, t in rows]
    for _, t in texts:
        for i in range(len(t) - window + 1):
            count[t[i:i + window]] = count.get(t[i:i + window], 0) + 1
    out = []
    for d, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if count[t[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((str(d), len(t), bytes(x for x, g in zip(t, gone) if not g), runs))
    return sorted(out)


def corpus(seed, window):
    rng = random.Random(seed)
    letters = "abcdé \n"
    rand = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [rand(rng.randint(window - 5, 3 * window)) for _ in range(6)]
    shared += ["a" * (3 * window), "ab" * window, rand(9) * window, "Retied. " * window]
    texts = []
    for _ in range(50):
        parts = ""
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(shared) if rng.random() < .6 else rand(rng.randint(0, 2 * window))
            if p and rng.random() < .5:
                k = rng.randrange(len(p))
                p = p[:k] + rng.choice(letters) + p[k + 1:]
            if rng.random() < .3:
                p = p[rng.randint(0, len(p)):]
            parts += p
        texts.append(parts)
    texts += [None, "", "x", texts[0], texts[0] + "tail", "a" * window, "日本" * window]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [rows[0], (rows[1][0], texts[0]), (None, texts[2])]


@pytest.mark.parametrize("window,hot,seed", [(200, 2000, 1), (200, 1, 2), (24, 2, 3)])
def test_against_brute_force(make_docs, window, hot, seed, monkeypatch):
    monkeypatch.setattr(suffixes, "ARRAY", 3000)
    rows = corpus(seed, window)
    got = suffixes.dedup(make_docs(rows), window, hot=hot).collect()
    assert sorted((str(r.doc_id), r.n_bytes, bytes(r.kept), len(r.spans)) for r in got) \
        == brute(rows, window)


def test_long_texts_are_cut_without_loss(monkeypatch):
    texts = [(t or "").encode() for _, t in corpus(5, 40)]
    monkeypatch.setattr(suffixes, "BYTES", 90)
    _, _, t, lo, w, c, _ = suffixes.block_rows(texts, 40)
    have = sorted((int(x), int(y) + k) for x, y, u, v in zip(t, lo, w, c) for k in range(u + v - 1))
    assert have == [(i, k) for i, x in enumerate(texts) for k in range(len(x) - 39)]


def test_suffix_arrays():
    rng = random.Random(4)
    for _ in range(1500):
        t = [rng.randint(0, rng.choice([1, 3, 9])) for _ in range(rng.randint(0, 50))]
        assert spans.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])
    assert spans.suffix_array("a" * 500) == list(range(499, -1, -1))


def test_runs_of_kept_bytes():
    kept, runs = suffixes.kept_bytes(b"0123456789", np.array([6, 0, 1]), np.array([1, 1, 2]), 2)
    assert (kept, runs) == (b"4589", [(0, 4), (6, 8)])


def test_empty(no_rows):
    assert suffixes.dedup(no_rows).count() == 0


def test_repeated_rows_are_fetched_and_cut_once(make_docs, monkeypatch):
    rng = random.Random(3)
    a, b, c, x = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (300, 300, 300, 500))
    rows = [(1, c + x + a)] + [(2, a + x + b)] * 40 + [(None, b + x + c)] * 40
    seen, docs = [], make_docs(rows)
    real = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow",
                        lambda self, *args: (seen.append(self), real(self, *args))[1])
    got = suffixes.dedup(docs).collect()
    assert sorted((str(r.doc_id), r.n_bytes, bytes(r.kept), len(r.spans)) for r in got) \
        == brute(rows, 200)
    assert suffixes.cut(docs).count() == 81
    asked = [d for d in seen if "want" in d.columns]
    runs = [d.columns[-1] for d in seen if d.columns[-1] in ("runs", "c5")]
    cut = [d.select(d[d.columns[-1]].alias("r")) for d in seen if d.columns[-1] in ("runs", "c5")]
    assert len(runs) == 2
    assert [d.count() - d.select("row").distinct().count() for d in asked] == [0, 0]
    assert [d.where("size(r) > size(array_distinct(r))").count() for d in cut] == [0, 0]
