import random

import numpy as np
import pytest

from panelforge.llm import recompress, substring


def brute(rows, window):
    first = {}
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = (t or "").encode().split()
        gone = {j for i in range(len(w) - window + 1)
                if d is not None and first[tuple(w[i:i + window])] < d
                for j in range(i, i + window)}
        out.append((d, len(w), len(gone),
                    b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out, key=str)


def corpus(seed, window):
    rng = random.Random(seed)
    vocab = [f"w{i}é" for i in range(40)] + ["a", "b"]
    word = lambda n: [rng.choice(vocab) for _ in range(n)]
    shared = [word(rng.randint(window - 2, 4 * window)) for _ in range(6)]
    shared += [["a"] * (3 * window), ["a", "b"] * (2 * window), word(7) * window]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 5)):
            p = list(rng.choice(shared)) if rng.random() < .6 else word(rng.randint(0, 3 * window))
            if p and rng.random() < .5:
                p[rng.randrange(len(p))] = rng.choice(vocab)
            if rng.random() < .3:
                p = p[rng.randint(0, len(p)):]
            parts += p
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts))
    texts += [None, "", " \n", "x", texts[0], texts[0] + " tail", " ".join(["a"] * 200)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return rows + [rows[0], (rows[1][0], texts[0]), (None, texts[0])]


@pytest.mark.parametrize("window,hot,seed", [(50, 2000, 1), (50, 1, 2), (20, 2, 3)])
def test_against_brute_force(make_docs, window, hot, seed):
    rows = corpus(seed, window)
    got = substring.dedup(make_docs(rows), window, hot=hot).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, window)


def test_long_texts_are_cut_without_loss(monkeypatch):
    texts = [(t or "").encode() for _, t in corpus(5, 20)]
    whole = substring.named_words(texts)
    monkeypatch.setattr(substring, "BYTES", 100)
    cut = substring.named_words(texts)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    monkeypatch.setattr(substring, "WORDS", 70)
    name, _, t, lo, n = substring.block_rows(texts, 20)
    have = sorted((int(x), int(y) + k) for x, y, c in zip(t, lo, n) for k in range(c))
    sizes = whole[1]
    assert sorted(set(have)) == [(i, k) for i in range(len(texts)) for k in range(sizes[i] - 19)]


def test_equal_windows_hang_on_equal_symbols():
    texts = [(t or "").encode() for _, t in corpus(9, 30)]
    names, size = substring.named_words(texts)
    name, ctx, t, lo, n = substring.block_rows(texts, 30)
    start, roll = np.cumsum(size) - size, recompress.Rolling(names)
    seen, same = {}, {}
    for i in range(len(name)):
        h = []
        for k in range(n[i]):
            at = np.array([start[t[i]] + lo[i] + k])
            h.append(int(roll.of(at, at + 30)[0]))
            assert seen.setdefault(h[-1], name[i]) == name[i]
        assert same.setdefault((name[i], ctx[i]), set(h)) == set(h)


def test_empty(no_rows):
    assert substring.dedup(no_rows).count() == 0


def passages(seed, *sizes):
    """Lists of words that are found nowhere else."""
    rng = random.Random(seed)
    return [[f"s{seed}p{i}w{k}x{rng.getrandbits(20)}" for k in range(n)]
            for i, n in enumerate(sizes)]


@pytest.mark.parametrize("hot", [2000, 1])
def test_every_block_of_the_least_document_is_judged(make_docs, hot):
    rows = []
    for seed in range(6):
        a, b, c, d, e, p = passages(seed, 70, 70, 70, 70, 9, 60)
        t = a + p + b
        rows += [(100 * seed + 10, " ".join(t + t)), (100 * seed + 5, " ".join(c + p + d)),
                 (100 * seed + 10, " ".join(e + t)), (100 * seed + 10, " ".join(e + t))]
    got = substring.dedup(make_docs(rows), hot=hot).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 50)


def test_repeated_rows_keep_gaps_between_removed_windows(make_docs):
    rows = []
    for seed in range(6):
        x, a, b, c, d = passages(seed, 52, 60, 60, 60, 60)
        whole = " ".join(a + x + b)
        rows += [(100 * seed + 1, " ".join(c + x[:50] + d)),
                 (100 * seed + 2, " ".join(d + x[2:] + c))] + [(100 * seed + 9, whole)] * 2
    got = substring.dedup(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 50)


def test_repeated_rows_are_fetched_and_cut_once(make_docs, spark, monkeypatch):
    x, a, b, c = passages(1, 60, 60, 60, 60)
    seen, docs = [], make_docs([(1, " ".join(c + x + a))] + [(2, " ".join(a + x + b))] * 40)
    real = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow",
                        lambda self, *args: (seen.append(self), real(self, *args))[1])
    assert substring.dedup(docs).count() == 41
    asked = [d for d in seen if "want" in d.columns]
    cut = [d for d in seen if "spans" in d.columns]
    assert [d.count() - d.select("row").distinct().count() for d in asked] == [0]
    assert [d.where("size(spans) > size(array_distinct(spans))").count() for d in cut] == [0]


def test_unlike_documents_share_few_symbols():
    """Common words stand side by side in many documents; no window hangs on them
    if a longer symbol is decided in it."""
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(300)]
    weight = [1 / (i + 1) for i in range(300)]
    texts = [" ".join(rng.choices(vocab, weight, k=300)).encode() for _ in range(300)]
    name, _, t, _, _ = substring.block_rows(texts, 50)
    docs = {}
    for x, d in zip(name.tolist(), t.tolist()):
        docs.setdefault(x, set()).add(d)
    shared = sum(len(docs[x]) > 1 for x in name.tolist())
    assert shared < 0.25 * len(name)


def test_texts_are_cut_into_blocks_once(make_docs, monkeypatch):
    plans, real = {}, substring.stored

    def noted(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(substring, "stored", noted)
    rows = corpus(6, 50)
    got = substring.dedup(make_docs(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 50)
    assert [n for n in ("blocks", "shared-names", "shared-blocks") if "MapInArrow" in plans[n]] == ["blocks"]
