import random
import re
from itertools import permutations

from panelforge.llm import audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    low = {}
    for i, t, _ in docs:
        if i is not None:
            low[t or ""] = min(i, low.get(t or "", i))
    out = {}
    for i, t, s in docs:
        t = t or ""
        w = WORD.findall(t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": t in low and (i is None or i > low[t])}
        for o in map("".join, permutations("ABCDE")):
            gone = False
            for k, x in enumerate(o):
                r = out.setdefault((s or "", o, k + 1), [0] * 6)
                hit = fails[x] and not gone
                r[2] += fails[x] and gone
                r[1] += hit
                r[3] += fails[x] and sum(fails.values()) == 1
                r[4] += hit and i in good
                r[5] += hit and i in toxic
                gone |= hit
                r[0] += not gone
    total = {}
    for (s, o, k), r in out.items():
        total[s, o[k - 1]] = total.get((s, o[k - 1]), 0) + r[1]
    return {(s, o, k, *map(int, r), total[s, o[k - 1]]) for (s, o, k), r in out.items()}


def check(spark, docs, labels):
    df = spark.createDataFrame([(i, t, s, None) for i, t, s in docs],
                               "doc_id long, text string, source string, mask string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = [tuple(r) for r in audit.audit(df, lab).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == brute(docs, labels)
    return rows


def test_against_brute_force(spark):
    rng = random.Random(1)
    words = ["alpha", "Beta", "gamma", "DELTA", "x#y", "a|b", "plain", "more"]
    docs = []
    for i in range(150):
        kind = words[:2] + [f"w{j}" for j in range(rng.choice([1, 60]))] \
            if rng.random() < .5 else words[rng.randint(0, 4):]
        text = " ".join(rng.choice(kind) for _ in range(rng.choice([3, 49, 50, 70])))
        docs.append((i, text, rng.choice(["s", "t", None, ""])))
    docs += [(200 + k, docs[k % 5][1], "t") for k in range(30)]
    docs += [(300, None, "u"), (301, "", "u"), (None, docs[0][1], "s"), (None, "lone", "s"),
             (None, "lone", "s"), (400, "twice", "s"), (400, "twice", "t"), (401, "twice", "s"),
             (500, "é " * 50, "v"), (501, "long " * 60_000, "v")]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 520, 2)] + [(3, 1, None), (3, 0, 1),
                                                                      (None, 1, 1), (9999, 1, 1)]
    rows = check(spark, docs, labels)
    assert len(rows) == 600 * 5  # s, t, u, v and the empty part
    assert any(r[6] for r in rows) and any(r[5] for r in rows)


def test_empty_tables(spark, no_rows):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(no_rows, lab).count() == 0
    check(spark, [(1, "a", "s"), (2, "a", "s")], [])


def test_cells_are_few(spark):
    """A hot text reaches a window as one row per part."""
    docs = spark.createDataFrame([(i, "hot text", f"s{i % 3}") for i in range(600)],
                                 "doc_id long, text string, source string")
    lab = spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int")
    cells = {(r.part, r["mask"]): (r.n, r.good) for r in audit.cells(docs, lab).collect() if r.n}
    assert cells == {("s0", 1): (1, 1), ("s0", 17): (199, 0), ("s1", 17): (200, 0), ("s2", 17): (200, 0)}
