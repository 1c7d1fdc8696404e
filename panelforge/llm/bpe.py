"""Byte-level BPE by speculation and verification.

Texts are cut into words by the vocabulary's own word pattern; words not met
before are encoded together: a greedy longest match over a trie proposes tokens
at all positions at once, then every adjacent pair is checked for compatibility
(would a merge across their border have come before the merges that made them?),
again for all words at once.  A word is accepted if each of its tokens encodes
itself and each adjacent pair is compatible; only the other words are merged
exactly, all together, one rank a step.

Defined cases: a null text is the empty text and has no tokens; texts of any length
are encoded whole; the strings of
special tokens in a text become those tokens; repeated rows each come out; an
empty table gives no rows; other columns pass through ``encode`` unread.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, same

# Fixed value: the published word pattern of this family of vocabularies.
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"""
           r"""|\s+(?!\S)|\s+""")
#: Words that a task remembers; beyond that it starts afresh.
REMEMBERED = 400_000
#: Texts of one step inside a task.
STEP = 256
NONE = np.iinfo(np.int64).max


def byte_chars() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary:
    itself if it prints, else the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    out.update({b: chr(256 + n) for n, b in
                enumerate(b for b in range(256) if b not in out)})
    return out


class Vocabulary:
    """Tables of a vocabulary file; symbols are numbered by rank (0-255: bytes)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        byte_of = {c: b for b, c in byte_chars().items()}
        ids = spec["model"]["vocab"]
        raw = {t: bytes(byte_of[c] for c in t) for t in ids
               if all(c in byte_of for c in t)}
        merges = [tuple(m.split(" ") if isinstance(m, str) else m)
                  for m in spec["model"]["merges"]]
        symbol = {c: b for c, b in byte_of.items()}
        left, right, pairs = [*range(256)], [*range(256)], []
        text = [bytes([b]) for b in range(256)]
        self.id_of = [ids[c] for c, _ in sorted(byte_of.items(), key=lambda x: x[1])]
        for a, b in merges:
            pairs.append((symbol[a] << 32) | symbol[b])
            symbol.setdefault(a + b, len(left))
            left.append(symbol[a])
            right.append(symbol[b])
            text.append(raw[a + b])
            self.id_of.append(ids[a + b])
        self.id_of = np.array(self.id_of, "<u4")
        self.left, self.right = np.array(left), np.array(right)
        pairs = np.array(pairs, np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pair_keys, self.pair_to = pairs[order], order + 256
        self.bytes_of = {ids[t]: r for t, r in raw.items()}
        self.bytes_of.update({i: t.encode() for t, i in self.special.items()})
        self._trie(text)
        merged = self.merge([t for t in text])
        self.canonical = np.array([len(m) == 1 and m[0] == i for i, m in enumerate(merged)])
        self.known: dict[str, bytes] = {
            t: np.array([i], "<u4").tobytes() for t, i in self.special.items()}
        self.words = regex.compile(PATTERN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") \
            if self.special else None

    def _trie(self, texts: list[bytes]) -> None:
        steps, ends, nodes = {}, {0: -1}, 1
        for sym, t in enumerate(texts):
            at = 0
            for b in t:
                key = at << 8 | b
                if key not in steps:
                    steps[key] = nodes
                    nodes += 1
                at = steps[key]
            ends.setdefault(at, sym)
        keys = np.array(sorted(steps), np.int64)
        self.step_keys, self.step_to = keys, np.array([steps[k] for k in keys.tolist()])
        self.end_symbol = np.full(nodes, -1)
        for n, s in ends.items():
            self.end_symbol[n] = s

    @staticmethod
    def _find(keys: np.ndarray, to: np.ndarray, what: np.ndarray, other: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(keys, what), len(keys) - 1)
        return np.where(keys[at] == what, to[at], other)

    def combined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the symbol that (a, b) merges to, or NONE."""
        return self._find(self.pair_keys, self.pair_to, a.astype(np.int64) << 32 | b, NONE)

    # exact merging ---------------------------------------------------------
    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Symbols of each word by merging, in each word, the lowest rank first."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words])
        sym = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        word = np.repeat(np.arange(len(words)), sizes)
        done_sym, done_word = [], []
        while len(sym):
            rank = np.full(len(sym), NONE)
            inside = word[1:] == word[:-1]
            rank[:-1][inside] = self.combined(sym[:-1][inside], sym[1:][inside])
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, starts)
            per = np.repeat(lowest, np.diff(np.r_[starts, len(sym)]))
            open_ = per != NONE
            if not open_.all():
                done_sym.append(sym[~open_])
                done_word.append(word[~open_])
                sym, word, rank, per = sym[open_], word[open_], rank[open_], per[open_]
                if not len(sym):
                    break
            hit = rank == per
            run = np.flatnonzero(hit & ~np.r_[False, hit[:-1]])  # overlaps: every second
            since = np.arange(len(sym)) - np.repeat(
                np.r_[0, run], np.diff(np.r_[0, run, len(sym)]))
            hit &= since % 2 == 0
            sym = np.where(hit, rank, sym)
            keep = ~np.r_[False, hit[:-1]]
            sym, word = sym[keep], word[keep]
        sym, word = np.concatenate([[], *done_sym]), np.concatenate([[], *done_word])
        order = np.argsort(word, kind="stable")
        ends = np.cumsum(np.bincount(word.astype(int), minlength=len(words)))
        return np.split(sym[order].astype(int), ends[:-1])

    # speculation -----------------------------------------------------------
    def longest(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest matches: (symbols, word of each), in order."""
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        sizes = np.array([len(w) for w in words])
        end = np.repeat(np.cumsum(sizes), sizes)
        best = np.full(len(data), -1)
        length = np.zeros(len(data), int)
        at, node, depth = np.arange(len(data)), np.zeros(len(data), int), 0
        while len(at):
            live = at + depth < end[at]
            at, node = at[live], node[live]
            node = self._find(self.step_keys, self.step_to,
                              node.astype(np.int64) << 8 | data[at + depth], -1)
            at, node = at[node >= 0], node[node >= 0]
            depth += 1
            s = self.end_symbol[node]
            best[at[s >= 0]], length[at[s >= 0]] = s[s >= 0], depth
        cur, last = np.cumsum(sizes) - sizes, np.cumsum(sizes)
        word, out_sym, out_word = np.arange(len(words)), [], []
        while len(cur):
            live = cur < last
            cur, last, word = cur[live], last[live], word[live]
            out_sym.append(best[cur])
            out_word.append(word)
            cur = cur + length[cur]
        sym, of = np.concatenate([[], *out_sym]).astype(int), np.concatenate([[], *out_word]).astype(int)
        order = np.argsort(of, kind="stable")
        return sym[order], of[order]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether a text made of the two symbols is encoded as just them.

        Undo the later of the merges that formed the two symbols at the border,
        again and again; at each stage a merge across the border must not come
        before the merge undone last (to the left of it: nor at its rank).
        """
        ok = np.ones(len(a), bool)
        at, a, b = np.arange(len(a)), a.copy(), b.copy()
        limit = np.full(len(a), NONE)
        while len(at):
            clash = self.combined(a, b) < limit
            ok[at[clash]] = False
            base_a, base_b = a < 256, b < 256
            go = ~clash & ~(base_a & base_b)
            undo_a = ~base_a & ((a > b) | base_b)
            limit = np.where(undo_a, a, b + 1)[go]
            a, b, at = np.where(undo_a, self.right[a], a)[go], \
                np.where(undo_a, b, self.left[b])[go], at[go]
        return ok

    def learn(self, words: list[str]) -> None:
        """Encode ``words`` and remember them."""
        data = [w.encode() for w in words]
        sym, of = self.longest(data)
        good = np.ones(len(words), bool)
        good[of[~self.canonical[sym]]] = False
        inner = np.flatnonzero(of[1:] == of[:-1])
        pair, back = np.unique(sym[inner] << 32 | sym[inner + 1], return_inverse=True)
        fits = self.compatible(pair >> 32, pair & 0xFFFFFFFF)
        good[of[inner[~fits[back]]]] = False
        ids = self.id_of[sym].tobytes()
        ends = (4 * np.cumsum(np.bincount(of, minlength=len(words)))).tolist()
        start = 0
        for w, e, g in zip(words, ends, good.tolist()):
            if g:
                self.known[w] = ids[start:e]
            start = e
        bad = np.flatnonzero(~good).tolist()
        for n, m in zip(bad, self.merge([data[n] for n in bad])):
            self.known[words[n]] = self.id_of[m].tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        cut = []
        for t in texts:
            if self.cut is not None and self.cut.search(t):
                parts = self.cut.split(t)
                cut.append([w for p in parts for w in
                            ([p] if p in self.special else self.words.findall(p))])
            else:
                cut.append(self.words.findall(t))
        new = {w for ws in cut for w in ws if w not in self.known}
        if len(self.known) + len(new) > REMEMBERED:
            keep = {t: self.known[t] for t in self.special}
            self.known.clear()
            self.known.update(keep)
            new = {w for ws in cut for w in ws if w not in self.known}
        if new:
            self.learn(sorted(new))
        get = self.known.__getitem__
        return [b"".join(map(get, ws)) for ws in cut]

    def decode(self, ids: bytes) -> str:
        get = self.bytes_of.__getitem__
        return b"".join(map(get, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One copy a worker process."""
    return Vocabulary(path)


def _mapped(rows: DataFrame, source: str, into: str, kind: pa.DataType, sql: str,
            run, step: int = STEP) -> DataFrame:
    """``rows`` with column ``into`` = run(list of values of ``source``)."""
    names = rows.columns
    at = names.index(source)

    def each(batches):
        for b in batches:
            for s in range(0, b.num_rows, step):
                part = b.slice(s, step)
                got = pa.array(run(part.column(at).to_pylist()), kind)
                yield pa.RecordBatch.from_arrays(
                    [*(c for i, c in enumerate(part.columns) if i != at), got],
                    names=[*(n for i, n in enumerate(names) if i != at), into])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema
              if f.name != source]
    return rows.mapInArrow(each, ", ".join([*fields, f"`{into}` {sql}"]))


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",),
           text_col: str = "text", into: str = "ids") -> DataFrame:
    """Columns ``keep`` and the ids of the text (binary, 4 bytes an id)."""
    (t,) = fresh(docs, "__text")
    rows = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias(t))
    return _mapped(rows, t, into, pa.binary(), "binary",
                   lambda texts: vocabulary(path).encode(texts))


def decode(tokens: DataFrame, path: str, ids_col: str = "ids",
           into: str = "decoded") -> DataFrame:
    """``tokens`` with the text of the ids."""
    (i,) = fresh(tokens, "__ids")
    rows = tokens.select(*same(tokens), F.coalesce(F.col(ids_col), F.lit(b"")).alias(i))
    return _mapped(rows, i, into, pa.string(), "string",
                   lambda ids: [vocabulary(path).decode(x) for x in ids])
