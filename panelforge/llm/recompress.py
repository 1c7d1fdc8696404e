"""Recompression of token sequences with global names (numpy kernel).

A round first names maximal runs of one symbol, then parts the symbols into left
and right ones by a bit of their name and names every pair of a left and a right
symbol.  Names are hashes of what they stand for, so every task gives equal
substrings equal names without a dictionary.  With each symbol goes the stretch
of tokens that decided it: inside any longer equal stretch, in whatever document,
the same symbol is found at the same place.
"""

from __future__ import annotations

import numpy as np

ROUNDS = 3
#: Symbols of so many words or more are alike to ``anchors`` (four bits of its key).
LONGEST = 15
U = np.uint64
# Odd multipliers of a 64-bit finaliser and of the polynomials.
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
_BYTE, _WORD = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


_LETTER = mix(np.arange(1, 257, dtype=U) * U(_BYTE))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, U)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _POWERS[base] = tuple(both)
    up, down = _POWERS[base]
    return up[:n], down[:n]


class Rolling:
    """Hashes of any stretch of ``values``."""

    def __init__(self, values: np.ndarray, base: int = _WORD):
        up, self.down = _powers(base, len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start]
                   + U(_M1) * (end - start).astype(U))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """(start, end, text number) of every word and the joined texts."""
    data = b"\n".join(texts) + b"\n"
    space = np.concatenate([[True], _SPACE[np.frombuffer(data, np.uint8)]])
    edge = np.flatnonzero(space[1:] != space[:-1])
    start, end = edge[0::2], edge[1::2]
    first = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    return start, end, np.searchsorted(first, start, "right") - 1, data


def word_names(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return Rolling(_LETTER[np.frombuffer(data, np.uint8)], _BYTE).of(start, end)


class Symbols:
    """Symbols with their names, extents and deciding stretches, in tokens."""

    def __init__(self, names: np.ndarray, text: np.ndarray):
        at = np.arange(len(names))
        self.name, self.text = names, text
        self.begin, self.end = at, at + 1
        self.lo, self.hi = at, at + 1

    def _next_is_mine(self) -> np.ndarray:
        return self.text[1:] == self.text[:-1]

    def runs(self) -> None:
        if not len(self.name):
            return
        same = (self.name[1:] == self.name[:-1]) & self._next_is_mine()
        u = np.flatnonzero(np.r_[True, ~same])
        v = np.r_[u[1:], len(self.name)] - 1
        # a run is known by the symbols beside it; beyond a text nothing is known
        # (stretches begin and end in the order of their symbols)
        before, after = np.maximum(u - 1, 0), np.minimum(v + 1, len(self.name) - 1)
        lo = np.where((u > 0) & (self.text[before] == self.text[u]),
                      self.lo[before], np.minimum(self.lo[u], self.begin[u] - 1))
        hi = np.where((v + 1 < len(self.name)) & (self.text[after] == self.text[u]),
                      self.hi[after], np.maximum(self.hi[v], self.end[v] + 1))
        self.lo, self.hi = lo, hi
        k = (v - u + 1).astype(U)
        self.name = np.where(k > U(1), mix(self.name[u] + k * _M2), self.name[u])
        self.text, self.begin, self.end = self.text[u], self.begin[u], self.end[v]

    def pairs(self, turn: int) -> None:
        n = len(self.name)
        if n < 2:
            return
        right = (mix(self.name + U((turn + 1) * _WORD & (1 << 64) - 1)) & U(1)).astype(bool)
        mine = self._next_is_mine()
        joins = np.zeros(n, bool)
        np.logical_and(~right[:-1] & right[1:], mine, out=joins[:-1])
        joined = np.zeros(n, bool)
        joined[1:] = joins[:-1]
        keep = np.flatnonzero(~joined)
        right, joins = right[keep], joins[keep]
        # a single left symbol is decided by the next one, a right one by the last
        # (stretches begin and end in the order of their symbols)
        lo = np.minimum(self.lo, self.begin - 1)
        lo[1:][mine] = self.lo[:-1][mine]
        hi = np.maximum(self.hi, self.end + 1)
        hi[:-1][mine] = self.hi[1:][mine]
        self.lo = np.where(right, lo[keep], self.lo[keep])
        self.hi = np.where(right, self.hi[keep], hi[keep])
        left = keep[joins]
        name, end = self.name[keep], self.end[keep]
        name[joins] = mix(self.name[left] * _M1 + self.name[left + 1] * U(_BYTE))
        end[joins] = self.end[left + 1]
        self.name, self.end = name, end
        self.text, self.begin = self.text[keep], self.begin[keep]


def recompress(names: np.ndarray, text: np.ndarray, rounds: int = ROUNDS) -> Symbols:
    s = Symbols(names, text)
    for turn in range(rounds):
        s.runs()
        s.pairs(turn)
    return s


def anchors(s: Symbols, first: np.ndarray, last: np.ndarray, n: int,
            window: int) -> np.ndarray:
    """For every window start the symbol of most words, and of those the one with
    the least key, among those decided inside the window (the leftmost of equals),
    or -1.

    ``first``/``last``: first and last window start of each symbol's text.
    """
    l, r = np.maximum(s.hi - window, first), np.minimum(s.lo, last)
    ok = np.flatnonzero(l <= r)
    l, r = l[ok], r[ok]
    # longer symbols first: the more words one stands for, the fewer unlike
    # documents share it by chance, however many there are
    words = np.minimum((s.end - s.begin)[ok], LONGEST).astype(U)
    key = (mix(s.name[ok] ^ _M1) >> U(30)) + ((U(LONGEST) - words) << U(34))
    key = key << U(25) | ok.astype(U)
    none = ~U(0)
    width = (r - l + 1)
    level = np.log2(width).astype(int)
    top = int(level.max(initial=0))
    table = None
    for k in range(top, -1, -1):
        here = np.full(n, none)
        if table is not None:  # halves of the level above
            half = 1 << k
            here = np.minimum(here, table)
            here[half:] = np.minimum(here[half:], table[:n - half])
        on = level == k
        np.minimum.at(here, l[on], key[on])
        np.minimum.at(here, r[on] - (1 << k) + 1, key[on])
        table = here
    return np.where(table == none, -1, (table & U((1 << 25) - 1)).astype(np.int64))


def blocks(names: np.ndarray, text: np.ndarray, window: int, rounds: int = ROUNDS):
    """Windows of the texts, neighbours with one anchor together.

    Gives (name, context, text, first window, windows): the anchor's name, the
    hash of all tokens of the block's windows with the anchor's place in them.  A
    window without an anchor (it lies in a long repetition) is named by its tokens
    and makes a block with its equal neighbours.
    """
    n = len(names)
    size = np.bincount(text, minlength=text.max(initial=-1) + 1)
    start = np.cumsum(size) - size
    s = recompress(names, text, rounds)
    last = start + size - window
    pick = anchors(s, start[s.text], last[s.text], n, window)
    at = np.arange(n)
    inside = at <= last[text]
    at, pick = at[inside], pick[inside]
    if not len(at):
        return (np.empty(0, U),) * 2 + (np.empty(0, np.int64),) * 3
    roll = Rolling(names)
    own = roll.of(at, at + window)
    new = np.r_[True, (pick[1:] != pick[:-1]) | (text[at[1:]] != text[at[:-1]])
                | ((pick[1:] < 0) & (own[1:] != own[:-1]))]
    first = np.flatnonzero(new)
    lo, count = at[first], np.diff(np.r_[first, len(at)])
    sym, own = pick[first], own[first]
    whole = roll.of(lo, lo + count - 1 + window)
    place = np.where(sym >= 0, s.begin[sym] - lo, 0).astype(U)
    context = np.where(sym >= 0, mix(whole + place * _M2), own)
    name = np.where(sym >= 0, s.name[sym], own)
    return name, context, text[lo], lo - start[text[lo]], count
