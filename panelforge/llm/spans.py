"""Blocks of byte windows by minimisers, and suffix arrays by grouping.

``blocks`` gives neighbouring windows that hang on the same place of the text as
one row; equal windows hang on equal places.  ``suffix_array`` builds a suffix
array in two passes without renaming: suffixes are grouped by their Lyndon
prefix from the greatest group down, then every group's order is emitted.
"""

from __future__ import annotations

from array import array

import numpy as np

from .recompress import _LETTER, _M1, _M2, Rolling, U, _BYTE, mix

#: Bytes of the strings among which a window's place is chosen.
GRAM = 16


def _sliding_least(key: np.ndarray, width: int) -> np.ndarray:
    """Least of ``width`` neighbours, for each first one."""
    out, have = key, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def blocks(data: bytes, size: np.ndarray, window: int):
    """Blocks of the windows of texts that lie joined in ``data``.

    Gives (name, context, text, first window, width, copies, place): the hash of
    the string at the block's place, the hash of all bytes of its windows (and
    where the place is), and ``width`` unlike windows, or one window that is
    found ``copies`` times in a row.
    """
    none = (np.empty(0, U),) * 2 + (np.empty(0, np.int64),) * 5
    gram = min(GRAM, window)
    n, start = len(data), np.cumsum(size) - size
    last = np.repeat(start + size - window, size)  # last window start of a byte's text
    if n < window:
        return none
    roll = Rolling(_LETTER[np.frombuffer(data, np.uint8)], _BYTE)
    at = np.arange(n - gram + 1)
    grams = roll.of(at, at + gram)
    key = (mix(grams ^ _M1) >> U(26) << U(26)) | at.astype(U)
    pick = (_sliding_least(key, window - gram + 1) & U((1 << 26) - 1)).astype(np.int64)
    at = np.flatnonzero(np.arange(len(pick)) <= last[:len(pick)])
    if not len(at):
        return none
    pick = pick[at]
    whole = roll.of(at, at + window)
    next_to = at[1:] == at[:-1] + 1
    equal = next_to & (whole[1:] == whole[:-1])
    of_run = np.r_[False, equal] | np.r_[equal, False]
    new = ~next_to | np.where(of_run[1:] | of_run[:-1], ~equal, pick[1:] != pick[:-1])
    first = np.flatnonzero(np.r_[True, new])
    lo, count, run = at[first], np.diff(np.r_[first, len(at)]), of_run[first]
    place = pick[first]
    context = np.where(run, whole[first], mix(
        roll.of(lo, lo + count - 1 + window) + (place - lo).astype(U) * _M2))
    text = np.searchsorted(start + size, lo, "right")
    return (grams[place], context, text, lo - start[text],
            np.where(run, 1, count), np.where(run, count, 1), place - lo)


def by_value(values: np.ndarray) -> np.ndarray:
    """Stable ascending order of whole numbers >= 0, 16 bits a turn: linear."""
    order, shift = np.arange(len(values)), 0
    top = int(values.max()) if len(values) else 0
    while top >> shift:
        low = (values[order] >> values.dtype.type(shift)).astype(np.uint16)
        order = order[np.argsort(low, kind="stable")]  # radix sort for 16 bits
        shift += 16
    return order


def suffix_array(text) -> list[int]:
    """Start positions of all suffixes in ascending order, in linear steps.

    ``text``: whole numbers >= 0, or characters.
    """
    text = np.asarray([ord(c) for c in text] if isinstance(text, str) else text, np.int64)
    n = len(text)
    order = by_value(text)  # groups by first letter
    first = np.flatnonzero(np.r_[True, np.diff(text[order]) != 0]) if n else order
    place, group, stop = np.empty(n, int), np.empty(n, int), np.zeros(n, int)
    place[order] = np.arange(n)
    group[order] = np.repeat(first, np.diff(np.r_[first, n]))
    stop[first] = np.r_[first[1:], n]
    # flat 32-bit arrays: a list holds ten times as much
    order, place, group, stop = (array("i", x.astype(np.int32).tobytes())
                                 for x in (order, place, group, stop))
    before = array("i", [-2]) * n  # nearest earlier suffix of a smaller group (-2: not known yet)
    high = n
    while high:
        low = group[order[high - 1]]
        parents: dict[int, int] = {}
        for i in order[low:high]:
            todo = [i] if before[i] == -2 else []
            while todo:
                i = todo[-1]
                p = i - 1
                while p >= 0 and group[p] >= low:
                    if before[p] == -2:  # an earlier one of the same group comes first
                        todo.append(p)
                        break
                    p = before[p]
                else:
                    before[i] = p
                    todo.pop()
                    if p >= 0:
                        parents[p] = parents.get(p, 0) + 1
        # the prefix of a parent grows by this group's, once for each member that
        # points to it; the longer it grows, the later it comes in its own group
        most = max(parents.values(), default=0)
        by: list[dict[int, list[int]]] = [{} for _ in range(most)]
        for p, times in parents.items():
            by[most - times].setdefault(group[p], []).append(p)
        for some_of in by:
            for old, some in some_of.items():
                end = stop[old]
                if len(some) == end - old:
                    continue
                new = end - len(some)
                for p in some:
                    end -= 1
                    q, other = place[p], order[end]
                    order[q], place[other] = other, q
                    order[end], place[p] = p, end
                for p in some:
                    group[p] = new
                stop[new], stop[old] = stop[old], new
        high = low
    # a suffix follows in its group's order once the one after its prefix is out
    free, done = array("i", range(n)), bytearray(n)
    for k in range(-1, n):
        j = (order[k] if k >= 0 else n) - 1
        while j >= 0 and not done[j]:
            done[j] = 1
            at = free[group[j]]
            free[group[j]] = at + 1
            order[at] = j
            j = before[j]
    return order.tolist()


def repeated(contexts: list[bytes], place: np.ndarray, width: np.ndarray,
             copies: np.ndarray, group: np.ndarray, window: int, cell: int = 8):
    """Which windows of the contexts are found twice (or in two copies).

    Contexts are cut into cells counted from their place, so equal strings around
    one place are equal cells.  In the suffix array of the cells, suffixes that
    begin with the same whole cells of a window are neighbours; the window's
    bytes before and after them decide.  Gives (context, window) pairs.
    """
    cell = max(1, min(cell, window // 4))
    full = (window - cell) // cell
    data = b"".join(contexts)
    size = np.array([len(c) for c in contexts])
    start = np.cumsum(size) - size
    lead = place % cell  # bytes before the first whole cell
    cells = (size - lead) // cell
    of = np.repeat(np.arange(len(contexts)), cells)
    nth = np.arange(cells.sum()) - np.repeat(np.cumsum(cells) - cells, cells)
    at = start[of] + lead[of] + nth * cell  # where each cell begins
    raw = np.frombuffer(data, np.uint8)
    value = np.zeros(len(at), U)
    for b in range(cell):
        value = value << U(8) | raw[at + b].astype(U)
    # text of the suffix array: a mark (0) after each context's cells
    up = by_value(value)
    rank = np.empty(len(at), np.int64)
    rank[up] = np.cumsum(np.r_[False, np.diff(value[up]) != 0]) if len(at) else 0
    where = np.arange(len(at)) + of
    text = np.zeros(len(at) + len(contexts), np.int64)
    text[where] = rank + 1
    to_cell = np.full(len(text), -1)
    to_cell[where] = np.arange(len(at))
    order = to_cell[np.array(suffix_array(text), np.int64)]
    order = order[order >= 0]
    order = order[nth[order] + full <= cells[of[order]]]  # a window's whole cells
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in range(full):
        same &= value[order[1:] + k] == value[order[:-1] + k]
    bunch = np.cumsum(np.r_[False, ~same]) if len(order) else order
    roll = Rolling(_LETTER[raw], _BYTE)
    out_c, out_w = [], []
    for left in range(1, cell + 1):  # bytes of the window before its whole cells
        begin = at[order] - left
        c = of[order]
        w = begin - start[c]
        ok = np.flatnonzero((w >= 0) & (w < width[c]))
        b, c, w = begin[ok], c[ok], w[ok]
        ends = roll.of(b, b + left) ^ mix(roll.of(b + left + full * cell, b + window) + _M2)
        keys = np.stack([bunch[ok].astype(U), ends, group[c].astype(U)])
        by = np.lexsort(keys)
        keys = keys[:, by]
        eq = (keys[:, 1:] == keys[:, :-1]).all(axis=0)
        twice = np.zeros(len(by), bool)
        if len(by):
            twice[by] = np.r_[False, eq] | np.r_[eq, False]
        hit = twice | (copies[c] > 1)
        out_c.append(c[hit])
        out_w.append(w[hit])
    return np.concatenate(out_c), np.concatenate(out_w)
