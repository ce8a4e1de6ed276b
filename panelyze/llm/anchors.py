"""Winnowed anchors over sequences of symbols (word hashes, or bytes mapped to random numbers).

Several sequences stand one behind the other in a flat array; ``ends`` closes
each of them.  All functions work on the whole array at once.
"""

from __future__ import annotations

import numpy as np

from panelyze.llm.common import mix64

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POS_BITS = 26
_POWERS: dict[int, np.ndarray] = {}
# Texts of more symbols are worked through in stretches; at least two windows.
STRETCH = 1 << 22


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        steps = np.full(max(n + 1, 1 << 16), base, np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return have[: n + 1]


class Rolling:
    """Hashes of arbitrary stretches of a flat array."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.up = powers(_BASE, n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * powers(_INVERSE, n)[:n], dtype=np.uint64, out=self.sums[1:])

    def every(self, length: int) -> np.ndarray:
        """Hashes of all stretches of one length."""
        n = len(self.sums) - length
        salt = mix64(np.array([length + 1], np.uint64))[0]
        return mix64((self.sums[length:] - self.sums[:n]) * self.up[:n] + salt)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64)
        return mix64((self.sums[end] - self.sums[start]) * self.up[start] + mix64(length + np.uint64(1)))


def window_starts(ends: np.ndarray, window: int) -> np.ndarray:
    """Starts of all windows that lie within one sequence."""
    starts = np.r_[0, ends[:-1]]
    room = np.maximum(ends - starts - window + 1, 0)
    first = np.repeat(starts - np.r_[0, np.cumsum(room)[:-1]], room)
    return first + np.arange(room.sum())


def window_anchors(rolling: Rolling, starts: np.ndarray, window: int, seed: int) -> np.ndarray:
    """Position of the seed with the smallest hash (the first of equals) in each window."""
    if not len(starts):
        return np.empty(0, np.int64)
    n = len(rolling.sums) - 1
    if n >> _POS_BITS:
        raise ValueError("block too long")
    low = np.uint64((1 << _POS_BITS) - 1)
    best = rolling.every(seed)
    best &= ~low
    best |= np.arange(len(best), dtype=np.uint64)
    width, span = window - seed + 1, 1
    while 2 * span <= width:
        best = np.minimum(best[:-span], best[span:]) if len(best) > span else best
        span *= 2
    return (np.minimum(best[starts], best[starts + width - span]) & low).astype(np.int64)


def regions(starts: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index ranges ``(first, last)`` of consecutive windows that share their anchor."""
    if not len(starts):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.flatnonzero(np.r_[True, (starts[1:] != starts[:-1] + 1) | (anchors[1:] != anchors[:-1])])
    return new, np.r_[new[1:], len(starts)] - 1


def region_stretches(parts: list, windows, stretch: int):
    """``(w, doc, begin, first, last)``: the regions of ``parts``, their part, and where it begins in the flat array.

    ``windows(parts)`` gives the windows of some parts.  Parts of more than
    ``stretch`` symbols come one by one and in stretches; each starts with the
    last region of the one before, which the cut may have shortened, so regions
    are those of the whole part.
    """
    if sum(map(len, parts)) <= stretch:
        w = windows(parts)
        first, last = regions(w.starts, w.anchors)
        doc = np.searchsorted(w.ends, w.starts[first], "right")
        yield w, doc, w.begin[doc], first, last
        return
    for d, part in enumerate(parts):
        at, more = 0, True
        while more:
            w, more = windows([part[at : at + stretch]]), at + stretch < len(part)
            first, last = regions(w.starts, w.anchors)
            n = len(first) - more
            yield w, np.full(n, d), np.full(n, -at), first[:n], last[:n]
            at += int(w.starts[first[-1]]) if more else 0


def place_stretches(parts: list, windows, doc: np.ndarray, lo: np.ndarray, reach: int, stretch: int):
    """``(w, begin, places)``: windows that hold the places ``lo`` to ``lo + reach`` of the parts ``doc``."""
    if sum(map(len, parts)) <= stretch:
        w = windows(parts)
        yield w, w.begin[doc], np.arange(len(doc))
        return
    for d, nth in sorted(set(zip(doc.tolist(), (lo // stretch).tolist()))):
        places = np.flatnonzero((doc == d) & (lo // stretch == nth))
        at = nth * stretch
        yield windows([parts[d][at : at + stretch + reach]]), np.full(len(places), -at), places
