"""Windows of fixed length in unit sequences, gathered under anchors.

A unit is a byte or a word, given as a 64-bit value. Every window of ``m``
units has one anchor: the leftmost of the ``k``-grams in it with the smallest
hash. The choice depends on the window's units alone, so equal windows have
equal anchors at equal places. Windows of one document that follow each other
and share their anchor form a *run*; a run is described by its anchor's hash,
the anchor's place, the number of windows and a 128-bit hash of all units the
run covers. Two runs with equal descriptions hold the same windows.

Long documents are worked through in overlapping slices; a run that a slice
border cuts is two runs, which changes no answer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE = 1 << 17
MULTIPLIERS = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64), 7)


class Powers:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""

    def __init__(self, multiplier: int):
        self.multiplier, self.size = multiplier, 0
        self.up = self.down = np.zeros(0, dtype=np.uint64)

    def reserve(self, n: int) -> Powers:
        if n > self.size:
            size = max(n, 1 << 12)
            inverse = pow(self.multiplier, -1, 2**64)
            for name, base in (("up", self.multiplier), ("down", inverse)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
            self.size = size
        return self


_powers = [Powers(m) for m in MULTIPLIERS]


class Rolling:
    """Hash of any range of a value sequence from one pass of prefix sums."""

    def __init__(self, values: np.ndarray, which: int = 0):
        n = len(values)
        p = _powers[which].reserve(n + 1)
        self.down = p.down
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * p.up[:n], out=self.sums[1:])

    def at(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (self.sums[hi] - self.sums[lo]) * self.down[lo]

    def every(self, k: int) -> np.ndarray:
        n = len(self.sums) - k
        return (self.sums[k:] - self.sums[:n]) * self.down[:n]


def slices(lengths: np.ndarray, m: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (document, first unit, end) of about ``SLICE`` units; only a long document is cut."""
    held: list[tuple[int, int, int]] = []
    size = 0
    for d, n in enumerate(lengths.tolist()):
        if n < m:
            continue
        for at in range(0, n - m + 1, SLICE):
            to = min(n, at + SLICE + m - 1)
            if held and size + to - at > SLICE + m:
                yield held
                held, size = [], 0
            held.append((d, at, to))
            size += to - at
    if held:
        yield held


def runs(values: np.ndarray, ends: np.ndarray, m: int, k: int) -> dict[str, np.ndarray]:
    """Runs of the windows in concatenated pieces; ``ends`` are the pieces' ends in ``values``.

    Returns arrays ``piece``, ``lo`` (first window, from the piece's start),
    ``n`` (windows), ``place`` (anchor after ``lo``), ``key`` (anchor hash) and
    ``c1``, ``c2`` (hash of all units of the run).
    """
    w = m - k + 1
    first = Rolling(values, 0)
    grams = mix(first.every(k))
    least = (grams & ~np.uint64((1 << 24) - 1)) | np.arange(len(grams), dtype=np.uint64)
    wide = 1
    while 2 * wide <= w:
        least = np.minimum(least[:-wide], least[wide:])
        wide *= 2
    if wide < w:
        least = np.minimum(least[:len(least) - (w - wide)], least[w - wide:])
    starts = np.r_[0, ends[:-1]]
    count = ends - starts - m + 1  # windows of each piece, all positive
    new = np.empty(len(least), dtype=bool)
    new[0] = True
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[starts] = True
    # windows over a piece's end are not windows: close the last run there
    stop = np.zeros(len(least) + 1, dtype=bool)
    stop[starts + count] = True
    cut = np.flatnonzero(new | stop[:-1])
    until = np.r_[cut[1:], len(least)]
    piece = np.searchsorted(ends, cut, side="right")
    real = cut < (starts + count)[piece]
    lo, hi, piece = cut[real], until[real], piece[real]
    place = (least[lo] & np.uint64((1 << 24) - 1)).astype(np.int64)
    return {"piece": piece, "lo": lo - starts[piece], "n": hi - lo, "place": place - lo, "key": grams[place],
            "c1": first.at(lo, hi - 1 + m), "c2": Rolling(values, 1).at(lo, hi - 1 + m)}
