"""Normalised Indel similarity: 100 * 2 * LCS / (len a + len b)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def lcs_length(a: str, b: str) -> int:
    """Bit-parallel longest common subsequence on Python integers."""
    if len(a) < len(b):
        a, b = b, a
    at: dict[str, int] = {}
    for i, ch in enumerate(b):
        at[ch] = at.get(ch, 0) | (1 << i)
    full = (1 << len(b)) - 1
    state = full
    for ch in a:
        u = state & at.get(ch, 0)
        state = ((state + u) | (state - u)) & full
    return len(b) - state.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if not total else 200.0 * lcs_length(a, b) / total


def indel_ratio(a: Column, b: Column) -> Column:
    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else ratio(p, q) for p, q in zip(x, y, strict=True)], dtype="float64")

    return F.pandas_udf(run, "double")(a, b)


class _Strip:
    """Keys side by side: their bigrams as numbers, each with its key and its place there."""

    def __init__(self, keys: list[str]):
        self.keys = keys
        self.lengths = np.array([len(k) for k in keys], dtype=np.int64)
        codes = np.frombuffer("".join(keys).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(keys)), self.lengths)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.wide = int(self.lengths.max()) // 8 + 1  # bytes of a key's bits, whose topmost bit is never in use
        self.chars = {int(c): i for i, c in enumerate(np.unique(codes))}
        self.bits = np.zeros((len(self.chars), len(keys), self.wide), dtype=np.uint8)
        np.add.at(self.bits, (np.searchsorted(np.unique(codes), codes), owner, place >> 3), (1 << (place & 7)).astype(np.uint8))
        self.full = np.bitwise_or.reduce(self.bits, axis=0)
        inner = place < self.lengths[owner] - 1
        self.grams = ((codes << 21) | np.append(codes[1:], 0))[inner]
        self.owner, self.place = owner[inner], place[inner]
        self.starts = np.append(0, np.cumsum(np.maximum(self.lengths - 1, 0)))

    def lcs(self, key: str, which: np.ndarray) -> np.ndarray:
        """lcs_length of `key` and each of the keys `which`. Their bits lie in one number, each key's under a bit that
        stays zero and takes its carry, so one step of Python's serves them all."""
        some, as_int = np.take(self.bits, which, axis=1), int.from_bytes
        at = {ch: as_int(some[self.chars[ord(ch)]].tobytes(), "little") for ch in set(key) if ord(ch) in self.chars}
        state = full = as_int(self.full[which].tobytes(), "little")
        for ch in key:
            if ch in at:
                u = state & at[ch]
                state = ((state + u) | (state ^ u)) & full
        left = np.frombuffer(state.to_bytes(len(which) * self.wide, "little"), dtype=np.uint8).reshape(len(which), -1)
        return self.lengths[which] - np.unpackbits(left, axis=1).sum(axis=1, dtype=np.int64)


def _strips(keys: list[str], rows: int = 512, chars: int = 1 << 17) -> Iterator[tuple[int, list[str]]]:
    """Runs of `keys`, each with the number of its first key and within both bounds, or of one key."""
    lo = held = 0
    for i, key in enumerate(keys):
        if i > lo and (i - lo >= rows or held + len(key) > chars):
            yield lo, keys[lo:i]
            lo, held = i, 0
        held += len(key)
    if keys:
        yield lo, keys[lo:]


def _between(a: _Strip, b: _Strip, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """A key of `a` and those of `b` that may have a ratio over `threshold` with it.

    With S characters of both, of which L match, there are S - 2 L insertions and deletions, so the matches lie in at
    most S - 2 L + 1 runs and hold 3 L - S - 1 bigrams or more. A match is shifted from half the difference in length by
    at most half the number of insertions and deletions, so each of these bigrams lies in the other key near its place.
    """
    t = threshold / 100
    shift_lo = math.floor(t / 2 * b.lengths.min() - (1 - t / 2) * a.lengths.max())
    shift_hi = math.ceil((1 - t / 2) * b.lengths.max() - t / 2 * a.lengths.min())
    wide = max(8, int(a.lengths.max()) // 16)  # places of a key of `a` are taken together by so many
    known = np.unique(a.grams)
    cells, row = np.unique(a.place // wide * len(known) + np.searchsorted(known, a.grams), return_inverse=True)
    bins = int(a.lengths.max()) // wide + 1
    table = np.full(bins * len(known), -1, dtype=np.int64)
    table[cells] = np.arange(len(cells))
    met = np.zeros((len(cells), len(b.keys)), dtype=np.uint8)
    if len(known):
        gram = np.minimum(np.searchsorted(known, b.grams), len(known) - 1)
        there = known[gram] == b.grams
        gram, owner, place = gram[there], b.owner[there], b.place[there]
        first, last = np.maximum(-((shift_hi + wide - 1 - place) // wide), 0), np.minimum((place - shift_lo) // wide, bins - 1)
        while len(first):
            on = first <= last
            gram, owner, first, last = gram[on], owner[on], first[on], last[on]
            at = table[first * len(known) + gram]
            met[at[at >= 0], owner[at >= 0]] = 1
            first = first + 1
    for i, length in enumerate(a.lengths):
        total = length + b.lengths
        least = 1.5 * t * total - total - 1 - 1e-6
        rows, shared = row[a.starts[i] : a.starts[i + 1]], np.zeros(len(b.keys), dtype=np.int64)
        for lo in range(0, len(rows), 255):
            shared += np.add.reduce(met[rows[lo : lo + 255]], axis=0, dtype=np.uint8)
        yield i, np.flatnonzero((shared > least) & (np.abs(length - b.lengths) < (1 - t) * total + 1e-6))


def alike(left: list[str], right: list[str] | None = None, threshold: float = 85.0) -> Iterator[tuple[int, int]]:
    """Numbers of the keys of `left` and `right`, or of two of `left`, with a ratio over `threshold`; each pair once.

    Keys are not empty. Memory is bounded by the strips of one side and two strips' bits.
    """

    def cut(keys: list[str]) -> tuple[list[int], list[tuple[int, list[str]]]]:
        order = sorted(range(len(keys)), key=lambda n: len(keys[n]))
        return order, list(_strips([keys[n] for n in order]))

    t = threshold / 100
    order, strips = cut(left)
    other, others = (order, strips) if right is None else cut(right)
    for x, some in strips:
        a = _Strip(some)
        for y, more in others:
            shorter, longer = (some, more) if len(some[-1]) < len(more[-1]) else (more, some)
            if (right is None and y < x) or len(shorter[-1]) < t / (2 - t) * len(longer[0]) - 1e-6:
                continue
            b = a if right is None and y == x else _Strip(more)
            for i, near in _between(a, b, threshold):
                near = near[near > i] if b is a else near
                if len(near):
                    alike = 200.0 * b.lcs(a.keys[i], near) > threshold * (a.lengths[i] + b.lengths[near])
                    for j in near[alike]:
                        yield order[x + i], other[y + int(j)]
