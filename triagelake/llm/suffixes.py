"""Suffix arrays, longest-previous-factor arrays and an FM-index over integer sequences, in numpy."""

from __future__ import annotations

import numpy as np


def _dense(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    ordered = keys[order]
    step = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    ranks = np.empty(len(keys), dtype=np.int64)
    ranks[order] = step
    return ranks


def suffix_order(seq: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix array, ranks by first 1, 2, 4, ... symbols), by prefix doubling.

    With depth, doubling ends once that many symbols decide; equal suffixes then stand by position.
    """
    n = len(seq)
    order = np.argsort(seq, kind="stable")
    ranks = [_dense(seq, order)]
    width = 1
    while n and ranks[-1][order[-1]] < n - 1 and (depth is None or width < depth):
        now = ranks[-1]
        behind = np.zeros(n, dtype=np.int64)
        behind[: max(0, n - width)] = now[width:] + 1
        keys = now * (n + 1) + behind
        order = np.argsort(keys, kind="stable")
        ranks.append(_dense(keys, order))
        width *= 2
    return order, ranks


def neighbour_lcp(order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
    """Common prefix lengths of neighbours in suffix order (0 for the first), up to what the ranks resolve."""
    n = len(order)
    lcp = np.zeros(n, dtype=np.int64)
    if n < 2:
        return lcp
    a, b = order[:-1].copy(), order[1:].copy()
    got = np.zeros(n - 1, dtype=np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        for _ in range(2 if level == len(ranks) - 1 else 1):
            ok = (a < n) & (b < n)
            same = np.zeros(n - 1, dtype=bool)
            same[ok] = ranks[level][a[ok]] == ranks[level][b[ok]]
            # a rank also matches where both suffixes end inside it; they differ then, as no suffix is another one
            got[same] += 1 << level
            a[same] += 1 << level
            b[same] += 1 << level
    lcp[1:] = got
    return lcp


def _nearest_smaller(values: np.ndarray, lcp_to_left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the nearest smaller value to the left or -1, smallest lcp on the way), by pointer jumping."""
    n = len(values)
    left = np.arange(-1, n - 1)
    low = lcp_to_left.copy()
    open_ = np.flatnonzero(left >= 0)
    open_ = open_[values[left[open_]] > values[open_]]
    while len(open_):
        at = left[open_]
        low[open_] = np.minimum(low[open_], low[at])
        left[open_] = left[at]
        open_ = open_[left[open_] >= 0]
        open_ = open_[values[left[open_]] > values[open_]]
    low[left < 0] = 0
    return left, low


def longest_previous_factor(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """By position: length of the longest factor there that also starts earlier.

    The earlier start is the previous or the next smaller position in suffix order.
    """
    n = len(order)
    out = np.zeros(n, dtype=np.int64)
    if n == 0:
        return out
    _, before = _nearest_smaller(order, lcp)
    to_right = np.concatenate([lcp[1:], [0]])[::-1]
    _, after = _nearest_smaller(order[::-1], to_right)
    out[order] = np.maximum(before, after[::-1])
    return out


class FMIndex:
    """Backward search over a sequence of symbols 0..sigma-1, through a wavelet matrix; positions by sampled suffixes."""

    SAMPLE = 8

    def __init__(self, seq: np.ndarray, sigma: int):
        text = np.concatenate([seq + 1, [0]]).astype(np.int64)  # 0 ends the text
        order, _ = suffix_order(text)
        self.n = len(text)
        bwt = text[order - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=sigma + 1))])
        self.levels = max(1, int(sigma).bit_length())
        self.ranks, self.zeros = [], []
        now = bwt
        for level in range(self.levels - 1, -1, -1):
            bit = (now >> level) & 1
            self.ranks.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(int(self.n - bit.sum()))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        kept = order % self.SAMPLE == 0
        self.marked = kept
        self.sample_rank = np.concatenate([[0], np.cumsum(kept)])
        self.samples = order[kept]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before row `at` of the transform."""
        lo, hi = np.zeros_like(at), at.copy()
        for k, level in enumerate(range(self.levels - 1, -1, -1)):
            bit = ((symbol >> level) & 1).astype(bool)
            ones_lo, ones_hi = self.ranks[k][lo], self.ranks[k][hi]
            lo = np.where(bit, self.zeros[k] + ones_lo, lo - ones_lo)
            hi = np.where(bit, self.zeros[k] + ones_hi, hi - ones_hi)
        return hi - lo

    def symbol(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros_like(at)
        at = at.copy()
        for k in range(self.levels):
            bit = self.ranks[k][at + 1] - self.ranks[k][at]
            ones = self.ranks[k][at]
            at = np.where(bit == 1, self.zeros[k] + ones, at - ones)
            out = out * 2 + bit
        return out

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern numbers that occur, first row, row behind the last) of patterns, one a line."""
        alive = np.arange(len(patterns))
        lo, hi = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.n, dtype=np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[alive, k] + 1
            lo, hi = self.first[c] + self.rank(c, lo), self.first[c] + self.rank(c, hi)
            found = hi > lo
            alive, lo, hi = alive[found], lo[found], hi[found]
        return alive, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of rows: step back through the text until a sampled suffix."""
        out = np.zeros(len(rows), dtype=np.int64)
        open_, now, steps = np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            hit = self.marked[now]
            out[open_[hit]] = self.samples[self.sample_rank[now[hit]]] + steps
            open_, now = open_[~hit], now[~hit]
            c = self.symbol(now)
            now = self.first[c] + self.rank(c, now)
            steps += 1
        return out
