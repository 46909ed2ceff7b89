"""Compressed FM-index of many short strings of numbers (numpy, inside tasks).

The Burrows-Wheeler transform of all strings stands in a level-wise wavelet tree: one bit vector per bit of the alphabet, in
64-bit words with the ones before each word. Backward search extends a pattern to the left by two ranks per level, for all
patterns at once. ``matching_statistics`` streams strings through it from right to left: where a step leaves fewer than
``least`` occurrences, the match is shortened at its right end, to the parent interval by common prefixes.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


def suffix_order(ranks: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a text of ranks whose suffixes all differ; several ranks are joined to one key per round."""
    n = len(ranks)
    bits = int(n).bit_length() + 1
    per = max(2, 62 // bits)
    rank, h = ranks.astype(np.int64), 1
    while True:
        padded = np.append(rank + 1, np.zeros((per - 1) * h, np.int64))
        key = padded[:n].copy()
        for k in range(1, per):
            key <<= bits
            key |= padded[k * h:k * h + n]
        order = np.argsort(key)
        key = key[order]
        new = np.zeros(n, np.int64)
        np.cumsum(key[1:] != key[:-1], out=new[1:])
        if n == 0 or new[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = new
        h *= per


class BitRank:
    """Bits in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        packed = np.packbits(np.append(bits, np.zeros(-n % 64 + 64, bits.dtype)), bitorder="little")
        self.words = packed.view("<u8")
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        w = at >> 6
        return self.before[w] + np.bitwise_count(self.words[w] & ((U(1) << (at & 63).astype(np.uint64)) - U(1)))


class WaveletTree:
    """Rank of any symbol of a sequence of ``n`` numbers below ``size``."""

    def __init__(self, seq: np.ndarray, size: int):
        self.bits = max(1, int(size - 1).bit_length())
        self.below = np.zeros((1 << self.bits) + 1, np.int64)
        np.cumsum(np.bincount(seq, minlength=1 << self.bits), out=self.below[1:])
        self.levels = []
        row = seq
        for k in range(self.bits):
            if k:  # a level holds the sequence in order of the k highest bits
                top = seq >> (self.bits - k)
                row = seq[np.argsort(top.astype(np.uint16) if k <= 16 else top, kind="stable")]
            self.levels.append(BitRank(((row >> (self.bits - 1 - k)) & 1).astype(bool)))

    def rank(self, symbol: np.ndarray, *places: np.ndarray) -> list[np.ndarray]:
        """For each array of places: occurrences of ``symbol`` before them."""
        found = list(places)
        for k, level in enumerate(self.levels):
            shift = self.bits - k
            start = self.below[symbol >> shift << shift]
            left = level.ones(start)
            one = (symbol >> (shift - 1) & 1).astype(bool)
            for i, at in enumerate(found):
                ones = level.ones(start + at) - left
                found[i] = np.where(one, ones, at - ones)
        return found


class FMIndex:
    """Index of strings (``symbols`` from 0, one after the other, ``lengths`` each at least 1) that stand for ``weights`` occurrences.
    Matches are told apart up to ``cap`` symbols."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, weights: np.ndarray, cap: int):
        strings, total = len(lengths), len(symbols)
        self.cap, self.n = cap, total + strings
        size = int(symbols.max()) + 1 if total else 1
        owner = np.repeat(np.arange(strings), lengths)
        text = np.empty(self.n, np.int64)  # ends of strings first in order, each of its own kind
        text[np.arange(total) + owner] = symbols + strings
        text[np.cumsum(lengths) + np.arange(strings)] = np.arange(strings)
        order = suffix_order(text)
        before = text[order - 1] - strings + 1  # 0: an end
        self.tree = WaveletTree(np.maximum(before, 0), size + 1)
        counts = np.bincount(symbols, minlength=size)
        self.first = strings + np.concatenate([[0], np.cumsum(counts)[:-1]])
        whose = np.append(owner, 0)[np.minimum(order - np.searchsorted(np.cumsum(lengths + 1), order, "right"), total)]
        self.weight = np.concatenate([[0], np.cumsum(np.where(text[order] >= strings, weights[whose], 0))])
        self._common(text, order)

    def _common(self, text: np.ndarray, order: np.ndarray):
        """common[i]: symbols that suffix i shares with the one before, up to cap; and what is needed to widen intervals."""
        n, cap = self.n, self.cap
        padded = np.append(text, np.full(cap, -1))
        common = np.zeros(n + 1, np.uint8 if cap < 256 else np.uint16)
        live = np.arange(1, n)
        for k in range(cap):
            live = live[padded[order[live - 1] + k] == padded[order[live] + k]]
            if not len(live):
                break
            common[live] = k + 1
        self.common = common
        edge = np.flatnonzero(common < cap - 1)  # the intervals of matches one shorter than the cap
        block = np.searchsorted(edge, np.arange(n), "right") - 1
        self.block, self.edge = block.astype(np.int32), np.append(edge, n) if edge[-1] != n else edge
        self.least = [common]
        while 2 << (len(self.least) - 1) <= n + 1:
            last, half = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-half], last[half:]))

    def step(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Intervals of the patterns with ``symbol`` put before them."""
        a, b = self.tree.rank(symbol + 1, lo, hi)
        return self.first[symbol] + a, self.first[symbol] + b

    def widened(self, lo: np.ndarray, hi: np.ndarray, depth: np.ndarray):
        """The intervals around [lo, hi) whose suffixes share ``depth`` symbols."""
        lo, hi = np.where(depth > 0, lo, 0), np.where(depth > 0, hi, self.n)
        depth = np.maximum(depth, 1)  # both ends of the order share nothing
        for k in range(len(self.least) - 1, -1, -1):
            low, size = self.least[k], 1 << k
            go = hi + size <= self.n + 1
            go[go] = low[hi[go]] >= depth[go]
            hi[go] += size
            go = lo - size + 1 >= 0
            go[go] = low[lo[go] - size + 1] >= depth[go]
            lo[go] -= size
        return lo, hi

    def matching_statistics(self, symbols: np.ndarray, lengths: np.ndarray, least: int = 2) -> np.ndarray:
        """For each place of the strings, the longest match from there on (up to cap) that occurs ``least`` times or more.
        Symbols that the index doesn't know (any above its own, or negative) match nothing."""
        out = np.zeros(len(symbols), self.common.dtype)
        rank = np.argsort(-lengths, kind="stable")
        lengths, ends = lengths[rank], np.cumsum(lengths)[rank]
        lo, hi, depth = (np.zeros(len(rank), np.int64) for _ in range(3))
        hi[:] = self.n
        for t in range(int(lengths[0]) if len(lengths) else 0):
            k = int(np.searchsorted(-lengths, -t, "left"))  # strings longer than t
            at = ends[:k] - 1 - t
            c = symbols[at]
            l, h, d = lo[:k], hi[:k], depth[:k]
            done = d == self.cap
            block = self.block[l[done]]
            l[done], h[done], d[done] = self.edge[block], self.edge[block + 1], self.cap - 1
            lost = (c < 0) | (c >= len(self.first))
            l[lost], h[lost], d[lost] = 0, self.n, 0
            todo = np.flatnonzero(~lost)
            while len(todo):
                a, b = self.step(c[todo], l[todo], h[todo])
                ok = self.weight[b] - self.weight[a] >= least
                good = todo[ok]
                l[good], h[good] = a[ok], b[ok]
                d[good] += 1
                todo = todo[~ok]
                todo = todo[d[todo] > 0]
                if len(todo):
                    shorter = np.maximum(self.common[l[todo]], self.common[h[todo]]).astype(np.int64)
                    l[todo], h[todo] = self.widened(l[todo], h[todo], shorter)
                    d[todo] = shorter
            out[at] = d
        return out
