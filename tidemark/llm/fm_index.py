"""A compressed full-text index over word numbers: a wavelet matrix over the Burrows-Wheeler transform.

``FMIndex`` answers matching statistics for many texts at once: for every place of a text, how long
the longest stretch from there is that also stands in the index, and which suffixes start with
it.  The texts are read from their last word to their first, one backward step a word.  When a
step finds nothing, the stretch is shortened to its parent interval until the step succeeds.
All of it is numpy over arrays of texts; the sorted suffixes are kept only to tell where a match lies.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Ranks over a sequence of numbers, one bit vector per binary digit."""

    def __init__(self, sequence: np.ndarray, largest: int):
        self.levels = max(1, int(largest).bit_length())
        self.size = len(sequence)
        self.bits, self.before, self.zeros = [], [], []
        left = sequence
        for level in range(self.levels - 1, -1, -1):
            bit = (left >> level & 1).astype(bool)
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, bool)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            ones = np.bitwise_count(words).astype(np.uint32)
            self.bits.append(words)
            self.before.append(np.cumsum(ones, dtype=np.uint32) - ones)
            self.zeros.append(int(len(bit) - bit.sum()))
            left = np.concatenate([left[~bit], left[bit]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` numbers equal ``symbol``, for arrays of both."""
        start, end = np.zeros(len(symbol), np.int64), at
        for k in range(self.levels):
            one = (symbol >> (self.levels - 1 - k) & 1).astype(bool)
            ends = []
            for place in (start, end):
                word = place >> 6
                inside = np.bitwise_count(self.bits[k][word] & ((np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)))
                ones = self.before[k][word].astype(np.int64) + inside
                ends.append(np.where(one, self.zeros[k] + ones, place - ones))
            start, end = ends
        return end - start


class FMIndex:
    """An index of ``text``, word numbers from 0 on; ``most`` is the longest match of interest."""

    def __init__(self, text: np.ndarray, most: int):
        self.most = most
        text = np.append(np.asarray(text, np.int64) + 1, 0)  # 0 ends the text
        self.largest = int(text.max())
        self.ranks = [_dense(text)]  # of the stretches of 1, 2, 4, ... words
        while True:
            width, rank = 1 << (len(self.ranks) - 1), self.ranks[-1].astype(np.int64)
            if rank.max() == len(text) - 1:
                break
            second = np.zeros(len(text), np.int64)
            if width < len(text):
                second[: len(text) - width] = rank[width:] + 1
            self.ranks.append(_dense(rank * (len(text) + 1) + second))
        self.suffixes = np.empty(len(text), np.int64)
        self.suffixes[self.ranks[-1]] = np.arange(len(text))
        self.transform = WaveletMatrix(text[self.suffixes - 1], self.largest)
        self.first = np.searchsorted(text[self.suffixes], np.arange(self.largest + 2))
        self.shared = self._shared()
        self._borders: dict[int, np.ndarray] = {}

    def _shared(self) -> np.ndarray:
        """How many words neighbouring suffixes share, ``most`` at most; -1 at both ends."""
        a, b = self.suffixes[:-1], self.suffixes[1:]
        shared = np.zeros(len(a), np.int64)
        for k in range(min(len(self.ranks) - 1, self.most.bit_length() - 1), -1, -1):
            rank, last = self.ranks[k], len(self.ranks[k]) - 1
            for _ in range(2 if k == min(len(self.ranks) - 1, self.most.bit_length() - 1) else 1):
                shared += np.where(rank[np.minimum(a + shared, last)] == rank[np.minimum(b + shared, last)], 1 << k, 0)
        return np.r_[-1, np.minimum(shared, self.most), -1]

    def borders(self, length: int) -> np.ndarray:
        """Where suffixes stop to share ``length`` words: the ends of the intervals of such stretches."""
        if length not in self._borders:
            self._borders[length] = np.flatnonzero(self.shared < length)
        return self._borders[length]

    def widened(self, low: np.ndarray, high: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the first ``length`` words of longer stretches."""
        borders = self.borders(length)
        return borders[np.searchsorted(borders, low, "right") - 1], borders[np.searchsorted(borders, high, "left")]

    def step(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the stretches with one word put before them; empty where there is none."""
        symbol = np.clip(word + 1, 0, self.largest)
        low, high = self.first[symbol] + self.transform.rank(symbol, low), self.first[symbol] + self.transform.rank(symbol, high)
        return low, np.where((word >= 0) & (word < self.largest), high, low)

    def matching_statistics(self, words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(length, low, high)`` for every place of the texts ``words[starts[i]:ends[i]]``.

        ``length`` is at most ``most``; the suffixes of rank ``low`` to ``high`` start with the match.
        """
        length, low, high = (np.zeros(len(words), np.int64) for _ in range(3))
        order = np.argsort(starts - ends, kind="stable")  # long texts first, so the open ones are a prefix
        starts, ends = starts[order], ends[order]
        now_length = np.zeros(len(starts), np.int64)
        now_low, now_high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.suffixes))
        sizes = ends - starts
        for back in range(1, int(sizes.max(initial=0)) + 1):
            n = int(np.searchsorted(-sizes, -back, "right"))
            place = ends[:n] - back
            word = words[place]
            a, b, c = now_low[:n].copy(), now_high[:n].copy(), now_length[:n].copy()
            to_a, to_b = self.step(word, a, b)
            stuck = np.flatnonzero(to_a >= to_b)
            while len(stuck):
                # Shorten to the parent interval; nothing is left of the empty stretch.
                ended = c[stuck] == 0
                done = stuck[ended]
                to_a[done], to_b[done], c[done] = 0, len(self.suffixes), -1
                stuck = stuck[~ended]
                c[stuck] = np.minimum(np.maximum(0, np.maximum(self.shared[a[stuck]], self.shared[b[stuck]])), c[stuck] - 1)
                for at in np.unique(c[stuck]).tolist():
                    same = stuck[c[stuck] == at]
                    a[same], b[same] = self.widened(a[same], b[same], at)
                to_a[stuck], to_b[stuck] = self.step(word[stuck], a[stuck], b[stuck])
                stuck = stuck[to_a[stuck] >= to_b[stuck]]
            c += 1
            over = np.flatnonzero(c > self.most)
            if len(over):
                to_a[over], to_b[over] = self.widened(to_a[over], to_b[over], self.most)
                c[over] = self.most
            now_low[:n], now_high[:n], now_length[:n] = to_a, to_b, c
            length[place], low[place], high[place] = c, to_a, to_b
        return length, low, high


def _dense(keys: np.ndarray) -> np.ndarray:
    """Ranks of the keys, equal ones alike, without gaps."""
    order = np.argsort(keys)
    sorted_ = keys[order]
    out = np.empty(len(keys), np.int32)
    out[order] = np.cumsum(np.r_[False, sorted_[1:] != sorted_[:-1]])
    return out
