"""Suffix sorting by ranks of doubling depth, with the common prefixes of neighbours."""

from __future__ import annotations

import numpy as np


def suffix_ranks(s: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of the bytes ``s`` in order of their first ``depth`` bytes, and the rank of each place.

    Two places have the same rank if and only if their suffixes agree in the first ``depth`` bytes and
    both have that many; ranks rise in the order.  With a mask ``wanted`` this holds among its places.

    The ranks by a number of bytes, each with the rank of the place as many bytes on, give those by
    twice that number.  Only suffixes still tied are sorted again, so a long repeat costs a few rounds
    of sorting numbers and not a comparison byte by byte.
    """
    n = len(s)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # As many first bytes as fit a number with their place; 0 stands past the end, below every byte.
    used = np.bincount(s, minlength=256) > 0
    codes, width, bits = np.cumsum(used), int(used.sum()).bit_length(), (n + 1).bit_length()
    done = min((63 - bits) // width, depth)
    padded = np.r_[codes[s], np.zeros(done, np.int64)]
    key = padded[:n].copy()
    for k in range(1, done):
        key = key << width | padded[k : k + n]
    packed = np.sort(key << bits | np.arange(n))
    order = packed & (1 << bits) - 1
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    tied = _ranked(rank, order, np.arange(n), packed >> bits)
    while done < depth and len(tied):
        step = min(done, depth - done)
        places = order[tied]
        if wanted is not None and done + step == depth:
            tied = tied[wanted[places]]
            places = order[tied]
        key = rank[places] << bits | rank[np.minimum(places + step, n)] + 1
        if 3 * bits <= 63:
            packed = np.sort(key << bits | places)
            places, key = packed & (1 << bits) - 1, packed >> bits
        else:
            sort = np.argsort(key)
            places, key = places[sort], key[sort]
        order[tied] = places
        tied = tied[_ranked(rank, places, tied, key)]
        done += step
    return order, rank[:n]


def _ranked(rank: np.ndarray, places: np.ndarray, at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Ranks ``places``, sorted by ``key``, by where the first of equal keys is; returns which are tied."""
    new = np.ones(len(key) + 1, bool)
    np.not_equal(key[1:], key[:-1], out=new[1:-1])
    first = np.flatnonzero(new)
    rank[places] = np.repeat(at[first[:-1]], np.diff(first))
    return np.flatnonzero(~(new[:-1] & new[1:]))


def suffix_order(s: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of the bytes ``s`` in order, correct for their first ``depth`` bytes at least."""
    return suffix_ranks(s, depth)[0]


def common_prefixes(s: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each suffix in ``order`` with the next one, up to ``most``.

    Every suffix in ``order`` must have ``most`` bytes.
    """
    a, b = order[:-1], order[1:]
    out = np.zeros(len(a), np.int64)
    words = np.zeros(len(s) + 8, np.uint64)
    padded = np.r_[s, np.zeros(16, np.uint8)]
    for k in range(8):
        words |= padded[k : k + len(words)].astype(np.uint64) << np.uint64(56 - 8 * k)
    going = np.arange(len(a))
    at = 0
    while at + 8 <= most and len(going):
        going = going[words[a[going] + at] == words[b[going] + at]]
        at += 8
        out[going] = at
    if len(a):
        # The bytes left over when a word differs, or when fewer than a word remain.
        left = np.arange(len(a))
        for _ in range(7):
            left = left[out[left] < most]
            left = left[padded[a[left] + out[left]] == padded[b[left] + out[left]]]
            out[left] += 1
    return out
