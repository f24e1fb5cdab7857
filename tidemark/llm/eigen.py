"""Eigenvalues and eigenvectors of an integer symmetric matrix from its exact characteristic polynomial.

The polynomial is computed modulo many primes (``polynomial_mod``, one independent piece of work per
prime) and put together by the Chinese remainder theorem.  All its roots are real, so the sign
changes of its coefficients after a shift count the roots above a place exactly, repeated ones
included; bisection on that count isolates every root.  A single root is then
narrowed by the sign of the polynomial.  The null space of the matrix less the root is found by
inverse iteration in fixed-point numbers long enough for neighbouring roots.
"""

from __future__ import annotations

from math import comb, isqrt

import numpy as np

_TOP = 1 << 31  # primes lie below, so products of two residues fit 64 bits


def _is_prime(n: int) -> bool:
    d, r = n - 1, 0
    while d % 2 == 0:
        d, r = d // 2, r + 1
    for a in (2, 3, 5, 7):  # enough for all n below 3.2e9
        x = pow(a, d, n)
        if x in (1, n - 1):
            continue
        for _ in range(r - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_for(matrix: list[list[int]]) -> list[int]:
    """Primes whose product exceeds twice any coefficient of the characteristic polynomial.

    The eigenvalues are not negative, so the k-th coefficient is at most C(d, k) (trace / d)^k.
    """
    d = len(matrix)
    trace = sum(matrix[i][i] for i in range(d))
    bound = 2 * max(comb(d, k) * (-(-trace // d)) ** k for k in range(d + 1)) + 1
    out, product, n = [], 1, _TOP - 1
    while product <= bound:
        if _is_prime(n):
            out.append(n)
            product *= n
        n -= 2
    return out


def polynomial_mod(matrix: list[list[int]], p: int) -> list[int]:
    """Coefficients, constant first, of det(xI - matrix) modulo ``p``, by reduction to Hessenberg form."""
    h = np.array([[x % p for x in row] for row in matrix], np.int64)
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + below[0]
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        u = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * u % p).sum(axis=1)) % p
    rows = np.zeros((d + 1, d + 1), np.int64)  # polynomials of the leading blocks
    rows[0, 0] = 1
    for k in range(d):
        new = np.roll(rows[k], 1)
        new = (new - h[k, k] * rows[k]) % p
        step, weights = 1, np.zeros(k, np.int64)
        for i in range(k - 1, -1, -1):
            step = step * int(h[i + 1, i]) % p
            weights[i] = int(h[i, k]) * step % p
        new = (new - (weights[:, None] * rows[:k] % p).sum(axis=0)) % p
        rows[k + 1] = new
    return rows[d].tolist()


def combine(residues: dict[int, list[int]]) -> list[int]:
    """The integer coefficients of least size with these residues per prime."""
    product = 1
    for p in residues:
        product *= p
    parts = [(product // p) * pow(product // p % p, -1, p) for p in residues]
    out = []
    for coefficient in zip(*residues.values()):
        x = sum(r * part for r, part in zip(coefficient, parts)) % product
        out.append(x - product if 2 * x > product else x)
    return out


def _sign_changes(coefficients: list[int]) -> int:
    signs = [c > 0 for c in coefficients if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def roots_above(polynomial: list[int], at: int) -> int:
    """How many roots, repeated ones counted as often, lie above ``at``; all roots must be real."""
    c = list(polynomial)
    for i in range(len(c) - 1):  # the coefficients of p(x + at)
        for j in range(len(c) - 2, i - 1, -1):
            c[j] += at * c[j + 1]
    return _sign_changes(c)


def _value_sign(polynomial: list[int], at: int) -> int:
    total = 0
    for c in reversed(polynomial):
        total = total * at + c
    return (total > 0) - (total < 0)


def largest_roots(polynomial: list[int], most: int, bits: int = 96) -> list[tuple[int, int]]:
    """The largest positive roots in falling order, times ``2**bits``, each with its group.

    A root is known to less than one.  Roots that no bisection could tell apart share a group
    and are then equal, as the roots of an integer polynomial that are so close must be for this size of
    ``bits`` unless they differ beyond double precision.
    """
    scaled = [c << bits * (len(polynomial) - 1 - k) for k, c in enumerate(polynomial)]
    top = 1
    while roots_above(scaled, top << bits):
        top *= 2
    found: list[tuple[int, int, int]] = []  # low end, high end, roots within (low, high]
    open_ = [(0, top << bits, roots_above(scaled, 0), 0)]
    while open_ and sum(n for *_, n in found) < most:
        low, high, above_low, above_high = open_.pop()
        n = above_low - above_high
        if not n:
            continue
        if n == 1 or high - low <= 1:
            found.append((low, high, n))
            continue
        middle = (low + high) // 2
        above = roots_above(scaled, middle)
        open_ += [(low, middle, above_low, above), (middle, high, above, above_high)]
    out = []
    for group, (low, high, n) in enumerate(found):
        if n == 1:
            side = _value_sign(scaled, high) or -_value_sign(scaled, low)
            while high - low > 1:
                middle = (low + high) // 2
                here = _value_sign(scaled, middle)
                if here == 0:
                    low, high = middle - 1, middle
                elif here == side:
                    high = middle
                else:
                    low = middle
        out += [(high, group)] * n
    return out[:most]


def null_vectors(matrix: list[list[int]], root: int, bits: int, many: int, digits: int = 320) -> np.ndarray:
    """``many`` orthonormal rows that the matrix less ``root / 2**bits`` sends to almost nothing.

    Inverse iteration in fixed-point integers with ``digits`` binary places.
    """
    d, one = len(matrix), 1 << digits
    scale = max(1, max(abs(x) for row in matrix for x in row))
    a = np.array([[(x << digits) // scale for x in row] for row in matrix], object)
    shift = (root << digits) // (scale << bits)
    for i in range(d):
        a[i, i] -= shift
    # Elimination with row exchanges; the smallest pivot is all that is left of the singular direction.
    order = list(range(d))
    for k in range(d):
        pivot = max(range(k, d), key=lambda i: abs(a[i, k]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if a[k, k] == 0:
            a[k, k] = 1
        if k + 1 < d:
            a[k + 1 :, k] = (a[k + 1 :, k] << digits) // a[k, k]
            a[k + 1 :, k + 1 :] -= (a[k + 1 :, k][:, None] * a[k, k + 1 :][None, :]) >> digits
    draw = np.random.default_rng(7)
    found: list[np.ndarray] = []
    for _ in range(many):
        v = np.array([int(x) for x in draw.integers(-(1 << 30), 1 << 30, d)], object)
        for _ in range(3):
            y = np.array([v[i] << digits for i in order], object)
            for k in range(d):
                y[k + 1 :] -= (a[k + 1 :, k] * y[k]) >> digits
            for k in range(d - 1, -1, -1):
                y[k] = (y[k] << digits) // a[k, k]
                y[:k] -= (a[:k, k] * y[k]) >> digits
            v = _unit(y, found, one, digits)
        found.append(v)
    return np.array([[float(x / one) for x in v] for v in found])


def _unit(v: np.ndarray, others: list[np.ndarray], one: int, digits: int) -> np.ndarray:
    """``v`` without its share of ``others``, of length one."""
    largest = max(abs(x) for x in v) or 1
    v = np.array([(x << digits) // largest for x in v], object)
    for other in others:
        v = v - ((other * (sum(v * other) >> digits)) >> digits)
    length = isqrt(sum(v * v)) or 1
    return np.array([x * one // length for x in v], object)
