from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import eigen, whitening


def brute(vectors, most=32):
    """Doubles only, and exact integers for the deviation."""
    x = np.floor(64 * np.array(vectors, float)).astype(int) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    cov = centred.T @ centred / n
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1], vecs[:, ::-1]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, sums)) for row in x]
    return n, deviation, centred @ vecs[:, :most] / np.sqrt(values[:most]), (values / cov.trace())[:most]


def made(n, d, seed=3, scale=1.0):
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(n, d)) @ draw.normal(size=(d, d)) * scale).tolist()


def told(report):
    rows = sorted(report.collect(), key=lambda r: (r.vec_id, r.component))
    return rows, len({r.vec_id for r in rows})


@pytest.mark.parametrize("n, d, scale", [(50, 3, 1.0), (200, 12, 0.1), (300, 40, 1e6)])
def test_equals_doubles(spark, n, d, scale):
    vectors = made(n, d, scale=scale)
    rows, found = told(whitening.whitening_report(spark.createDataFrame(list(enumerate(vectors)), "vec_id bigint, embedding array<double>").repartition(3)))
    _, deviation, white, explained = brute(vectors)
    k = min(32, d)
    assert found == n and len(rows) == n * k
    got = np.array([r.whitened for r in rows]).reshape(n, k)
    signs = np.sign((got * white).sum(axis=0))
    assert np.abs(got - white * signs).max() < 1e-7
    assert [r.explained for r in rows[:k]] == pytest.approx(explained, rel=1e-9)
    assert [r.deviation for r in rows[::k]] == [v if v < 2**63 else None for v in deviation]
    assert {r.n for r in rows} == {n} and max(r.identity_error for r in rows) < 1e-9


def test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    vectors = [r.embedding for r in table.orderBy("vec_id").collect()]
    rows, found = told(whitening.whitening_report(table))
    n, deviation, white, explained = brute(vectors)
    got = np.array([r.whitened for r in rows]).reshape(n, 32)
    assert np.abs(got - white * np.sign((got * white).sum(axis=0))).max() < 1e-8
    assert [r.deviation for r in rows[::32]] == deviation and [r.component for r in rows[:32]] == list(range(1, 33))


def test_awkward_rows(spark):
    good = made(30, 4)
    bad = [None, [], [1.0, None, 0.0, 0.0], [float("nan"), 0.0, 0.0, 0.0], [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0], [1e300, 0.0, 0.0, 0.0]]
    rows = [(k, v, "x") for k, v in enumerate(good + bad)] + [(None, good[0], "y"), (3, good[3], "z")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, deviation string")
    report = whitening.whitening_report(table).collect()
    assert len(report) == 32 * 4 and {r.n for r in report} == {32} and {r.vec_id for r in report} == {None, *range(30)}
    model = whitening.fit(table)
    kept, column = whitening.transform(table, model)
    assert kept.columns == [*table.columns, column] and kept.count() == 32


def test_nothing_to_whiten(spark):
    schema = "vec_id bigint, embedding array<double>"
    for rows in ([], [(1, None)], [(1, [2.0, 3.0])], [(1, [2.0, 3.0]), (2, [2.0, 3.0])]):
        report = whitening.whitening_report(spark.createDataFrame(rows, schema))
        assert report.count() == 0 and report.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_equal_eigenvalues_and_missing_dimensions(spark):
    points = [[0, 0, 5], [2, 2, 5], [0, 2, 5], [2, 0, 5]]  # two equal eigenvalues and a zero
    rows, _ = told(whitening.whitening_report(spark.createDataFrame([(k, [float(x) for x in p]) for k, p in enumerate(points)], "vec_id bigint, embedding array<double>")))
    assert len(rows) == 8 and [r.explained for r in rows[:2]] == [0.5, 0.5] and rows[0].identity_error < 1e-12


def test_polynomial_is_exact():
    draw = np.random.default_rng(5)
    for d in (1, 2, 3, 7):
        half = draw.integers(-50, 50, (d, d)).astype(object)
        half[:, d // 2] = half[:, 0]  # a singular one
        m = (half.T @ half).tolist()
        polynomial = eigen.combine({p: eigen.polynomial_mod(m, p) for p in eigen.primes_for(m)})
        assert polynomial[d] == 1 and len(polynomial) == d + 1
        for x in range(-3, d):  # as many places as the degree decide it
            rows = [[Fraction((x if i == j else 0) - m[i][j]) for j in range(d)] for i in range(d)]
            det = Fraction(1)
            for k in range(d):
                pivot = next((i for i in range(k, d) if rows[i][k]), None)
                if pivot is None:
                    det = Fraction(0)
                    break
                if pivot != k:
                    rows[k], rows[pivot], det = rows[pivot], rows[k], -det
                det *= rows[k][k]
                for i in range(k + 1, d):
                    f = rows[i][k] / rows[k][k]
                    rows[i] = [a - f * b for a, b in zip(rows[i], rows[k])]
            assert sum(c * x**k for k, c in enumerate(polynomial)) == det


def test_roots():
    # (x - 1)(x - 7)^2 (x - 10), constant first
    polynomial = [1]
    for root in (1, 7, 7, 10):
        polynomial = [a - root * b for a, b in zip([0, *polynomial], [*polynomial, 0])]
    assert [eigen.roots_above(polynomial, x) for x in (0, 1, 6, 7, 9, 10)] == [4, 3, 3, 1, 1, 0]
    found = eigen.largest_roots(polynomial, 9, 20)
    assert [r for r, _ in found] == [x << 20 for x in (10, 7, 7, 1)] and found[1][1] == found[2][1]
    assert [r for r, _ in eigen.largest_roots(polynomial, 2, 20)] == [10 << 20, 7 << 20]


def test_close_eigenvalues():
    # Two of them differ in the 13th digit.
    m = [[10**13, 1, 0], [1, 10**13, 0], [0, 0, 5]]
    polynomial = eigen.combine({p: eigen.polynomial_mod(m, p) for p in eigen.primes_for(m)})
    roots = eigen.largest_roots(polynomial, 3, 96)
    assert [r >> 96 for r, _ in roots] == [10**13 + 1, 10**13 - 1, 5]
    v = eigen.null_vectors(m, roots[0][0], 96, 1)[0]
    assert np.abs(np.abs(v) - [0.5**0.5, 0.5**0.5, 0]).max() < 1e-15
