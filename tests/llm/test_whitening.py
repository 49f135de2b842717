"""Exact polynomial, roots and components against numpy and plain sums."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from gridspark.llm import whitening


def gram(rng, d, rows, spread=50):
    a = [[rng.randrange(-spread, spread) for _ in range(d)] for _ in range(rows)]
    return [[sum(r[i] * r[j] for r in a) for j in range(d)] for i in range(d)]


def plain_characteristic(square):
    """Faddeev-LeVerrier in fractions, constant first."""
    d = len(square)
    m, c = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(square[i][t] * m[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(square[i][t] * m[t][i] for i in range(d) for t in range(d)) / Fraction(k))
    return [int(v) for v in reversed(c)]


@pytest.mark.parametrize("d,rows", [(1, 3), (2, 1), (5, 9), (7, 4), (12, 30)])
def test_characteristic(spark, d, rows):
    square = gram(random.Random(d), d, rows)
    assert whitening.characteristic(spark, square) == plain_characteristic(square)


def test_hessenberg_with_missing_pivots():
    square = [[2, 0, 0, 1], [0, 3, 0, 0], [0, 0, 3, 0], [1, 0, 0, 2]]
    p = whitening.TOP_PRIME
    assert whitening.characteristic_mod(square, p).tolist() == [c % p for c in plain_characteristic(square)]


def test_roots_close_equal_and_below_one():
    def times(roots):
        poly = [1]
        for r in roots:
            poly = [(poly[i - 1] if i else 0) - r * (poly[i] if i < len(poly) else 0) for i in range(len(poly) + 1)]
        return poly

    big = 10 ** 20
    poly = times([big + 1, big, 7, 7, 7, 1])
    for k, (want, place) in enumerate([(big + 1, 0), (big, 0), (7, 0), (7, 1), (7, 2), (1, 0)], 1):
        value, s, got = whitening.root(poly, k)
        assert abs(Fraction(value, 1 << s) - want) <= Fraction(1, 1 << s) and got == place
        assert s + want.bit_length() >= whitening.ROOT_BITS - 1
    golden = whitening.root([1, -3, 1], 2)                            # (3 - sqrt 5) / 2
    assert abs(golden[0] / 2 ** golden[1] - (3 - math.sqrt(5)) / 2) < 1e-15


def test_components_of_equal_eigenvalues():
    block = gram(random.Random(2), 3, 5)
    square = [[block[i % 3][j % 3] if i // 3 == j // 3 else 0 for j in range(6)] for i in range(6)]
    poly = plain_characteristic(square)
    vectors = []
    for k in range(1, 7):
        value, s, place = whitening.root(poly, k)
        v = whitening.component(square, value, s, place)
        assert np.abs(np.array(square, float) @ v - value / 2 ** s * v).max() < 1e-9 * value / 2 ** s + 1e-9
        vectors.append(v)
    assert np.abs(np.array(vectors) @ np.array(vectors).T - np.eye(6)).max() < 1e-14


SCHEMA = "vec_id long, embedding array<float>, component int, whitened string, n int, _key int"


def check(rows, got, most):
    fit = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows]
    n, d = len(fit), len(fit[0][1])
    sums = [sum(x[j] for _, x in fit) for j in range(d)]
    x = np.array([[Fraction(n * a - s, n) for a, s in zip(v, sums)] for _, v in fit], float)
    values, vectors = np.linalg.eigh(x.T @ x / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    rank = int((values > 1e-9 * values[0]).sum())
    k = min(most, rank)
    by = {}
    for r in got:
        by.setdefault(r.component, []).append(r)
    assert sorted(by) == list(range(1, k + 1)) and all(len(v) == n for v in by.values())
    order = sorted(range(n), key=lambda t: (fit[t][0] is not None, fit[t][0], fit[t][1]))
    for c, part in by.items():
        want = x @ vectors[:, c - 1] / math.sqrt(values[c - 1])
        assert {r.n for r in part} == {n} and all(r.identity_error < 1e-9 for r in part)
        assert all(abs(r.explained - values[c - 1] / values.sum()) < 1e-9 for r in part)
        assert sorted(r.deviation for r in part) == sorted(sum((n * a - s) ** 2 for a, s in zip(v, sums)) for _, v in fit)
        have = {}
        for r in part:
            have.setdefault(r.vec_id, []).append(r.whitened)
        plus = all(min(abs(w - g) for g in have[fit[t][0]]) < 1e-6 for t, w in zip(order, want[order]))
        minus = all(min(abs(w + g) for g in have[fit[t][0]]) < 1e-6 for t, w in zip(order, want[order]))
        assert plus or minus


@pytest.mark.parametrize("n,d,most,loud", [(200, 6, 32, 1.0), (40, 9, 4, 1e4), (5, 8, 32, 1.0)])
def test_whiten(spark, n, d, most, loud):
    rng = np.random.default_rng(n)
    rows = [(i, (rng.normal(0, 1 + np.arange(d), d) * loud).tolist()) for i in range(n)]
    odd = [(900, None), (901, [1.0] * (d - 1) + [None]), (902, [1.0] * (d - 1) + [float("nan")]), (903, []), (904, [float("inf")] * d),
           (905, [1.0])]
    frame = spark.createDataFrame([(i, v, 1, "a", 2, 3) for i, v in rows + odd], SCHEMA)
    check(rows, whitening.whiten(frame, most=most).collect(), most)


def test_whiten_repeats_nulls_and_constant_dimensions(spark):
    rows = [(1, [1.0, 5.0, 2.0])] * 3 + [(None, [2.0, 5.0, -1.0]), (4, [0.5, 5.0, 0.0]), (5, [-3.0, 5.0, 9.0])]
    check(rows, whitening.whiten(spark.createDataFrame([(i, v, 1, "a", 2, 3) for i, v in rows], SCHEMA)).collect(), 32)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_whiten_nothing_to_fit(spark, rows):
    out = whitening.whiten(spark.createDataFrame([(i, v, 1, "a", 2, 3) for i, v in rows], SCHEMA))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"] and out.count() == 0


def test_whiten_huge_entries(spark):
    rows = [(i, [float(10 ** 17) * (i - 3), 3.4e38 if i == 2 else -1.0, i / 64]) for i in range(8)]
    out = whitening.whiten(spark.createDataFrame([(i, v, 1, "a", 2, 3) for i, v in rows], SCHEMA)).collect()
    assert len(out) == 24 and all(r.deviation is None for r in out) and all(r.identity_error < 1e-6 for r in out)
