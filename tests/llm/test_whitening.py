"""Spectrum slicing and whitening against numpy's eigensolver and exact Python numbers."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from cardlake.llm.whitening import leading, op11_spectrum_whitening, positive_pivots, whiten

SF = "/root/testdata/sf0.001"


def _brute(rows):
    """{row number: deviation} and the fit list's n, sums and covariance in exact fractions."""
    xs = {i: tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for i, (_, v) in enumerate(rows)
          if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    dim = max(map(len, xs.values()))
    xs = {i: x + (1_000_000,) * (dim - len(x)) for i, x in xs.items()}
    fit = sorted(set(xs.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for i, x in xs.items()}
    centred = [[Fraction(n * a - s, n) for a, s in zip(x, sums)] for x in fit]
    v = [[float(sum(c[i] * c[j] for c in centred) / n) for j in range(dim)] for i in range(dim)]
    return xs, n, sums, deviation, np.array(v)


@pytest.mark.parametrize("d", [1, 2, 3, 8, 40])
def test_counts_are_the_inertia(d):
    random = np.random.default_rng(d)
    for _ in range(20):
        a = random.standard_normal((d, d))
        a = a + a.T
        if d > 2:
            np.fill_diagonal(a, 0)  # needs blocks of two
        assert positive_pivots(a) == int((np.linalg.eigvalsh(a) > 0).sum())


@pytest.mark.parametrize("values", [
    [9, 4, 1, 0.25], [5, 5, 5, 1, 1, 0.5], [1e6, 1e6 * (1 - 1e-7), 1, 1e-6], [3] * 6, [1, 0, 0, 0], [2.0 ** -k for k in range(30)],
    [1, 1 - 1e-9, 1 - 2e-9, 0.5]])
def test_leading_pairs(values):
    values = np.array(values, float)
    q, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((len(values), len(values))))
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    e, x = leading(v)
    wanted = values[values > 1e-14 * values.max()][:16]
    assert len(e) == len(wanted) and np.allclose(e, wanted, rtol=1e-9, atol=1e-13 * values.max())
    assert np.allclose(x.T @ x, np.eye(len(e)), atol=1e-12)
    assert np.abs(v @ x - x * e).max() <= 1e-12 * values.max()


def test_no_variance():
    assert leading(np.zeros((4, 4)))[0].shape == (0,)
    assert leading(np.zeros((0, 0)))[1].shape == (0, 0)


def _compare(got, rows, components=16):
    xs, n, sums, deviation, v = _brute(rows)
    wanted, vectors = np.linalg.eigh(v)
    wanted, vectors = wanted[::-1], vectors[:, ::-1]
    k = min(components, len(wanted), int((wanted > len(v) * 2.3e-16 * wanted[0]).sum()))
    assert len(got) == len(xs) * k
    assert {r["n"] for r in got} == {n}
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-6
    for r in got:
        assert math.isclose(r["explained"], wanted[r["component"] - 1] / np.trace(v), rel_tol=1e-6)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    for vec_id, mine in by_id.items():
        numbers = [i for i in xs if rows[i][0] == vec_id]
        assert sorted(r["deviation"] for r in mine) == sorted(deviation[i] for i in numbers for _ in range(k))
    return by_id, xs, n, sums, wanted, vectors, k


def test_query(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    by_id, xs, n, sums, values, vectors, k = _compare(op11_spectrum_whitening(spark, SF).collect(), rows)
    assert k == 16
    signs = {}
    for i, x in xs.items():
        centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        for r in by_id[rows[i][0]]:
            c = r["component"] - 1
            w = centred @ vectors[:, c] / math.sqrt(values[c])
            sign = signs.setdefault(c, math.copysign(1, w * r["whitened"]))
            assert math.isclose(sign * r["whitened"], w, rel_tol=1e-6, abs_tol=1e-7)


def test_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, 1.0, -2.0]), (1, [0.5, 1.0, -2.0]), (2, [3.0, 1.5, 0.0]), (None, [0.25, -9.0, 4.0]), (3, None), (4, [1.0, None, 2.0]),
            (5, [nan, 0.0, 0.0]), (6, [0.0, -inf, 0.0]), (7, [7.0, 7.0]), (8, [0.0, 0.0, 100.0]), (9, []), (10, [2.0, 2.0, 50.0])]
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<float>, component string, whitened double")
    got = whiten(df).collect()
    _compare(got, rows)
    assert {r["vec_id"] for r in got} == {1, 2, None, 7, 8, 9, 10}


def test_many_copies_of_one_vector_are_fitted_once(spark):
    rows = [(i, [1.0, 2.0]) for i in range(200)] + [(500, [3.0, -1.0]), (501, [0.0, 0.5]), (502, [-4.0, 2.5])]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)).collect()
    _compare(got, rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    assert whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect() == []


def test_constant_dimensions_have_no_component(spark):
    rows = [(1, [1.0, 5.0]), (2, [2.0, 5.0]), (3, [4.0, 5.0])]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in got} == {1} and got[0]["identity_error"] < 1e-12


def test_large_entries(spark):
    rows = [(1, [1e6, -3e6]), (2, [2e6, 1e6]), (3, [-1.5e6, 2.5e5])]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    _compare(got, rows)
    far = spark.createDataFrame([(1, [1e300]), (2, [0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="beyond"):
        whiten(far).collect()
