"""Whitening against dense eigenvectors and exact whole numbers."""

import math
from fractions import Fraction

import numpy as np
import pytest

from riskloom.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=8):
    """(vec_id, x) in; values, vectors, and exact deviations, by dense algebra."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = np.array([[float(Fraction(int(n * v - s), n)) for v, s in zip(row, sums)] for row in x])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    deviations = [int(sum((n * v - s) ** 2 for v, s in zip(row, sums))) for row in x]
    return values, vectors, centred @ vectors / np.sqrt(values), deviations, values / np.trace(cov)


def check(got, rows, k):
    values, _, whitened, deviations, explained = brute(rows, k)
    assert len(got) == len(rows) * k
    by = {(r["vec_id"], r["component"]): r for r in got}
    for c in range(1, k + 1):
        ours = np.array([by[i, c]["whitened"] for i, _ in rows])
        theirs = whitened[:, c - 1]
        assert min(np.abs(ours - theirs).max(), np.abs(ours + theirs).max()) < 1e-9
        assert by[rows[0][0], c]["explained"] == pytest.approx(explained[c - 1], rel=1e-10)
    for (i, _), deviation in zip(rows, deviations):
        assert by[i, 1]["deviation"] == deviation and int(by[i, 1]["deviation_exact"]) == deviation
    assert {r["n"] for r in got} == {len(rows)} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-11


def test_given_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    check(wh.digest(table).collect(), [(r["vec_id"], r["embedding"]) for r in table.collect()], 8)


def test_odd_rows_take_no_part(spark):
    rng = np.random.default_rng(2)
    good = [(i, (v + [3, 0, 0, -2, 0]).tolist()) for i, v in enumerate(rng.normal(size=(90, 5)) * [5, 3, 2, 1, 0.1])]
    odd = [(100, None), (101, [None] * 5), (102, [float("nan")] + [0.0] * 4), (103, [float("inf")] + [0.0] * 4), (104, []), (105, [1.0]), (106, [1e30] * 5)]
    table = spark.createDataFrame(good + odd, SCHEMA).selectExpr("*", "1 AS n", "'x' AS whitened", "2 AS deviation")
    check(wh.digest(table).collect(), good, 5)
    kept = wh.transform(table, wh.fit(table)).collect()
    assert len(kept) == 90 and kept[0]["n"] == 1 and len(kept[0]["whitened"]) == 5


def test_repeated_and_null_ids(spark):
    rows = [(None, [0.0, 1.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0])]
    got = wh.digest(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r["vec_id"], r["component"]) for r in got), key=str) == [(3, 1), (3, 1), (None, 1)]
    assert got[0]["explained"] == pytest.approx(1)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)], [(1, [])]])
def test_nothing_varies(spark, rows):
    got = wh.digest(spark.createDataFrame(rows, SCHEMA))
    assert got.count() == 0 and got.columns[:3] == ["vec_id", "component", "n"]


def covariance(values, seed=0):
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return (turn * values) @ turn.T, turn


@pytest.mark.parametrize(
    "values",
    [np.r_[10.0, 9, 8, 7, 6, 5, 4, 3, np.linspace(2.99, 0.1, 392)], 1 / np.arange(1.0, 301), np.r_[np.full(4, 5.0), np.full(6, 4.0), np.ones(190)],
     np.r_[1e6, 1.0, 0.5, np.full(97, 1e-3)]],
)
def test_residuals_reach_rounding_in_few_products(values):
    a, _ = covariance(values)
    asked = []

    def product(v):
        asked.append(v.shape[1])
        return a @ v

    got, vectors, residuals = wh.jacobi_davidson(product, len(values), 8)
    assert residuals.max() <= 4 * wh.TOLERANCE * np.sqrt(len(values)) * values[0]
    np.testing.assert_allclose(got, np.sort(values)[::-1][:8], rtol=1e-12, atol=1e-13 * values[0])
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(8), atol=1e-13)
    assert max(asked) <= 12 and len(asked) < 250


def test_minres_solves():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(20, 20))
    a = a + a.T
    right = rng.normal(size=(20, 3))
    np.testing.assert_allclose(a @ wh.minres(lambda v: a @ v, right, 25), right, atol=1e-6)


def test_large_deviations_are_exact():
    x = np.array([[700, -3, 0], [-1024, 5, 9]], dtype=np.int64)
    for n, sums in ((10**9, [wh.SHIFT * 10**9 + 7, wh.SHIFT * 10**9, 12]), (10**15, [5, 6, 7]), (3, [300_000, 300_001, 299_000])):
        want = [sum((n * (int(v) + wh.SHIFT) - s) ** 2 for v, s in zip(row, sums)) for row in x]
        assert wh._deviations(x, n, sums) == want
