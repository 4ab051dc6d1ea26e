"""Whitening against a floating-point eigensolver, and its exact parts against plain ones."""

import itertools
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import whitening
from tierflow.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>"


def reference(vectors, most=16):
    x = np.floor(64 * np.asarray(vectors, dtype=float))
    fitted = np.unique(x, axis=0)
    centred = fitted - fitted.mean(axis=0)
    values, components = np.linalg.eigh(centred.T @ centred / len(fitted))
    values, components = values[::-1][:most], components[:, ::-1][:, :most]
    return fitted, x, values, (x - fitted.mean(axis=0)) @ components / np.sqrt(np.abs(values))


def found(df):
    rows = df.collect()
    out = {}
    for r in rows:
        out.setdefault(r["id"], {})[r["component"]] = r
    return rows, out


def same_up_to_sign(a, b, tolerance):
    return all(min(np.abs(x - y).max(), np.abs(x + y).max()) < tolerance for x, y in zip(a.T, b.T, strict=True))


def test_query_against_an_eigensolver(spark):
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").collect()
    vectors = [r["embedding"] for r in table]
    fitted, x, values, white = reference(vectors)
    out = QUERIES["op13_whitening"](spark, SF_DIR).orderBy("vec_id", "component").collect()
    assert len(out) == 16 * len(vectors)
    assert same_up_to_sign(np.array([r["whitened"] for r in out]).reshape(-1, 16), white, 1e-9)
    n, sums = len(fitted), fitted.sum(axis=0)
    deviation = [int(d) for d in ((n * x - sums) ** 2).sum(axis=1)]
    assert [r["deviation"] for r in out[::16]] == deviation and out[0]["n"] == n
    total = np.trace(np.cov(fitted.T, bias=True))
    assert np.allclose([r["explained"] for r in out[:16]], values / total, rtol=1e-10)
    assert out[0]["identity_error"] < 1e-9


def test_odd_rows(spark):
    rnd = np.random.default_rng(1)
    vectors = rnd.normal(size=(30, 4)).tolist()
    rows = [*enumerate(vectors), (100, vectors[0]), (7, vectors[3]), (None, vectors[5])]
    odd = [(200, None), (201, [1.0, None, 2.0, 3.0]), (202, [float("nan")] * 4), (203, [float("inf"), 1.0, 2.0, 3.0]), (204, [1.0, 2.0]), (205, [])]
    df = spark.createDataFrame(rows + odd, SCHEMA).repartition(4)
    clashing = df.withColumns({c: F.lit(1) for c in "id v y n component whitened explained deviation".split()})
    _, _, values, white = reference([v for _, v in rows])
    for table in (df, clashing):
        out, _ = found(whitening.whiten(table, "vec_id", "embedding"))
        assert len(out) == 4 * len(rows) and {r["n"] for r in out} == {30}
        first = {r["component"]: r["whitened"] for r in out if r["id"] == 100}
        assert all(abs(abs(first[k + 1]) - abs(white[0][k])) < 1e-9 for k in range(4))


def test_tables_without_components(spark):
    for rows in ([], [(1, [1.0, 2.0])] * 3, [(1, None)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding").isEmpty()


def test_equal_and_absent_eigenvalues(spark):
    # Along three axes alike, along a fourth not at all, along a fifth more.
    axes = [[s * (2.0 if k == 4 else 1.0) if i == k else 0.0 for i in range(5)] for k in (0, 1, 2, 4) for s in (1, -1)]
    out, by_id = found(whitening.whiten(spark.createDataFrame(list(enumerate(axes)), SCHEMA), "vec_id", "embedding"))
    assert {r["component"] for r in out} == {1, 2, 3, 4}
    white = np.array([[by_id[i][k]["whitened"] for k in range(1, 5)] for i in range(8)])
    assert np.abs(white.T @ white / 8 - np.eye(4)).max() < 1e-12
    assert out[0]["identity_error"] < 1e-12
    assert abs(by_id[0][1]["explained"] - 4 / 7) < 1e-12


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(1 << 40) * i, float(i * i), 1e300]) for i in range(9)]
    out, by_id = found(whitening.whiten(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding"))
    x = [[64 * (1 << 40) * i, 64 * i * i] for i in range(9)]
    sums = [sum(c) for c in zip(*x, strict=True)]
    for i in range(9):
        assert by_id[i][1]["deviation"] == sum((9 * c - s) ** 2 for c, s in zip(x[i], sums, strict=True))
    assert out[0]["identity_error"] < 1e-9 and {r["component"] for r in out} == {1, 2}


def test_characteristic_polynomial(spark):
    rnd = np.random.default_rng(3)
    half = rnd.integers(-50, 50, (4, 6)).astype(object)
    half[:, 2] = 0
    matrix = half.T @ half

    def det(m):
        total = 0
        for order in itertools.permutations(range(len(m))):
            sign = (-1) ** sum(a > b for a, b in itertools.combinations(order, 2))
            term = sign
            for i, j in enumerate(order):
                term *= m[i][j]
            total += term
        return total

    coefficients = whitening.characteristic(spark, matrix)
    for x in range(-3, 4):
        shifted = [[x * (i == j) - matrix[i, j] for j in range(6)] for i in range(6)]
        assert sum(c * x ** (6 - k) for k, c in enumerate(coefficients)) == det(shifted)
    assert whitening.roots_above(coefficients, 0) == 4


@pytest.mark.parametrize("roots", [[9, 9, 9, 4, 0], [7, 7, 2, 2], [10**30, 10**30 - 1, 5, 1], [3], [0, 0]])
def test_largest_roots(roots):
    coefficients = [1]
    for r in roots:
        coefficients = [a - r * b for a, b in zip([*coefficients, 0], [0, *coefficients], strict=True)]
    positive = [r for r in roots if r]
    out = whitening.largest_roots(coefficients, 16)
    assert [round(r) for r in out] == positive and all(abs(a - b) <= Fraction(b, 1 << 100) for a, b in zip(out, positive, strict=True))
    assert whitening.largest_roots(coefficients, 2) == out[:2]
