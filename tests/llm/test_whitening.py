"""Whitening next to float64 eigenvectors and whole-number arithmetic in plain Python."""

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from sensorloom.llm import whitening

SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("key", T.StringType()), T.StructField("Vector", T.StringType())]
)


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "k", "v") for i, v in rows], SCHEMA)


def whole(v):
    return [math.floor(64 * x) + 1_000_000 for x in v]


def held_against(rows, got, components=32):
    x = np.array([whole(v) for _, v in rows], np.int64)
    n, d = x.shape
    s = x.sum(axis=0)
    z = x - s / n
    value, basis = np.linalg.eigh(z.T @ z / n)
    value, basis = value[::-1], basis[:, ::-1]
    count = min(components, int((value > value[0] * 1e-12).sum()))
    assert len(got) == n * count
    by = {}
    for r in got:
        by.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    w = z @ basis[:, :count] / np.sqrt(value[:count])
    for c in range(1, count + 1):
        mine = np.array([by[i][c][0]["whitened"] for i, _ in rows])
        sign = np.sign(mine @ w[:, c - 1])
        assert mine * sign == pytest.approx(w[:, c - 1], abs=1e-7)
    for k, (i, _) in enumerate(rows):
        exact = sum((n * int(a) - int(t)) ** 2 for a, t in zip(x[k], s))
        for c, found in by[i].items():
            for r in found:
                assert (r["n"], int(r["deviation"])) == (n, exact)
                assert r["explained"] == pytest.approx(value[c - 1] / value.sum(), rel=1e-9)
                assert r["identity_error"] <= 1e-9


def test_rows_against_float64(spark):
    rng = np.random.default_rng(3)
    turn = rng.normal(size=(6, 6))
    rows = [(k, rng.normal(size=6) @ turn) for k in range(300)]
    odd = [(1000, None), (1001, [1, None, 1, 1, 1, 1]), (1002, [math.nan] * 6), (1003, [math.inf] + [0] * 5), (1004, []), (1005, [1.0] * 5)]
    held_against(rows, whitening.whiten(vectors(spark, rows + odd).repartition(5)).collect())
    held_against(rows, whitening.whiten(vectors(spark, rows), components=4).collect(), components=4)


def test_repeated_rows_and_null_keys(spark):
    rows = [(1, [0.0, 1.0]), (1, [0.0, 1.0]), (None, [2.0, -1.0]), (2, [5.0, 3.0])]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert len(got) == 8 and sum(r["vec_id"] is None for r in got) == 2


def test_small_tables_have_no_component(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(vectors(spark, rows)).collect() == []


def test_dependent_dimensions_have_no_component_of_their_own(spark):
    rng = np.random.default_rng(4)
    rows = [(k, [a, b, a, 7.0]) for k, (a, b) in enumerate(rng.integers(-50, 50, (80, 2)).astype(float))]
    assert {r["component"] for r in whitening.whiten(vectors(spark, rows)).collect()} == {1, 2}


def test_entries_without_bound(spark):
    rows = [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.5, -3.0])]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert len(got) == 3 and all(math.isfinite(r["whitened"]) for r in got)  # beside 2^40 the second dimension is no variance
    x = [[2**40 if v > 1e12 else -(2**40) if v < -1e12 else math.floor(64 * v) for v in row] for _, row in rows]
    s = [sum(c) for c in zip(*x)]
    assert {int(r["deviation"]) for r in got} == {sum((3 * a - t) ** 2 for a, t in zip(row, s)) for row in x}


def test_products_are_exact():
    rng = np.random.default_rng(5)
    z = rng.integers(-(2**41), 2**41, (50, 4))
    want = [[sum(int(r[i]) * int(r[j]) for r in z) for j in range(4)] for i in range(4)]
    assert whitening.products(z).tolist() == want
    small = rng.integers(-30, 30, (9000, 3))
    assert whitening.products(small).tolist() == (small.T @ small).tolist()


@pytest.mark.parametrize("values", [[9, 4, 1, 0.5], [5, 5, 5, 1], [3, 3 - 1e-9, 3 - 2e-9, 1], [1, 1e-6, 1e-12, 1e-13], [2, 2, 2, 2], [7, 7 - 1e-14, 1, 1 - 1e-13], [1, 0, 0, 0]])
def test_eigenvectors_of_clusters(values):
    rng = np.random.default_rng(6)
    q, _ = np.linalg.qr(rng.normal(size=(4, 4)))
    q = q.astype(np.longdouble)
    for _ in range(3):
        q = q + q @ ((np.eye(4, dtype=np.longdouble) - q.T @ q) / 2)
    a = q @ np.diag(np.array(values, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    value, x = whitening.eigen(a)
    assert np.abs(value - np.sort(np.array(values, np.longdouble))[::-1]).max() <= 1e-17 * max(values)
    assert np.abs(x.T @ x - np.eye(4)).max() <= 1e-17
    assert np.abs(a @ x - x * value).max() <= 2e-17 * max(values)
    for k, v in enumerate(sorted(values, reverse=True)):
        gap = min(abs(v - w) for w in values if w != v) if len(set(values)) > 1 else 0
        if values.count(v) == 1:  # a vector of its own, as good as its gap lets rounding be
            own = q[:, values.index(v)]
            assert 1 - abs(own @ x[:, k]) <= (1e-18 * max(values) / gap) ** 2 + 1e-17
    assert np.abs(np.linalg.eigvalsh(a.astype(float))[::-1] - value.astype(float)).max() <= 1e-14 * max(values)
