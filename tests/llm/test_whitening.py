"""Whitening against an eigendecomposition of the whole matrix."""

import math

import numpy as np
import pytest

from flowtables.llm import whitening


def table(spark, vectors, ids=None):
    ids = list(range(len(vectors))) if ids is None else ids
    rows = [(i, None if v is None else [None if e is None else float(e) for e in v], 1.5, 3, "x") for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, n double, component int, id string").repartition(4)


def expected(vectors):
    x = np.array([[math.floor(1024 * e) + 100000 for e in v] for v in vectors], dtype=np.float64)
    c = x - x.mean(0)
    values, right = np.linalg.eigh(c.T @ c / len(x))
    return c, values[::-1], right[:, ::-1]


def check(spark, vectors, count=8):
    rows = whitening.whitened(table(spark, vectors), count).collect()
    c, values, right = expected(vectors)
    n, k = len(vectors), min(count, int((values > values[0] * 1e-12).sum()))
    assert len(rows) == n * k and {r["component"] for r in rows} == set(range(1, k + 1))
    whole = [[math.floor(1024 * e) + 100000 for e in v] for v in vectors]
    sums = [sum(col) for col in zip(*whole, strict=True)]
    got = np.zeros((n, k))
    for r in rows:
        got[r["vec_id"], r["component"] - 1] = r["whitened"]
        deviation = sum((n * e - s) ** 2 for e, s in zip(whole[r["vec_id"]], sums, strict=True))
        assert r["n"] == n and r["deviation"] == (deviation if deviation < 2**63 else None)
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
        assert r["identity_error"] < 1e-9
    want = c @ right[:, :k] / np.sqrt(values[:k])
    for j in range(k):
        sign = np.sign(got[:, j] @ want[:, j])
        assert np.allclose(got[:, j], sign * want[:, j], atol=1e-7)


def test_random_vectors(spark):
    rng = np.random.default_rng(1)
    check(spark, rng.normal(size=(300, 20)) * np.linspace(0.05, 2, 20))


def test_ill_conditioned_vectors(spark):
    """Variances over nine powers of ten, so one Cholesky factor of the Gram matrix would not do."""
    rng = np.random.default_rng(2)
    mix = np.linalg.qr(rng.normal(size=(10, 10)))[0]
    check(spark, (rng.normal(size=(400, 10)) * np.logspace(3, -1.5, 10)) @ mix, count=10)


def test_fewer_directions_than_components(spark):
    rng = np.random.default_rng(3)
    flat = np.round(rng.normal(size=(60, 3)) * 4)
    check(spark, np.hstack([flat, flat[:, :2], np.zeros((60, 2))]))
    check(spark, [[1.0, 2.0], [3.0, 2.0]])


def test_rows_that_cannot_be_used(spark):
    rng = np.random.default_rng(4)
    good = rng.normal(size=(40, 4)).tolist()
    bad = [None, [], [1.0, None, 2.0, 3.0], [1.0, float("nan"), 2.0, 3.0], [float("inf"), 1.0, 2.0, 3.0], [1.0, 2.0], [1.0] * 9]
    ids = [2**62 + k for k in range(38)] + [None, 2**62] + [900 + k for k in range(len(bad))]
    rows = whitening.whitened(table(spark, good + bad, ids), 3).collect()
    assert sorted(((r["vec_id"], r["component"]) for r in rows), key=str) == sorted(((i, k) for i in ids[:40] for k in (1, 2, 3)), key=str)
    assert {r["n"] for r in rows} == {40}


def test_deviation_beyond_doubles_and_longs(spark):
    far = [[1e3 * k, float(k % 3)] for k in range(60)]
    check(spark, far, 2)
    rows = whitening.whitened(table(spark, [[0.0, 1.0], [3e9, 2.0], [1.0, 5.0]]), 1).collect()
    assert any(r["deviation"] is None for r in rows)


def test_no_direction_at_all(spark):
    for vectors in ([], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [[]]):
        found = whitening.whitened(table(spark, vectors))
        assert found.collect() == [] and found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
