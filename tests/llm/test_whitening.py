"""Whitening against an eigendecomposition of the whole covariance."""

from __future__ import annotations

import math

import numpy as np
import pytest

from marketmill.llm import whitening


def eigen(x):
    n, sums = len(x), x.sum(axis=0)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return values[::-1], axes[:, ::-1]


def fitted(spark, x, block, components=8):
    rows = spark.createDataFrame([(row.tolist(),) for row in x], "v array<long>").repartition(3)
    return whitening.fit_whitening(rows, components, block)


RNG = np.random.default_rng(4)
CASES = {
    "flat": RNG.integers(-500, 500, (300, 12)),
    "few directions": RNG.integers(-50, 50, (200, 3)) @ RNG.integers(-3, 4, (3, 10)),
    "steep": np.floor(RNG.normal(0, 1, (300, 14)) * np.logspace(8, 0, 14)).astype(np.int64),
    "equal deviations": np.vstack([np.eye(12, dtype=np.int64), -np.eye(12, dtype=np.int64)]) * 1000,
    "fewer rows than directions": RNG.integers(-500, 500, (5, 12)),
}


@pytest.mark.parametrize("block", [1, 3, 8])
@pytest.mark.parametrize("name", CASES)
def test_components(spark, name, block):
    x = CASES[name] + 100_000
    values, axes = eigen(x)
    model = fitted(spark, x, block)
    real = min(8, int((values > 1e-15 * values[0]).sum()), len(x) - 1)
    assert len(model.variances) == real
    np.testing.assert_allclose(model.variances, values[:real], rtol=1e-9)
    assert model.identity_error < 1e-9
    assert math.isclose(model.trace, values.sum(), rel_tol=1e-12)
    if name == "flat":
        alike = np.abs(model.components.T @ axes[:, :real])
        np.testing.assert_allclose(alike, np.eye(real), atol=1e-9)


def test_it_stops_when_the_components_are_found(spark):
    x = np.floor(RNG.normal(0, 1, (500, 40)) * np.append([9000, 5000, 3000], np.full(37, 10)))
    model = fitted(spark, x.astype(np.int64), 4, components=3)
    assert len(model.variances) == 3 and model.passes < 12


def test_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[0.25, -1.0, 3.0], [0.5, 0.0, 1.0], [1.0, 2.5, 0.125], [0.5, 0.0, 1.0], [-0.001, 0.3, 0.7]]
    bad = [None, [nan, 1.0, 1.0], [inf, 1.0, 1.0], [1.0, -inf, 0.0], [1.0, None, 2.0], [1.0, 2.0], []]
    rows = [(i, v, "x") for i, v in enumerate([*vectors, *bad])] + [(None, vectors[0], "y"), (0, vectors[0], "z")]
    schema = "vec_id long, embedding array<float>, vector string"
    df = spark.createDataFrame(rows, schema).repartition(3)
    used = [*vectors, vectors[0], vectors[0]]
    x = (np.floor(1024 * np.array(used, dtype=np.float32).astype(float)) + 100_000).astype(np.int64)
    values, axes = eigen(x)
    found = whitening.whitened_components(df).collect()
    assert len(found) == 3 * len(used)
    n, sums = len(x), x.sum(axis=0)
    for row in found:
        own = x[row["vec_id"] or 0]
        c = row["component"] - 1
        assert row["n"] == n and row["deviation"] == ((n * own - sums) ** 2).sum()
        want = (own - sums / n) @ axes[:, c] / np.sqrt(values[c])
        assert math.isclose(abs(row["whitened"]), abs(want), rel_tol=1e-8, abs_tol=1e-9)
        assert math.isclose(row["explained"], values[c] / values.sum(), rel_tol=1e-10)
        assert row["identity_error"] < 1e-10
    for few in (df.limit(0), df.filter("vec_id = 1"), df.filter("vec_id IN (1, 3)"), df.filter("vec_id > 4")):
        none = whitening.whitened_components(few)
        assert none.count() == 0 and none.columns == whitening.whitened_components(df).columns


def test_deviations_are_exact():
    rows = np.array([[2**40, 3], [7, 2**41]])
    sums = rows.sum(axis=0)
    want = [sum((2 * int(x) - int(s)) ** 2 for x, s in zip(r, sums, strict=True)) for r in rows]
    assert whitening.deviations(rows, 2, sums) == want
    small = np.array([[5, 9], [1, 2]])
    assert whitening.deviations(small, 2, small.sum(axis=0)).tolist() == [65, 65]
