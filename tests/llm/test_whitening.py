from __future__ import annotations

import math

import numpy as np
import pytest

from orderloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def brute(vectors):
    """Mean, eigenvalues (falling), eigenvectors and the distinct whole-number vectors."""
    x = np.unique(np.floor(np.array(vectors, np.float32).astype(float) * 64).astype(np.int64) + 1_000_000, axis=0)
    centred = x - x.sum(axis=0) / len(x)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    return x, x.sum(axis=0), values[::-1], axes[:, ::-1]


def test_against_an_eigensolver(spark):
    rng = np.random.default_rng(1)
    own = (rng.standard_normal((300, 24)) @ rng.standard_normal((24, 24)) + 3).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(own)]
    rows += [(900 + i, own[0].tolist()) for i in range(200)]  # a crowd of one vector, which counts once
    rows += [(None, own[1].tolist()), (700, own[2].tolist()), (700, own[2].tolist())]
    odd = [(1000, None), (1001, [None] * 24), (1002, [math.nan] * 24), (1003, [math.inf] + [0.0] * 23)]
    table = embeddings(spark, rows + odd).withColumnRenamed("label", "x").repartition(5)
    got = whitening.whiten(table).collect()
    x, sums, values, axes = brute(own)
    assert len(got) == 16 * len(rows) and {row["vec_id"] for row in got} == {i for i, _ in rows}
    by_row = {}
    for row in got:
        assert row["n"] == len(x) and row["identity_error"] <= 1e-9
        assert row["explained"] == pytest.approx(values[row["component"] - 1] / values.sum(), rel=1e-9)
        by_row.setdefault(row["vec_id"], {})[row["component"]] = row
    sign = None
    for i, v in rows[:300]:
        whole = np.floor(np.array(v) * 64).astype(np.int64) + 1_000_000
        own_rows = by_row[i]
        assert own_rows[1]["deviation"] == sum((len(x) * int(a) - int(s)) ** 2 for a, s in zip(whole, sums, strict=True))
        wanted = ((whole - sums / len(x)) @ axes / np.sqrt(values))[:16]
        result = np.array([own_rows[k + 1]["whitened"] for k in range(16)])
        sign = np.sign(result * wanted) if sign is None else sign
        assert np.allclose(result, sign * wanted, atol=1e-8)


def test_small_and_empty_tables(spark):
    assert whitening.whiten(embeddings(spark, [])).collect() == []
    assert whitening.whiten(embeddings(spark, [(1, None)])).collect() == []
    assert whitening.whiten(embeddings(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []  # nothing varies
    got = whitening.whiten(embeddings(spark, [(1, [0.0, 5.0]), (2, [1.0, 5.0])])).collect()
    assert sorted((row["vec_id"], row["component"], abs(round(row["whitened"], 9))) for row in got) == [(1, 1, 1.0), (2, 1, 1.0)]
    with pytest.raises(ValueError, match="1 to 2 entries"):
        whitening.whiten(embeddings(spark, [(1, [0.0]), (2, [1.0, 5.0])]))


def test_sums_beyond_doubles_are_exact():
    x = np.array([[3 * 10**9 + 1, -7], [2, 10**8 + 1]], np.int64)
    assert whitening.products(x).tolist() == (x.astype(object).T @ x.astype(object)).tolist()
    model = whitening.Whitening(10**6, np.zeros(2, np.int64), [5, -5], np.eye(2), np.ones(2), 2.0)
    assert model.deviations(np.array([[3, 4]])) == [(3 * 10**6 - 5) ** 2 + (4 * 10**6 + 5) ** 2]
    assert model.deviations(x) == [None, None]


@pytest.mark.parametrize("size", [1, 2, 7, 64])
def test_components_of_random_matrices(size):
    a = np.random.default_rng(size).standard_normal((size, 2 * size))
    v = a @ a.T
    values, axes = whitening.leading_components(v, 16)
    assert np.allclose(values, np.linalg.eigvalsh(v)[::-1][:16], rtol=1e-12)
    assert np.abs(axes.T @ axes - np.eye(axes.shape[1])).max() < 1e-13
    assert np.abs(v @ axes - axes * values).max() < 1e-13 * size * np.linalg.norm(v)


def test_components_of_equal_and_tiny_eigenvalues():
    q = np.linalg.qr(np.random.default_rng(3).standard_normal((12, 12)))[0]
    for spectrum in ([5.0] * 12, [5.0] * 4 + [2.0] * 4 + [0.0] * 4, list(10.0 ** -np.arange(12)), [1.0] + [1e-14] * 11, [0.0] * 12):
        v = q @ np.diag(spectrum) @ q.T
        v = (v + v.T) / 2
        values, axes = whitening.leading_components(v, 12)
        assert np.allclose(values, spectrum, atol=1e-13)
        assert np.abs(axes.T @ axes - np.eye(12)).max() < 1e-13 and np.abs(v @ axes - axes * values).max() < 1e-13


def test_polar_factor():
    a = np.random.default_rng(4).standard_normal((20, 20))
    a = a + a.T
    u = whitening.polar_factor(a)
    values, axes = np.linalg.eigh(a)
    assert np.abs(u - axes @ np.diag(np.sign(values)) @ axes.T).max() < 1e-12
