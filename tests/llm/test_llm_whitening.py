"""Whitening against numpy, with close and equal eigenvalues, bad vectors and odd tables."""

import math

import numpy as np
import pytest

from tidemark.llm import whitening
from tidemark.llm.eigen import leading_pairs, leading_values, tridiagonal


def matrix_of(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return (q * np.array(values)) @ q.T


SPECTRA = {
    "apart": [100.0 / (i + 1) ** 2 for i in range(40)],
    "equal": [5.0] * 12 + [1.0] * 20,
    "close": [3.0 + 1e-9 * i for i in range(10)] + [1.0, 0.0, -2.0],
    "negative": [-1.0, -2.0, -3.0, -4.0],
    "wide": [10.0 ** (8 - 2 * i) for i in range(12)],
    "zero": [0.0] * 6,
}


@pytest.mark.parametrize("name", SPECTRA)
def test_leading_pairs(name):
    matrix = matrix_of(SPECTRA[name], 4)
    matrix = (matrix + matrix.T) / 2
    values, vectors = leading_pairs(matrix, 8)
    k, norm = min(8, len(matrix)), max(1e-200, np.abs(SPECTRA[name]).max())
    assert np.allclose(values, np.sort(np.linalg.eigvalsh(matrix))[::-1][:k], atol=1e-13 * norm * len(matrix))
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() < 1e-12 * norm * len(matrix)


@pytest.mark.parametrize("n", [1, 2, 3])
def test_small_and_diagonal_matrices(n):
    values, vectors = leading_pairs(np.diag(np.arange(1.0, n + 1)), 8)
    assert np.allclose(values, np.arange(n, 0, -1)) and np.allclose(np.abs(vectors), np.eye(n)[::-1])


def test_tridiagonal_form_has_the_same_values():
    matrix = matrix_of(SPECTRA["apart"], 8)
    diagonal, off, _ = tridiagonal(matrix)
    full = np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)
    assert np.allclose(np.linalg.eigvalsh(full), np.linalg.eigvalsh(matrix))
    assert np.allclose(leading_values(diagonal, off, 40), np.sort(SPECTRA["apart"])[::-1])


def check(rows, out, size):
    """Against numpy, up to the sign of a component."""
    good = [(i, v) for i, v in rows if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024.0 * float(c)) + 100000 for c in v] for _, v in good], object)
    n, sums = len(x), x.sum(axis=0)
    centred = (x * n - sums).astype(float) / n
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    white = centred @ vectors / np.sqrt(values)
    table = out.collect()
    assert len(table) == n * len(values)
    by_component = {}
    for r in table:
        by_component.setdefault(r["component"], {})[r["vec_id"]] = r
        assert r["n"] == n and r["identity_error"] < 1e-9
    for k in range(len(values)):
        found = by_component[k + 1]
        mine = np.array([found[i]["whitened"] for i, _ in good])
        assert np.allclose(mine, white[:, k], atol=1e-6) or np.allclose(mine, -white[:, k], atol=1e-6)
        assert abs(found[good[0][0]]["explained"] - values[k] / np.trace(covariance)) < 1e-9
    for (i, _), gaps in zip(good, x * n - sums):
        assert by_component[1][i]["deviation"] == int((gaps * gaps).sum())


def test_embeddings(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    vectors = [(r["vec_id"], r["embedding"]) for r in rows.collect()]
    check(vectors, whitening.op12_embedding_whitening(spark, folder), 64)


def test_odd_table(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(c) for c in draw.normal(size=9) * np.arange(1, 10)]) for i in range(40)]
    rows += [(100, None), (101, []), (102, [1.0, 2.0]), (103, [None] * 9), (104, [float("nan")] * 9)]
    rows += [(105, [float("inf")] + [0.0] * 8), (106, [0.0] * 9), (107, rows[3][1]), (108, rows[3][1])]
    frame = spark.createDataFrame([(i, v, "w", 1) for i, v in rows], "vec_id long, embedding array<double>, whitened string, n int")
    check(rows, whitening.components_of(frame.repartition(3)), 9)


def test_ids_may_be_missing_or_repeat(spark):
    rows = [(1, [0.5, 1.0]), (1, [0.7, -1.0]), (None, [0.1, 0.3])]
    out = whitening.components_of(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((str(r["vec_id"]), r["component"]) for r in out) == sorted([("1", 1), ("1", 2)] * 2 + [("None", 1), ("None", 2)])


def test_huge_entries_stay_exact(spark):
    rows = [(i, [2.0**40 * (i % 3), 1e300 if i % 2 else -1e300]) for i in range(6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = whitening.components_of(frame).collect()
    assert len(out) == 12 and all(r["deviation"] is None and r["identity_error"] < 1e-6 for r in out)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    out = whitening.components_of(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 0
