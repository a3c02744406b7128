"""Whitening against an eigendecomposition of the whole covariance matrix."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tests.conftest import SF
from ticketmill.llm import queries, whitening


def levelled(vectors):
    rows = [v for v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [[math.floor(256 * c) for c in v] for v in rows]


def plain_fit(rows, k):
    """(n, sums, eigenvalues, unit eigenvectors as rows, trace) of the distinct rows."""
    x = np.array(sorted({tuple(r) for r in rows}), float)
    c = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(c.T @ c / len(x))
    return len(x), x.sum(axis=0), values[::-1][:k], vectors.T[::-1][:k], values.sum()


def test_query_equals_a_whole_decomposition(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = {r["vec_id"]: r["embedding"] for r in table}
    ids = [i for i, v in rows.items() if levelled([v])]
    x = np.array(levelled(rows[i] for i in ids))
    n, sums, values, vectors, trace = plain_fit(x.tolist(), 4)
    found = queries.QUERIES["op13_embedding_whitening"](spark, SF).collect()
    assert len(found) == 4 * len(ids)
    y = {c: np.array([next(iter([r["whitened"]])) for r in found if r["component"] == c]) for c in range(1, 5)}
    order = [r["vec_id"] for r in found if r["component"] == 1]
    at = [ids.index(i) for i in order]
    wanted = (x[at] - sums / n) @ vectors.T / np.sqrt(values)
    for c in range(1, 5):
        sign = np.sign(y[c] @ wanted[:, c - 1])
        assert np.abs(sign * y[c] - wanted[:, c - 1]).max() < 1e-8
    for r in found[:50]:
        own = x[ids.index(r["vec_id"])].tolist()
        assert r["n"] == n
        assert r["deviation"] == sum((n * a - int(s)) ** 2 for a, s in zip(own, sums.tolist()))
        assert abs(r["explained"] - values[r["component"] - 1] / trace) < 1e-10
        assert 0 <= r["identity_error"] < 1e-8


def test_odd_vectors_and_clashing_columns(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [[0.5, 1.0, -2.0], [0.5, 1.0, -2.0], [1.5, 0.0, 0.25], [-0.7, 2.0, 1.0], [3.0, 1.0, 1.0]]
    rows = [(i, v, "a", 7) for i, v in enumerate(vectors)]
    rows += [(None, vectors[2], "a", 7)]
    rows += [(9, None, "a", 7), (9, [1.0, None, 2.0], "a", 7), (9, [inf, 1.0, 1.0], "a", 7), (9, [nan, 1.0, 1.0], "a", 7),
             (9, [], "a", 7), (9, [1.0], "a", 7)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, x string, n int")
    model = whitening.fit(table, 2)
    n, sums, values, _, trace = plain_fit(levelled(vectors), 2)
    assert (model.n, model.sums) == (n, sums.astype(int).tolist())
    assert np.allclose(model.variances, values, rtol=1e-10) and np.allclose(model.explained, values / trace)
    found = whitening.whiten(table, model).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"]) for r in found if r["vec_id"] is not None) == [(False, i) for i in range(5)]
    assert {(r["x"], r["n"]) for r in found} == {("a", 7)} and len(found) == 6
    same = [r["whitened"] for r in found if r["vec_id"] in (0, 1)]
    assert same[0] == same[1]
    third = next(r for r in found if r["vec_id"] == 2)
    own = levelled([vectors[2]])[0]
    assert third["deviation"] == sum((n * Fraction(a) - int(s)) ** 2 for a, s in zip(own, sums.tolist()))
    none = whitening.fit(table.filter("false"), 2)
    assert whitening.whiten(table, none).collect() == []
    equal = whitening.fit(table.filter("vec_id < 2"), 2)
    assert [r["whitened"] for r in whitening.whiten(table.filter("vec_id < 2"), equal).collect()] == [[], []]


@pytest.mark.parametrize("case", ["generic", "repeated", "low rank", "one direction"])
def test_bidiagonal_matrix_has_the_singular_values(case):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((40, 12))
    if case == "repeated":
        u, _, v = np.linalg.svd(x, full_matrices=False)
        x = u @ np.diag([5, 5, 5, 2, 2, 1, 1, 1, 1, 1, 1, 1.0]) @ v
    if case == "low rank":
        x = x[:, :3] @ rng.standard_normal((3, 12))
    if case == "one direction":
        x = np.outer(x[:, 0], np.eye(12)[4])

    def product(p, w):
        u = x @ p
        return u @ u, x.T @ u, (x @ w.T).T @ u

    right, b = whitening.bidiagonalise(product, 12, 1e-13 * np.linalg.norm(x))
    assert np.abs(right.T @ right - np.eye(12)).max() < 1e-12
    values = np.linalg.svd(x, compute_uv=False)
    _, found, turned = np.linalg.svd(b)
    assert np.allclose(found, values, atol=1e-10 * values[0])
    top = (right @ turned.T)[:, 0]
    assert abs(np.linalg.norm(x @ top) - values[0]) < 1e-9 * values[0]
