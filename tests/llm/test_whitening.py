import math

import numpy as np
import pytest

from inkfold.llm import whitening
from inkfold.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x", 1.0) for i, v in vectors], "vec_id LONG, embedding ARRAY<DOUBLE>, id STRING, whitened DOUBLE")


def brute(vectors, k=4):
    """Per row (id, deviation) and per component (eigenvalue, explained, projections), by a plain eigenvalue decomposition."""
    kept = [(i, [math.floor(256 * c) + 0 for c in v]) for i, v in vectors if v and None not in v and np.isfinite(v).all()]
    distinct = np.array(sorted({tuple(x) for _, x in kept}))
    n, sums = len(distinct), [sum(int(v) for v in c) for c in distinct.T]
    centred = distinct - np.array([s / n for s in sums])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1].T
    far = [sum((n * int(a) - s) ** 2 for a, s in zip(x, sums)) for _, x in kept]
    along = (np.array([x for _, x in kept]) - np.array([s / n for s in sums])) @ axes[:k].T / np.sqrt(np.maximum(values[:k], 1e-300))
    return kept, n, far, values[:k], values[:k] / np.trace(covariance), along


def check(got, vectors, k=4):
    kept, n, far, values, explained, along = brute(vectors, k)
    k = min(k, sum(values > 1e-12 * values[0]))
    assert len(got) == len(kept) * k
    by_row = {}
    for r in got:
        by_row.setdefault(r.id, {}).setdefault(r.component, []).append(r)
    for c in range(k):
        ours = sorted((r.id is None, r.id or 0, int(r.deviation), r.whitened) for r in got if r.component == c + 1)
        want = sorted((i is None, i or 0, f, along[j, c]) for j, ((i, _), f) in enumerate(zip(kept, far)))
        sign = np.sign(sum(a[3] * b[3] for a, b in zip(ours, want)))
        assert [o[:3] for o in ours] == [w[:3] for w in want]
        assert np.allclose([o[3] for o in ours], [sign * w[3] for w in want], rtol=1e-7, atol=1e-7)
        assert all(abs(r.explained / explained[c] - 1) < 1e-9 and r.n == n for r in got if r.component == c + 1)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_against_plain_eigenvectors(spark):
    """Correlated entries; a third of all rows is one vector; null ids, repeated rows, broken vectors and one of another length."""
    random = np.random.default_rng(1)
    mixed = random.normal(size=(7, 7)) * [3, 2.5, 1, 0.5, 0.1, 2, 1]
    vectors = [(i, [0.5] * 7 if i % 3 == 0 else (random.normal(size=7) @ mixed).tolist()) for i in range(300)]
    vectors += [(7, vectors[7][1]), (None, vectors[8][1]), (None, vectors[8][1])]
    vectors += [(400, None), (401, [float("nan")] * 7), (402, [1.0] * 6 + [float("inf")]), (403, [1.0] * 6 + [None]), (404, [])]
    check(whitening.whiten(frame(spark, [*vectors, (405, [1.0, 2.0])])).collect(), vectors)


@pytest.mark.parametrize(
    "vectors", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.001])]]
)
def test_no_direction(spark, vectors):
    """The last two vectors are one vector of whole numbers."""
    assert whitening.whiten(frame(spark, vectors)).collect() == []


def test_fewer_directions_than_components(spark):
    vectors = [(i, [float(i), 2.0 * i, -1.0, 0.0, 5.0 * i]) for i in range(50)]
    found = whitening.whiten(frame(spark, vectors)).collect()
    assert {r.component for r in found} == {1} and abs(found[0].explained - 1) < 1e-9
    check(found, vectors)


def test_huge_entries(spark):
    """Products beyond the longs are held at the nearest one; deviations of more than 18 digits stay exact."""
    vectors = [(1, [1e40, 0.0]), (2, [-1e40, 1.0]), (3, [0.0, 0.0])]
    found = whitening.whiten(frame(spark, vectors)).collect()
    assert {r.component for r in found} == {1} and len(found) == 3 and all(r.deviation is None for r in found if r.id < 3)
    x = {1: (2**63 - 1, 0), 2: (-(2**63), 256), 3: (0, 0)}
    sums = [sum(v[j] for v in x.values()) for j in (0, 1)]
    for i, v in x.items():
        assert whitening.deviations(np.array([v]), 3, sums) == [sum((3 * a - s) ** 2 for a, s in zip(v, sums))]
    big = np.random.default_rng(3).integers(-300, 300, (20, 64))
    for n, sums in ((10**10, [10**12 * (j - 30) for j in range(64)]), (1000, list(range(64)))):
        assert whitening.deviations(big, n, sums) == [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in big]


@pytest.mark.parametrize("dim", [1, 2, 5, 8, 33])
def test_axes(dim):
    random = np.random.default_rng(dim)
    for rank in {dim, max(1, dim // 2)}:
        wide = random.normal(size=(dim, rank)) * np.logspace(0, -3, rank)
        matrix = wide @ wide.T
        factor, order = whitening.pivoted_cholesky(matrix)
        assert factor.shape[1] >= rank and np.allclose(factor @ factor.T, matrix[np.ix_(order, order)], atol=1e-13 * dim)
        assert np.allclose(np.triu(factor, 1), 0)
        values, axes = whitening.principal_axes(matrix)
        assert len(values) == rank and np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:rank], rtol=1e-8)
        assert np.allclose(axes @ axes.T, np.eye(rank), atol=1e-9) and np.allclose(axes.T * values @ axes, matrix, atol=1e-10)


def test_query(spark):
    found = QUERIES["op11_whitening"](spark, SF)
    assert found.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    vectors = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check(found.withColumnRenamed("vec_id", "id").collect(), vectors)


def test_sums_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 3)
    x = spark.createDataFrame([([i, i % 7, 1],) for i in range(500)], "x ARRAY<LONG>").repartition(20).checkpoint()
    found = whitening._totals(x, 3, lambda rows: (rows.T @ rows).ravel(), 9).reshape(3, 3)
    rows = np.array([[i, i % 7, 1] for i in range(500)], float)
    assert np.allclose(found, rows.T @ rows)
