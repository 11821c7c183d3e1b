import math

import numpy as np
import pytest

from footfall.llm import whitening
from footfall.llm.queries import op12_embedding_whitening

SCHEMA = "vec_id long, embedding array<float>"


def _plain(vectors, k=4):
    """Whitening by a dense eigensolver; ``vectors`` are whole numbers."""
    fit = np.array(sorted({tuple(v) for v in vectors}), dtype=float)
    mean = fit.mean(axis=0)
    values, basis = np.linalg.eigh((fit - mean).T @ (fit - mean) / len(fit))
    values, basis = values[::-1][:k], basis[:, ::-1][:, :k]
    return len(fit), values, (np.array(vectors, float) - mean) @ basis / np.sqrt(values)


def _table(spark, vectors):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], SCHEMA)


def test_query_like_a_dense_solver(spark):
    folder = "/root/testdata/sf0.001"
    rows = op12_embedding_whitening(spark, folder).collect()
    read = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    whole = [[math.floor(256 * float(c)) for c in r.embedding] for r in read]
    n, values, white = _plain(whole)
    sums = [sum(v[i] for v in {tuple(w) for w in whole}) for i in range(len(whole[0]))]
    trace = np.var(np.array(sorted({tuple(w) for w in whole}), float), axis=0).sum()
    at = {r.vec_id: i for i, r in enumerate(read)}
    assert len(rows) == 4 * len(read)
    signs = {}
    for r in rows:
        i, expected = at[r.vec_id], white[at[r.vec_id], r.component - 1]
        sign = signs.setdefault(r.component, math.copysign(1, r.whitened * expected))
        assert r.whitened == pytest.approx(sign * expected, abs=1e-9)
        assert r.n == n
        assert r.deviation == sum((n * x - s) ** 2 for x, s in zip(whole[i], sums))
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-10)
        assert 0 <= r.identity_error < 1e-10


def test_filter_needs_several_cycles(spark):
    """More dimensions than block columns, eigenvalues close together, copies that count once."""
    rng = np.random.default_rng(4)
    vectors = (rng.standard_normal((300, 40)) * np.linspace(1.2, 1, 40)).tolist()
    params = whitening.WhiteningParams(block=10)
    table = _table(spark, vectors + vectors[:50] * 3)
    model, fit_list = whitening.fit(whitening.usable_rows(table, "embedding", params), params)
    whole = np.floor(256 * np.array(vectors, dtype=np.float32).astype(float)).tolist()
    n, values, _ = _plain(whole)
    assert model.n == n == 300 and model.passes > 20
    assert model.eigenvalues == pytest.approx(values, rel=1e-12)
    assert model.residuals.max() < 1e-12
    assert whitening.identity_error(model, fit_list) < 1e-10


def test_filter_damps_what_lies_below():
    operator = np.diag([10.0, 9, 2, 1, 0.5, 0])
    block = np.ones((6, 1))
    done = whitening.chebyshev_filter(lambda x: operator @ x, block, operator @ block, 2.0, 10.0, 8)[:, 0]
    assert done[0] == pytest.approx(1) and abs(done[2:]).max() < 1e-4 < done[1]


def test_vectors_that_take_no_part(spark):
    good = [[1.0, 2.0, 0.5], [0.0, 1.0, 3.0], [2.0, 2.0, 2.0], [1.0, 0.0, 0.0]]
    bad = [None, [], [1.0, None, 2.0], [1.0, float("nan"), 2.0], [float("inf"), 0.0, 0.0], [1.0, 2.0]]
    table = _table(spark, good + bad + good[:1]).withColumnRenamed("vec_id", "row")
    rows = whitening.whiten(table.selectExpr("row", "embedding", "row AS n", "row AS x"), "embedding").collect()
    _, _, white = _plain([[math.floor(256 * c) for c in v] for v in good])
    assert {r.row.row for r in rows} == {0, 1, 2, 3, 10} and len(rows) == 5 * 3
    first = {r.component: r.whitened for r in rows if r.row.row == 0}
    assert first == {r.component: r.whitened for r in rows if r.row.row == 10}
    assert [abs(first[j]) for j in (1, 2, 3)] == pytest.approx(abs(white[0, :3]), abs=1e-9)


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3])
def test_nothing_to_whiten(spark, vectors):
    assert whitening.whiten(_table(spark, vectors), "embedding").collect() == []


def test_constant_and_dependent_dimensions_have_no_components(spark):
    rng = np.random.default_rng(1)
    vectors = [[float(a), 3.0, float(2 * a), float(b)] for a, b in rng.integers(-9, 9, (50, 2))]
    rows = whitening.whiten(_table(spark, vectors), "embedding").collect()
    assert {r.component for r in rows} == {1, 2}
    assert sum(r.explained for r in rows if r.row.vec_id == 0) == pytest.approx(1)


def test_deviation_beyond_a_long_is_null():
    model = whitening.Whitening(
        10, *[np.array([v], dtype=object) for v in (0, -(2**40), 2**40)],
        np.ones(1), np.ones((1, 1)), 1.0, np.zeros(1), 1,
    )
    assert whitening._deviations(model, np.array([[3], [2**40]])) == [900, None]
