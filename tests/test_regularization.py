"""The path of L1 models: optimal at every strength, one answer whatever the order of columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.operators import correlation
from footfall.operators import regularization as path

SCHEMA = "labels int, a double, b double, c double, d double, e double, is_eval boolean"
COLUMNS = list("abcde")


def _rows(n=300, seed=2):
    """``b`` repeats ``a`` with the other sign, ``d`` never varies, ``e`` has gaps."""
    rng = np.random.default_rng(seed)
    a, c = rng.standard_normal(n) * 3 + 1, rng.integers(0, 2, n)
    y = rng.random(n) < 1 / (1 + np.exp(-(0.8 * a - 1.5 * c)))
    e = [None if x > 1 else float(x) for x in rng.standard_normal(n)]
    return [
        (int(y[i]), float(a[i]), float(-2 * a[i]), float(c[i]), 7.0, e[i], bool(i % 5 == 0)) for i in range(n)
    ]


@pytest.fixture(scope="module")
def inputs(spark):
    return path.prepare_inputs(spark.createDataFrame(_rows(), SCHEMA).repartition(3), COLUMNS, {})


@pytest.fixture(scope="module")
def models(inputs):
    return path.fit_path(inputs, [0, 1, 10, 50, 100, 1000])


def _objective(rows, weights, intercept, l1, spread):
    total = 0.0
    for y, *x, is_eval in rows:
        if not is_eval:
            margin = intercept + float(np.dot(weights, x))
            total += np.logaddexp(0, margin) - y * margin
    return total + l1 * float(np.abs(weights * spread).sum())


def test_every_strength_is_proven_optimal(models, inputs):
    checked = path.certificate(list(models.values()), inputs)
    worst = {r.l1: r.v for r in checked.groupBy("l1").agg(F.max("violation").alias("v")).collect()}
    assert set(worst) == {0, 1, 10, 50, 100, 1000} and max(worst.values()) < 1e-8
    assert all(m.converged for m in models.values())
    assert [sum(m.weights != 0) for m in models.values()][-1] == 0


def test_no_neighbour_is_better(models, inputs):
    means = {c: np.mean([r[i + 1] for r in _rows() if not r[-1] and r[i + 1] is not None]) for i, c in enumerate(COLUMNS)}
    rows = [(r[0], *[means[c] if v is None else v for c, v in zip(COLUMNS, r[1:6])], r[6]) for r in _rows()]
    rng = np.random.default_rng(0)
    for l1, m in models.items():
        best = _objective(rows, m.weights, m.intercept, l1, m.deviations)
        assert best / inputs.n == pytest.approx(m.log[-1].objective, rel=1e-9)
        for size in (1e-1, 1e-3):
            moved = m.weights + size * rng.standard_normal(5) * (m.deviations > 0)
            assert _objective(rows, moved, m.intercept + size * rng.standard_normal(), l1, m.deviations) > best


def test_log_falls_and_ends_at_the_holdout_loss(models):
    for m in models.values():
        falls = [e.objective for e in m.log]
        assert all(x >= y - 1e-12 for x, y in zip(falls, falls[1:]))
        assert m.log[-1].eval_loss is not None and m.log[-1].violation <= 1e-9


def test_inputs_that_say_the_same_share_their_weight(models, inputs):
    for m in models.values():
        scaled = m.weights * inputs.deviations
        assert scaled[0] == pytest.approx(-scaled[1], abs=1e-9) and scaled[3] == 0


def test_saved_and_loaded(spark, models, tmp_path):
    path.save_path(list(models.values()), f"{tmp_path}/model")
    loaded = path.load_path(spark, f"{tmp_path}/model")
    assert set(loaded) == set(models)
    for l1, m in models.items():
        assert (loaded[l1].weights == m.weights).all() and loaded[l1].intercept == m.intercept
        assert len(loaded[l1].log) == len(m.log) and loaded[l1].converged


def test_perfectly_parted_rows_end_by_the_tolerance(spark):
    rows = [(int(i > 10), float(i), 0.0, 0.0, 0.0, 0.0, False) for i in range(21)]
    model = path.fit_path(path.prepare_inputs(spark.createDataFrame(rows, SCHEMA), ["a"], {}), [0])[0.0]
    assert model.converged and model.log[-1].loss < 1e-6 and model.log[-1].eval_loss is None


def test_one_class_is_refused(spark):
    rows = [(1, float(i), 0.0, 0.0, 0.0, 0.0, False) for i in range(5)]
    with pytest.raises(ValueError, match="both classes"):
        path.fit_path(path.prepare_inputs(spark.createDataFrame(rows, SCHEMA), ["a"], {}))


def test_collinearity_against_regressions(inputs):
    left = correlation.tolerances(inputs.correlations)
    assert left[0] == left[1] == 0 and np.isnan(left[3])
    x = np.array([r.x for r in inputs.rows.where("NOT is_eval").collect()])
    for i, others in ((2, [0, 4]), (4, [0, 2])):
        design = np.hstack([np.ones((len(x), 1)), x[:, others]])
        rest = x[:, i] - design @ np.linalg.lstsq(design, x[:, i], rcond=None)[0]
        assert left[i] == pytest.approx((rest**2).sum() / ((x[:, i] - x[:, i].mean()) ** 2).sum(), abs=1e-9)
    assert correlation.singular_groups(inputs.correlations) == [[0, 1]]
    assert np.isinf(correlation.condition_indices(inputs.correlations)[-1])
    order = correlation.clustered_order(inputs.correlations)
    assert sorted(order) == list(range(5)) and abs(order.index(0) - order.index(1)) == 1 and order[-1] == 3
