"""Wide-and-deep and deep classifiers: gradients, steps, what only a hidden layer can learn."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from footfall.operators import regularization as path
from footfall.operators import wide_deep
from footfall.operators.metrics import evaluate

SCHEMA = "labels int, a double, b double, d double, is_eval boolean"
OPTIONS = wide_deep.DeepOptions(hidden=5, l2=0.1, tolerance=1e-5, seed=1)


def _rows(n=600):
    """The label is whether the signs of ``a`` and ``b`` differ; ``d`` never varies; some gaps."""
    rng = np.random.default_rng(7)
    a, b = rng.standard_normal(n), rng.standard_normal(n)
    y = ((a > 0) != (b > 0)) ^ (rng.random(n) < 0.05)
    return [
        (None if i % 50 == 7 else int(y[i]), None if i % 90 == 3 else float(a[i]), float(b[i]) * 40, 7.0, i % 4 == 0)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def inputs(spark):
    return path.prepare_inputs(spark.createDataFrame(_rows(), SCHEMA).repartition(3), ["a", "b", "d"], {})


@pytest.fixture(scope="module")
def model(inputs):
    return wide_deep.fit(inputs, OPTIONS)


@pytest.mark.parametrize("wide", [True, False])
def test_gradient_against_differences(wide):
    options = replace(OPTIONS, wide=wide)
    rng = np.random.default_rng(3)
    z, y = rng.standard_normal((40, 4)), rng.integers(0, 2, 40).astype(float)
    weights = rng.standard_normal(len(wide_deep._penalised(4, options)))
    _, gradient = wide_deep.loss_and_gradient(weights, z, y, options)
    for i in range(len(weights)):
        shift = np.zeros(len(weights))
        shift[i] = 1e-6
        up, down = (wide_deep.loss_and_gradient(weights + s, z, y, options)[0] for s in (shift, -shift))
        assert gradient[i] == pytest.approx((up - down) / 2e-6, rel=1e-5, abs=1e-5)


def test_log_falls_to_its_end(model, inputs):
    objectives = [e.objective for e in model.log]
    assert objectives == sorted(objectives, reverse=True) and len(objectives) > 5
    assert model.converged and model.log[-1].violation <= OPTIONS.tolerance
    rows = wide_deep.training_log([model]).collect()
    assert [r.iteration for r in rows] == list(range(len(model.log))) and all(r.converged for r in rows)
    report = evaluate(wide_deep.held_out(model, inputs)).first()
    n = inputs.rows.where("is_eval").count()
    assert report.log_loss == pytest.approx(model.log[-1].eval_loss / n, rel=1e-6)


def test_hidden_layer_learns_what_a_line_cannot(model, inputs):
    assert evaluate(wide_deep.held_out(model, inputs)).first().accuracy > 0.85
    line = path.fit_path(inputs, [1])[1]
    x = inputs.rows.where("is_eval").select("labels", path.probability(line, F.col("x")).alias("probability"))
    assert evaluate(x).first().accuracy < 0.65


def test_partitions_do_not_matter(spark, inputs, model):
    other = path.prepare_inputs(spark.createDataFrame(_rows(), SCHEMA).repartition(7), ["a", "b", "d"], {})
    again = wide_deep.fit(other, OPTIONS)
    assert again.log[-1].objective == pytest.approx(model.log[-1].objective, rel=1e-3)


def test_scores(spark, model, inputs):
    visitors = spark.createDataFrame([(1, 0.5, -20.0, 7.0, "x"), (2, None, 3.0, 9.0, None)], "id int, a double, b double, d double, probability string")
    scored = wide_deep.with_probability(model, inputs.prepare, visitors)
    assert scored.columns == ["id", "a", "b", "d", "probability"]
    rows = {r.id: r.probability for r in scored.collect()}
    z = (np.array([[0.5, -20.0, 7.0], [inputs.means[0], 3.0, 9.0]]) - model.means) * model.scale
    expected = 1 / (1 + np.exp(-wide_deep.logits(model.weights, z, OPTIONS)[0]))
    assert [rows[1], rows[2]] == pytest.approx(list(expected))
    none = wide_deep.probability(model, F.lit(None).cast("array<double>"))
    assert visitors.select(none.alias("p")).first().p is None


def test_no_rows(spark):
    empty = path.prepare_inputs(spark.createDataFrame([], SCHEMA), ["a", "b", "d"], {})
    model = wide_deep.fit(empty, OPTIONS)
    assert not model.converged and model.log == []
