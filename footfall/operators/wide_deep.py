"""Wide-and-deep and deep classifiers, trained by gradients summed over partitions.

The logit of a row is ``b + w.z + v.tanh(H z + c)``, z the scaled inputs: a linear part and a hidden
layer, fitted jointly. Without the linear part (``wide=False``) it is a network with one hidden layer. The
objective is the sum of the log losses plus half of ``l2`` times the sum of squared weights (biases left out).

A pass over the rows adds up loss, holdout loss and gradient per partition; partial sums
meet in a second stage, and vectors as long as the number of weights reach the driver. It takes L-BFGS steps from them: the last
``memory`` differences of weights and gradients stand in for the curvature, and a step is halved
until the objective falls, so the log is monotone. The fit ends when no entry of the gradient exceeds ``tolerance`` per
row. Start and order of sums aside, nothing is random; the weights start from ``seed``.

Defined cases: rows without label are left out by ``prepare_inputs``; inputs that never vary have no
influence; without training rows the weights stay at their start, marked as not converged.
"""

from __future__ import annotations

import time
from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.columns import LABEL
from footfall.operators.regularization import Inputs, _added, _inverse


@dataclass(frozen=True)
class DeepOptions:
    hidden: int = 16
    wide: bool = True
    l2: float = 1.0
    #: Largest entry of the gradient, per row, at which a fit has ended.
    tolerance: float = 1e-4
    #: A guard, not a way to end a fit; ``converged`` says if it was reached.
    max_passes: int = 300
    memory: int = 10
    seed: int = 0


@dataclass
class DeepLogEntry:
    iteration: int
    loss: float
    eval_loss: float
    objective: float
    violation: float
    seconds: float


@dataclass
class DeepModel:
    options: DeepOptions
    names: list[str]
    means: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    log: list[DeepLogEntry] = field(default_factory=list)
    converged: bool = False

    @property
    def model_type(self) -> str:
        return "wide_and_deep_classifier" if self.options.wide else "deep_classifier"


def _split(weights: np.ndarray, n: int, options: DeepOptions) -> tuple[np.ndarray, ...]:
    """Bias, linear weights, and the hidden layer's weights, biases and outgoing weights."""
    ends = np.cumsum([1, n if options.wide else 0, options.hidden * n, options.hidden])
    bias, linear, into, offsets, out = np.split(weights, ends)
    return bias, linear, into.reshape(options.hidden, n), offsets, out


def _penalised(n: int, options: DeepOptions) -> np.ndarray:
    """1 for weights, 0 for biases."""
    linear, into = n if options.wide else 0, options.hidden * n
    parts = [np.zeros(1), np.ones(linear + into), np.zeros(options.hidden), np.ones(options.hidden)]
    return np.concatenate(parts)


def logits(weights: np.ndarray, z: np.ndarray, options: DeepOptions) -> tuple[np.ndarray, np.ndarray]:
    """The logit of every row, and its hidden layer."""
    bias, linear, into, offsets, out = _split(weights, z.shape[1], options)
    layer = np.tanh(z @ into.T + offsets)
    wide = z @ linear if options.wide else 0.0
    return bias + wide + layer @ out, layer


def _losses(logit: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, logit) - y * logit


def loss_and_gradient(
    weights: np.ndarray, z: np.ndarray, y: np.ndarray, options: DeepOptions
) -> tuple[float, np.ndarray]:
    """Summed log loss of the rows and its gradient, without penalty."""
    *_, out = _split(weights, z.shape[1], options)
    logit, layer = logits(weights, z, options)
    error = 1 / (1 + np.exp(-np.clip(logit, -500, 500))) - y
    below = np.outer(error, out) * (1 - layer**2)
    linear = [error @ z] if options.wide else []
    parts = [[error.sum()], *linear, (below.T @ z).ravel(), below.sum(axis=0), error @ layer]
    return float(_losses(logit, y).sum()), np.concatenate(parts)


def fit(inputs: Inputs, options: DeepOptions = DeepOptions()) -> DeepModel:
    """The model of the training rows of ``inputs``."""
    n = len(inputs.names)
    means, scale = inputs.means, _inverse(inputs.deviations)
    penalised = _penalised(n, options) * options.l2
    rng = np.random.default_rng(options.seed)
    weights = rng.normal(0, 1 / np.sqrt(max(n, 1)), len(penalised))
    weights[: 1 + (n if options.wide else 0)] = 0.0
    model = DeepModel(options, list(inputs.names), means, scale, weights)

    def measure(at: np.ndarray) -> tuple[float, float, float, np.ndarray]:
        """Objective, loss, holdout loss and gradient: one pass."""

        def function(y: np.ndarray, x: np.ndarray, is_eval: np.ndarray) -> np.ndarray:
            z = (x - means) * scale
            held = float(_losses(logits(at, z[is_eval], options)[0], y[is_eval]).sum())
            loss, gradient = loss_and_gradient(at, z[~is_eval], y[~is_eval], options)
            return np.concatenate([[loss, held], gradient])

        found = np.broadcast_to(_added(inputs.rows, function), len(at) + 2)
        objective = float(found[0]) + float(penalised @ at**2) / 2
        return objective, float(found[0]), float(found[1]), found[2:] + penalised * at

    if not inputs.n:
        return model
    started, passes = time.monotonic(), 1
    objective, loss, held, gradient = measure(weights)
    pairs: deque[tuple[np.ndarray, np.ndarray]] = deque(maxlen=options.memory)
    while True:
        violation = float(np.abs(gradient).max()) / inputs.n
        seconds = time.monotonic() - started
        model.log.append(DeepLogEntry(len(model.log), loss, held, objective, violation, seconds))
        model.converged = violation <= options.tolerance
        if model.converged or passes >= options.max_passes:
            return model
        direction = _direction(gradient, pairs)
        slope = float(gradient @ direction)
        share = 1.0 if pairs else 1 / max(1.0, float(np.linalg.norm(gradient)))
        while passes < options.max_passes:
            trial = model.weights + share * direction
            measured = measure(trial)
            passes += 1
            if measured[0] <= objective + 1e-4 * share * slope:
                break
            share /= 2
        else:
            return model
        step, change = trial - model.weights, measured[3] - gradient
        # Curvature that isn't positive would spoil the directions to come.
        if step @ change > 1e-12 * (change @ change):
            pairs.append((step, change))
        model.weights = trial
        objective, loss, held, gradient = measured


def _direction(gradient: np.ndarray, pairs: deque) -> np.ndarray:
    """Downhill, by the inverse curvature that the last steps showed."""
    out, shares = -gradient, []
    for step, change in reversed(pairs):
        share = (step @ out) / (step @ change)
        shares.append(share)
        out = out - share * change
    if pairs:
        step, change = pairs[-1]
        out = out * ((step @ change) / (change @ change))
    for (step, change), share in zip(pairs, reversed(shares), strict=True):
        out = out + step * (share - (change @ out) / (step @ change))
    return out


def probability(model: DeepModel, x: Column) -> Column:
    """P(label = 1) of an array of inputs; NULL where it is NULL."""
    weights, means, scale, options = model.weights, model.means, model.scale, model.options

    @F.pandas_udf("double")
    def of_rows(rows: pd.Series) -> pd.Series:
        out = pd.Series(np.nan, index=rows.index, dtype="float64")
        known = rows.notna()
        if known.any():
            z = (np.stack(rows[known].to_list()) - means) * scale
            logit, _ = logits(weights, z, options)
            out[known] = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
        return out.where(known, None)

    return of_rows(x)


def with_probability(model: DeepModel, prepare: object, visitors: DataFrame) -> DataFrame:
    """``visitors`` with ``probability``."""
    vectors = prepare.transform(visitors)
    scored = vectors.withColumn("probability", probability(model, vector_to_array("features")))
    return scored.select(*[F.col(f"`{c}`") for c in visitors.columns if c != "probability"], "probability")


def held_out(model: DeepModel, inputs: Inputs) -> DataFrame:
    """Label and probability of the held-out rows, for ``metrics.evaluate``."""
    rows = inputs.rows.where("is_eval")
    return rows.select(LABEL, probability(model, F.col("x")).alias("probability"))


def training_log(models: list[DeepModel]) -> DataFrame:
    """One row per model and iteration: losses, objective, largest gradient entry per row, seconds."""
    rows = [
        (m.model_type, e.iteration, e.loss, e.eval_loss, e.objective, e.violation, e.seconds, m.converged)
        for m in models
        for e in m.log
    ]
    return SparkSession.active().createDataFrame(
        rows,
        "model_type string, iteration int, loss double, eval_loss double, objective double, "
        "violation double, seconds double, converged boolean",
    )
