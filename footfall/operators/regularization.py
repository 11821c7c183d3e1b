"""Logistic models for several L1 strengths at once, with proof that they are optimal.

``training.fit`` runs one fit after the other, each with passes of its own. Here a pass over the rows serves
every strength: each partition adds up loss, gradient and curvature at all current points, and
the sums of columns by columns reach the driver, which holds no rows. There, a step
solves the penalised quadratic model by coordinate descent. All strengths
start from the model of the strongest possible penalty, the base rate; strengths at or above
that penalty are done after one pass, and one that is done no longer takes part.

Curvature is computed for a strength's active set only: inputs with a weight, and those whose gradient
comes close to the penalty. The gradient is always computed for all, so that an input left
out wrongly enters at the next step.

The problem: sum of the log losses, plus strength times the sum of absolute weights of the scaled inputs
(zero mean, unit sample deviation; an input that never varies has no weight). A model is optimal if and only
if, with g the gradient of the loss,

- g = 0 for the intercept, g = -strength * sign(w) where a weight is not 0,
- |g| <= strength where it is 0.

``violation`` is the largest deviation from these per row; ``certificate`` computes it afresh, from the
rows and the weights alone, as one aggregate. Without penalty, rows that can be told apart perfectly have no best model:
the loss falls towards 0, and the fit ends when the conditions hold to the tolerance.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.columns import LABEL
from footfall.operators.training import (
    CATEGORIES,
    L1_STRENGTHS,
    NUMBERS,
    _name_and_category,
    feature_names,
    fit_preprocessing,
)
from footfall.sources.workspace import delete_folder, materialize


@dataclass(frozen=True)
class PathOptions:
    #: Largest violation per row at which a model counts as optimal.
    tolerance: float = 1e-9
    #: A guard, not a way to end a fit; ``converged`` says if it was reached.
    max_passes: int = 200
    #: Curvature added to every input, as a share of the mean one: keeps steps finite where
    #: inputs are collinear.
    damping: float = 1e-9
    #: Inputs whose gradient exceeds this share of the penalty get their curvature computed.
    near_penalty: float = 0.9


@dataclass
class LogEntry:
    iteration: int
    loss: float
    eval_loss: float | None
    objective: float
    violation: float
    active: int
    seconds: float


@dataclass
class PathModel:
    """One strength: weights in the units of the inputs, and the log of its training."""

    l1: float
    names: list[str]
    weights: np.ndarray
    intercept: float
    deviations: np.ndarray
    log: list[LogEntry] = field(default_factory=list)
    converged: bool = False


@dataclass
class Inputs:
    """Rows ready for passes: ``LABEL``, ``x`` (array), ``is_eval``; with the scale of ``x``."""

    rows: DataFrame
    prepare: object
    names: list[str]
    n: int
    positives: int
    means: np.ndarray
    deviations: np.ndarray
    #: Between the inputs, over the training rows; 0 where one never varies.
    correlations: np.ndarray


def prepare_inputs(
    labeled: DataFrame,
    numbers: Sequence[str] = NUMBERS,
    categories: dict[str, Sequence[str]] = CATEGORIES,
) -> Inputs:
    """Vectors of all rows, written once; means and deviations from the training rows.

    ``labeled`` has ``is_eval`` (see ``split``); rows without a label are left out.
    """
    labeled = labeled.where(F.col(LABEL).isNotNull())
    training = labeled.where("NOT is_eval")
    prepare = fit_preprocessing(training, numbers, categories)
    vectors = prepare.transform(labeled)
    names = feature_names(vectors)
    rows = vectors.select(
        F.col(LABEL).cast("double").alias(LABEL), vector_to_array("features").alias("x"), "is_eval"
    )
    rows = materialize(rows, "vectors")
    # Centred in two steps, so that large values lose no digits.
    n, positives, sums = _moments(rows, np.zeros(len(names)), 1)
    means = sums / max(n, 1)
    _, _, squares = _moments(rows, means, 2)
    deviations = np.sqrt(squares / max(n - 1, 1))
    # What rounding leaves of a constant is no variation.
    deviations[deviations < 1e-12 * np.maximum(1, np.abs(means))] = 0
    correlations = correlation_matrix(rows, means, deviations, n)
    return Inputs(rows, prepare, names, n, positives, means, deviations, correlations)


def correlation_matrix(rows: DataFrame, means: np.ndarray, deviations: np.ndarray, n: int) -> np.ndarray:
    """Correlations of the inputs over the training rows, by one pass."""
    scale = _inverse(deviations)

    def function(y: np.ndarray, x: np.ndarray, is_eval: np.ndarray) -> np.ndarray:
        z = (x[~is_eval] - means) * scale
        return (z.T @ z).ravel()

    total = np.broadcast_to(_added(rows, function), len(means) ** 2)
    return total.reshape(len(means), -1) / max(n - 1, 1)


def _added(rows: DataFrame, function) -> np.ndarray:
    """The sum over partitions of what ``function`` makes of labels, vectors and is_eval.

    Partial sums meet in a second stage of fewer tasks before they reach the driver.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                part = np.frombuffer(value.as_buffer())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = batch.column(0).to_numpy()
                x = np.asarray(batch.column(1).flatten()).reshape(len(y), -1)
                part = function(y, x, batch.column(2).to_numpy(zero_copy_only=False))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    partials = rows.mapInArrow(partial, "sums binary")
    groups = max(1, math.isqrt(rows.rdd.getNumPartitions()))
    found = partials.repartition(groups).mapInArrow(add, "sums binary").collect()
    return sum((np.frombuffer(r.sums) for r in found), np.zeros(1))


def _moments(rows: DataFrame, centre: np.ndarray, power: int) -> tuple[int, int, np.ndarray]:
    """Training rows, positives among them, and sums of powers of the centred inputs."""

    def function(y: np.ndarray, x: np.ndarray, is_eval: np.ndarray) -> np.ndarray:
        known = ~is_eval
        sums = ((x[known] - centre) ** power).sum(axis=0)
        return np.concatenate([[known.sum(), y[known].sum()], sums])

    total = np.broadcast_to(_added(rows, function), len(centre) + 2)
    return int(total[0]), int(total[1]), np.array(total[2:])


@dataclass
class _Point:
    """Scaled weights (intercept first), what a pass found there, and the step under way."""

    l1: float
    at: np.ndarray
    loss: float = math.inf
    eval_loss: float | None = None
    gradient: np.ndarray | None = None
    direction: np.ndarray | None = None
    expected: float = 0.0
    share: float = 1.0
    trial: np.ndarray | None = None
    log: list[LogEntry] = field(default_factory=list)
    done: bool = False

    def objective(self, loss: float, at: np.ndarray) -> float:
        return loss + self.l1 * float(np.abs(at[1:]).sum())


def _violations(gradient: np.ndarray, at: np.ndarray, l1: float) -> np.ndarray:
    """How far each entry is from the condition of an optimum; the intercept comes first."""
    inside = np.maximum(np.abs(gradient) - l1, 0)
    moved = np.abs(gradient + l1 * np.sign(at))
    found = np.where(at == 0, inside, moved)
    found[0] = abs(gradient[0])
    return found


def _pass(inputs: Inputs, points: list[np.ndarray], active: list[np.ndarray]) -> list[tuple]:
    """Loss, loss of the held-out rows, gradient, and curvature of the active entries, at each point."""
    means, scale, at = inputs.means, _inverse(inputs.deviations), np.stack(points, axis=1)
    width = len(inputs.names) + 1

    def function(y: np.ndarray, x: np.ndarray, is_eval: np.ndarray) -> np.ndarray:
        scaled = np.hstack([np.ones((len(y), 1)), (x - means) * scale])
        margins = scaled @ at
        losses = np.logaddexp(0, margins) - y[:, None] * margins
        known = ~is_eval
        held = np.concatenate([[is_eval.sum()], losses[is_eval].sum(axis=0)])
        z, chance = scaled[known], np.exp(-np.logaddexp(0, -margins[known]))
        away = chance - y[known, None]
        parts = [held, losses[known].sum(axis=0), (z.T @ away).T.ravel()]
        for k, mask in enumerate(active):
            zk = z[:, mask]
            parts.append((zk.T @ (zk * (chance[:, k] * (1 - chance[:, k]))[:, None])).ravel())
        return np.concatenate(parts)

    total = _added(inputs.rows, function)
    found, k = [], len(points)
    n_held, held, losses = total[0], total[1 : k + 1], total[k + 1 : 2 * k + 1]
    gradients = total[2 * k + 1 : 2 * k + 1 + k * width].reshape(k, width)
    start = 2 * k + 1 + k * width
    for i, mask in enumerate(active):
        size = int(mask.sum())
        curvature = total[start : start + size * size].reshape(size, size)
        start += size * size
        found.append((losses[i], held[i] / n_held if n_held else None, gradients[i], curvature))
    return found


def _inverse(deviations: np.ndarray) -> np.ndarray:
    return np.divide(1.0, deviations, out=np.zeros_like(deviations), where=deviations > 0)


def _active(point: np.ndarray, gradient: np.ndarray, l1: float, options: PathOptions, varies) -> np.ndarray:
    mask = (point != 0) | (np.abs(gradient) >= options.near_penalty * l1)
    mask[0] = True
    mask[1:] &= varies
    return mask


def _newton_direction(
    at: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, l1: float, damping: float
) -> np.ndarray:
    """The step to the least of the penalised quadratic model.

    By coordinate descent; without penalty the model is a plain quadratic one.
    """
    h = curvature + damping * max(np.trace(curvature) / len(at), 1e-300) * np.eye(len(at))
    if l1 == 0:
        return -np.linalg.lstsq(h, gradient, rcond=1e-12)[0]
    target, slope = at.copy(), gradient.copy()
    for _ in range(2000):
        largest = 0.0
        for j in range(len(at)):
            wanted = target[j] - slope[j] / h[j, j]
            if j:
                wanted = math.copysign(max(abs(wanted) - l1 / h[j, j], 0.0), wanted)
            change = wanted - target[j]
            if change:
                target[j] = wanted
                slope += change * h[:, j]
                largest = max(largest, abs(change) * h[j, j])
        if largest <= 1e-13 * max(1.0, np.abs(gradient).max()):
            break
    return target - at


def fit_path(
    inputs: Inputs,
    l1_strengths: Sequence[float] = L1_STRENGTHS,
    options: PathOptions = PathOptions(),
) -> dict[float, PathModel]:
    """One model per strength, all from the same passes."""
    width, varies = len(inputs.names) + 1, inputs.deviations > 0
    n, positives = inputs.n, inputs.positives
    if not 0 < positives < n:
        raise ValueError("training rows of both classes are needed")
    start = np.zeros(width)
    start[0] = math.log(positives / (n - positives))
    none = np.zeros(width, bool)
    none[0] = True
    points = [_Point(float(l1), start.copy(), trial=start.copy()) for l1 in l1_strengths]
    masks = [none] * len(points)
    for iteration in range(options.max_passes):
        open_ones = [i for i, p in enumerate(points) if not p.done]
        if not open_ones:
            break
        began = time.monotonic()
        found = _pass(inputs, [points[i].trial for i in open_ones], [masks[i] for i in open_ones])
        seconds = time.monotonic() - began
        for i, (loss, eval_loss, gradient, curvature) in zip(open_ones, found, strict=True):
            masks[i] = _advance(points[i], masks[i], loss, eval_loss, gradient, curvature, varies, options)
            point = points[i]
            violation = float(_violations(point.gradient, point.at, point.l1).max()) / n
            point.log.append(
                LogEntry(
                    iteration, point.loss / n, point.eval_loss, point.objective(point.loss, point.at) / n,
                    violation, int((point.at[1:] != 0).sum()), seconds,
                )
            )
            point.done = violation <= options.tolerance
    for point in points:
        _share_evenly(point.at, inputs.correlations)
    return {p.l1: _model(p, inputs) for p in points}


def _share_evenly(at: np.ndarray, correlations: np.ndarray) -> None:
    """Inputs that say the same (or the opposite) get the same weight, by size.

    Any way to share their common weight is as good to the penalised problem, so that of several
    best models this one is taken; no fit depends on the order of the columns.
    """
    same = np.abs(correlations) > 1 - 1e-10
    seen = np.zeros(len(same), bool)
    for i in range(len(same)):
        group = np.flatnonzero(same[i] & ~seen)
        seen[group] = True
        if len(group) > 1:
            signs = np.sign(correlations[i, group])
            at[1 + group] = signs * (signs @ at[1 + group]) / len(group)


def _advance(point, mask, loss, eval_loss, gradient, curvature, varies, options) -> np.ndarray:
    """Take the trial point if it is good enough, else a shorter step; the next trial's active set.

    The curvature of a pass belongs to the active set it was given; entries that become
    active only now get theirs at the next pass.
    """
    before = point.objective(point.loss, point.at) if point.gradient is not None else math.inf
    gain = before - point.objective(loss, point.trial)
    rounding = 1e-14 * max(1.0, abs(before)) if math.isfinite(before) else 0.0
    if gain < 1e-4 * point.share * point.expected - rounding and point.share > 1e-10:
        point.share /= 2
        point.trial = point.at + point.share * point.direction
        return mask
    point.at, point.loss, point.eval_loss, point.gradient = point.trial, loss, eval_loss, gradient
    wanted = _active(point.at, gradient, point.l1, options, varies)
    if (wanted & ~mask).any():
        # The same point once more, with the curvature of all that is active.
        point.trial, point.expected, point.share = point.at, 0.0, 1.0
        point.direction = np.zeros_like(point.at)
        return wanted
    h = np.zeros(len(point.at))
    step = _newton_direction(point.at[mask], gradient[mask], curvature, point.l1, options.damping)
    h[mask] = step
    point.direction, point.share = h, 1.0
    moved = point.l1 * (np.abs((point.at + h)[1:]).sum() - np.abs(point.at[1:]).sum())
    point.expected = -(float(gradient @ h) + float(moved))
    point.trial = point.at + h
    return _active(point.at, gradient, point.l1, options, varies) | mask


def _model(point: _Point, inputs: Inputs) -> PathModel:
    scaled = point.at[1:]
    weights = scaled * _inverse(inputs.deviations)
    intercept = float(point.at[0] - weights @ inputs.means)
    return PathModel(
        point.l1, inputs.names, weights, intercept, inputs.deviations, point.log, point.done
    )


# --- what a fit leaves: weights, log, certificate, probabilities -----------------


def certificate(models: Sequence[PathModel], inputs: Inputs) -> DataFrame:
    """Per strength and input (the intercept too): weight, gradient and violation, from the rows afresh.

    One pass for all models. Weights and gradients are those of scaled inputs; ``weight`` is
    0 or not as in the model, so ``violation`` (per row) of 0 proves it optimal.
    """
    points = []
    for model in models:
        scaled = model.weights * inputs.deviations
        points.append(np.concatenate([[model.intercept + model.weights @ inputs.means], scaled]))
    none = np.zeros(len(inputs.names) + 1, bool)
    found = _pass(inputs, points, [none] * len(points))
    rows = []
    for model, at, (_, _, gradient, _) in zip(models, points, found, strict=True):
        violations = _violations(gradient, at, model.l1) / inputs.n
        for name, w, g, v in zip(["__INTERCEPT__", *inputs.names], at, gradient, violations, strict=True):
            rows.append((float(model.l1), *_name_and_category(name), float(w), float(g), float(v)))
    return inputs.rows.sparkSession.createDataFrame(
        rows,
        "l1 double, processed_input string, category string, weight double, gradient double, violation double",
    )


def probability(model: PathModel, x: Column) -> Column:
    """P(label = 1) from the input array; only inputs with a weight are looked at."""
    terms = [x[i] * float(w) for i, w in enumerate(model.weights) if w]
    margin = sum(terms, F.lit(model.intercept))
    return 1 / (1 + F.exp(-margin))


def with_probability(model: PathModel, prepare, rows: DataFrame, name: str = "probability") -> DataFrame:
    """``rows`` with the model's probability; ``prepare`` as ``prepare_inputs`` found it."""
    vectors = prepare.transform(rows).withColumn("x", vector_to_array("features"))
    return vectors.withColumn(name, probability(model, F.col("x"))).select(*rows.columns, name)


def training_log(models: Sequence[PathModel]) -> DataFrame:
    """Per strength and pass: mean loss, loss of held-out rows, objective, violation, seconds."""
    rows = [
        (float(m.l1), e.iteration, float(e.loss), None if e.eval_loss is None else float(e.eval_loss),
         float(e.objective), e.violation, e.active, e.seconds, m.converged)
        for m in models
        for e in m.log
    ]
    return SparkSession.active().createDataFrame(
        rows,
        "l1 double, iteration int, loss double, eval_loss double, objective double, "
        "violation double, active int, seconds double, converged boolean",
    )


def weights_table(models: Sequence[PathModel], standardize: bool = True) -> DataFrame:
    """Weights of each model, largest first; ``standardize`` makes inputs comparable."""
    rows = []
    for m in models:
        shown = m.weights * m.deviations if standardize else m.weights
        rows += [(float(m.l1), *_name_and_category(n), float(w)) for n, w in zip(m.names, shown, strict=True)]
        rows.append((float(m.l1), "__INTERCEPT__", None, m.intercept))
    table = SparkSession.active().createDataFrame(
        rows, "l1 double, processed_input string, category string, weight double"
    )
    return table.orderBy("l1", F.desc("weight"), "processed_input", "category")


def save_path(models: Sequence[PathModel], path: str) -> None:
    """Write weights and logs to a new folder ``path``; one that fails leaves nothing behind."""
    spark = SparkSession.active()
    rows = [
        (float(m.l1), i, n, float(w), float(s), m.intercept)
        for m in models
        for i, (n, w, s) in enumerate(zip(m.names, m.weights, m.deviations, strict=True))
    ]
    try:
        spark.createDataFrame(
            rows, "l1 double, place int, name string, weight double, deviation double, intercept double"
        ).coalesce(1).write.parquet(f"{path}/weights")
        training_log(models).coalesce(1).write.parquet(f"{path}/log")
    except Exception:
        delete_folder(spark, path)
        raise


def load_path(spark: SparkSession, path: str) -> dict[float, PathModel]:
    models: dict[float, PathModel] = {}
    of_strength: dict[float, list] = {}
    for row in spark.read.parquet(f"{path}/weights").orderBy("l1", "place").collect():
        of_strength.setdefault(row.l1, []).append(row)
    for l1, rows in of_strength.items():
        columns = [np.array([r[c] for r in rows]) for c in ("weight", "deviation")]
        models[l1] = PathModel(l1, [r.name for r in rows], columns[0], rows[0].intercept, columns[1])
    for r in spark.read.parquet(f"{path}/log").orderBy("iteration").collect():
        models[r.l1].log.append(
            LogEntry(r.iteration, r.loss, r.eval_loss, r.objective, r.violation, r.active, r.seconds)
        )
        models[r.l1].converged = r.converged
    return models
