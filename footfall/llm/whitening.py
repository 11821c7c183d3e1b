"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance matrix is never formed. A pass multiplies it with a block of vectors: every
partition centres its rows and adds up ``Xc' (Xc Q)``, partial sums meet in a second,
smaller stage, and only a matrix of dimensions by block columns reaches the driver, which
holds the small dense algebra (QR, Rayleigh-Ritz) and no rows.

A cycle applies a Chebyshev polynomial of the covariance to the block, by the three-term
recurrence, one pass per degree. The polynomial stays below 1 on the unwanted part of the
spectrum, from 0 (a covariance has no negative eigenvalues) to the block's smallest Ritz value, and
grows fastest above it. QR and Rayleigh-Ritz then turn the block to approximate
eigenvectors. Cycles go on until every wanted pair is certified: the residual
``|V q - e q|`` at most ``tolerance`` times the largest eigenvalue. Rounding sets the floor:
residuals that no longer fall are accepted below ``rounding``; above it the block is widened,
up to all dimensions, where Rayleigh-Ritz alone is exact.

The fit takes every distinct vector once. Entries are whole numbers (``floor(256 * c)``), so
count, sums and ``deviation`` are exact.

Defined results: a vector that is NULL, or holds NULL, NaN or an infinity, is left out, as is one
of another length than the most frequent one (of equally frequent ones the longest), and one
with an entry beyond 2^40 once scaled. Repeated rows
come back once each. Components without variance (one distinct vector, constant or
dependent dimensions) have no rows. Where eigenvalues tie, the vectors are one orthonormal choice among
many, the same for all rows. ``deviation`` is NULL where it leaves the range of a long. An empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.sources.workspace import materialize

LARGEST_ENTRY = 1 << 40
LONG_MAX = (1 << 63) - 1


@dataclass(frozen=True)
class WhiteningParams:
    components: int = 4
    scale: int = 256
    #: Columns of the first block; the more, the fewer cycles.
    block: int = 32
    degree: int = 10
    tolerance: float = 2e-14
    #: Residuals that have stopped falling are due to rounding if below this.
    rounding: float = 1e-11
    max_cycles: int = 60
    #: Eigenvalues up to this share of the largest count as no variance.
    no_variance: float = 1e-12
    seed: int = 12


@dataclass
class Whitening:
    """What ``fit`` knows: enough to whiten any row."""

    n: int
    sums: np.ndarray
    lowest: np.ndarray
    highest: np.ndarray
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float
    #: Residual of each component, over the largest eigenvalue.
    residuals: np.ndarray
    passes: int

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace


def whole_entries(vector: Column, scale: int) -> Column:
    """``floor(scale * c)`` per entry, NULL for a vector that can't be used."""
    scaled = F.transform(vector, lambda c: F.lit(float(scale)) * c.cast("double"))
    # NaN compares as larger than every number.
    usable = F.forall(scaled, lambda c: c.isNotNull() & (F.abs(c) < float(LARGEST_ENTRY)))
    return F.when(usable, F.transform(scaled, lambda c: F.floor(c)))


def usable_rows(rows: DataFrame, vector: str, params: WhiteningParams) -> DataFrame:
    """``row`` (all columns) and ``x`` of the rows with a vector that takes part."""
    own = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    whole = rows.select(own.alias("row"), whole_entries(F.col(f"`{vector}`"), params.scale).alias("x"))
    whole = materialize(whole.where("x IS NOT NULL AND size(x) > 0"), "vectors")
    length = (
        whole.groupBy(F.size("x").alias("d"))
        .count()
        .orderBy(F.desc("count"), F.desc("d"))
        .select("d")
        .first()
    )
    return whole.where(F.size("x") == (length.d if length else 0))


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    """The ``x`` of a batch as whole numbers, one row each."""
    x = batch.column(batch.schema.get_field_index("x"))
    return np.asarray(x.flatten(), dtype=np.int64).reshape(-1, dimensions)


def _groups(partials: DataFrame) -> int:
    """Tasks of the second stage of a sum: the square root of those of the first."""
    return max(1, math.isqrt(partials.rdd.getNumPartitions()))


def _tree_sum(partials: DataFrame, groups: int) -> np.ndarray:
    """The sum of the arrays of doubles in ``partials``, of which there is one at least.

    Two stages, so that no more than ``groups`` arrays reach the driver.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for value in batch.column(0):
                part = np.frombuffer(value.as_buffer())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    rows = partials.repartition(groups).mapInArrow(add, "sums binary").collect()
    return sum(np.frombuffer(r.sums) for r in rows)


class _Covariance:
    """Products of the covariance of ``fit_list`` with blocks of vectors, counted."""

    def __init__(self, fit_list: DataFrame, n: int, mean: np.ndarray):
        self.fit_list, self.n, self.mean, self.passes = fit_list, n, mean, 0
        self.groups = _groups(fit_list)

    def _summed(self, width: int, function) -> np.ndarray:
        mean, dimensions = self.mean, len(self.mean)

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((dimensions, width))
            for batch in batches:
                if batch.num_rows:
                    total += function(_matrix(batch, dimensions) - mean)
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

        self.passes += 1
        total = _tree_sum(self.fit_list.mapInArrow(partial, "sums binary"), self.groups)
        return total.reshape(dimensions, width) / self.n

    def times(self, block: np.ndarray) -> np.ndarray:
        return self._summed(block.shape[1], lambda centred: centred.T @ (centred @ block))

    def variances(self) -> np.ndarray:
        return self._summed(1, lambda centred: (centred * centred).sum(axis=0)[:, None])[:, 0]


def _rayleigh_ritz(
    covariance: _Covariance, block: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), Ritz vectors, and the covariance times these."""
    basis, _ = np.linalg.qr(block)
    product = covariance.times(basis)
    small = basis.T @ product
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1]
    turn = turn[:, order]
    return values[order], basis @ turn, product @ turn


def chebyshev_filter(
    times, block: np.ndarray, product: np.ndarray, upper: float, largest: float, degree: int
) -> np.ndarray:
    """A scaled Chebyshev polynomial of the operator applied to ``block``.

    At most 1 in size on [0, ``upper``], equal to 1 at ``largest``, so nothing overflows.
    ``product`` is the operator times ``block``, which saves the first pass.
    """
    half = centre = upper / 2
    ratio = first = half / (largest - centre)
    before, now = block, (product - centre * block) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - ratio)
        after = (times(now) - centre * now) * (2 * following / half) - (ratio * following) * before
        before, now, ratio = now, after, following
    return now


def subspace_iteration(
    covariance: _Covariance, params: WhiteningParams
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues, eigenvectors and relative residuals of the leading components."""
    dimensions = len(covariance.mean)
    wanted = min(params.components, dimensions)
    rng = np.random.default_rng(params.seed)
    width = min(dimensions, max(params.block, 2 * wanted))
    values, vectors, product = _rayleigh_ritz(covariance, rng.standard_normal((dimensions, width)))
    best = math.inf
    for cycle in range(params.max_cycles + 1):
        errors = np.linalg.norm(product - vectors * values, axis=0)[:wanted]
        residuals = errors / values[0] if values[0] > 0 else errors
        worst = residuals.max()
        stopped = worst > best / 2 and cycle > 0
        if worst <= params.tolerance or width == dimensions or (stopped and best <= params.rounding):
            break
        if cycle >= params.max_cycles or values[width - 1] <= 0:
            # Too close together to part, or nothing left below: all dimensions at once.
            fill = rng.standard_normal((dimensions, dimensions - width))
            block, width = np.hstack([vectors, fill]), dimensions
        else:
            block = chebyshev_filter(
                covariance.times, vectors, product, values[width - 1], values[0], params.degree
            )
        best = min(best, worst)
        values, vectors, product = _rayleigh_ritz(covariance, block)
    return values[:wanted], vectors[:, :wanted], residuals


def fit(vectors: DataFrame, params: WhiteningParams = WhiteningParams()) -> tuple[Whitening, DataFrame] | None:
    """The whitening of the distinct ``x`` of ``vectors``, and these; None if there are none."""
    fit_list = materialize(vectors.select("x").distinct(), "fit-list")
    per_dimension = (
        fit_list.select(F.posexplode("x").alias("i", "v"))
        .groupBy("i")
        .agg(F.count("*").alias("n"), F.sum("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .orderBy("i")
        .collect()
    )
    if not per_dimension:
        return None
    n = per_dimension[0].n
    sums, low, high = (np.array([r[c] for r in per_dimension], dtype=object) for c in ("s", "lo", "hi"))
    mean = sums.astype(float) / n
    covariance = _Covariance(fit_list, n, mean)
    trace = float(covariance.variances().sum())
    if trace <= 0:
        values, basis, residuals = np.zeros(0), np.zeros((len(mean), 0)), np.zeros(0)
    else:
        values, basis, residuals = subspace_iteration(covariance, params)
        varies = values > params.no_variance * values[0]
        values, basis, residuals = values[varies], basis[:, varies], residuals[varies]
    return (
        Whitening(n, sums, low, high, values, basis, trace, residuals, covariance.passes),
        fit_list,
    )


def _whitened(model: Whitening, x: np.ndarray) -> np.ndarray:
    mean = model.sums.astype(float) / model.n
    return ((x - mean) @ model.vectors) / np.sqrt(model.eigenvalues)


def identity_error(model: Whitening, fit_list: DataFrame) -> float:
    """Largest entry, by size, of the covariance of the whitened fit list minus the identity."""
    k, dimensions = len(model.eigenvalues), model.dimensions

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                white = _whitened(model, _matrix(batch, dimensions))
                total += np.vstack([white.T @ white, white.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    sums = _tree_sum(fit_list.mapInArrow(partial, "sums binary"), _groups(fit_list))
    total = sums.reshape(k + 1, k) / model.n
    covariance = total[:k] - np.outer(total[k], total[k])
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(model: Whitening, x: np.ndarray) -> list:
    """Sum over dimensions of ``(n x - S)^2``, exact; None beyond a long."""
    n = model.n
    furthest = [max(abs(n * h - s), abs(n * lo - s)) for lo, h, s in zip(model.lowest, model.highest, model.sums)]
    if sum(f * f for f in furthest) <= LONG_MAX:
        away = n * x - model.sums.astype(np.int64)
        return (away * away).sum(axis=1).tolist()
    away = n * x.astype(object) - model.sums
    exact = (away * away).sum(axis=1)
    return [int(v) if v <= LONG_MAX else None for v in exact]


WHITENED = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(rows: DataFrame, vector: str, params: WhiteningParams = WhiteningParams()) -> DataFrame:
    """One row per usable row and component: ``row`` (the input columns) and ``WHITENED``."""
    usable = usable_rows(rows, vector, params)
    fitted = fit(usable, params)
    schema = f"row {usable.schema['row'].dataType.simpleString()}, {WHITENED}"
    if fitted is None or not len(fitted[0].eigenvalues):
        return rows.sparkSession.createDataFrame([], schema)
    model, fit_list = fitted
    error, explained = identity_error(model, fit_list), model.explained()
    k, dimensions = len(model.eigenvalues), model.dimensions

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, dimensions)
            white = _whitened(model, x)
            rows_here, deviations = batch.column(batch.schema.get_field_index("row")), _deviations(model, x)
            for j in range(k):
                m = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        rows_here,
                        pa.array(np.full(m, j + 1, dtype=np.int32)),
                        pa.array(np.full(m, model.n, dtype=np.int64)),
                        pa.array(deviations, pa.int64()),
                        pa.array(white[:, j]),
                        pa.array(np.full(m, explained[j])),
                        pa.array(np.full(m, error)),
                    ],
                    ["row", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return usable.mapInArrow(project, schema)
