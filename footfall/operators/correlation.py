"""Pairwise correlation of the model inputs, to spot collinear ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame

from footfall.operators.regularization import Inputs
from footfall.operators.training import (
    CATEGORIES,
    NUMBERS,
    _name_and_category,
    feature_names,
    fit_preprocessing,
)


def feature_correlation(
    features: DataFrame,
    numbers: Sequence[str] = NUMBERS,
    categories: Mapping[str, Sequence[str]] = CATEGORIES,
) -> DataFrame:
    """Pearson correlation of each pair of model inputs, as rows of a heat map.

    The inputs are the entries of the vector a model is trained on: numbers, with the
    mean for NULL, and one 0/1 entry per weekday and daypart (``day=Monday``). An
    entry that never varies, one without any value included, has no correlation.
    Only the matrix of entries by entries reaches the driver.
    """
    vectors = fit_preprocessing(features, numbers, categories).transform(features)
    names = feature_names(vectors)
    matrix = Correlation.corr(vectors.select("features"), "features").first()[0].toArray()
    rows = [
        (a, b, None if matrix[i, j] != matrix[i, j] else float(matrix[i, j]))
        for i, a in enumerate(names)
        for j, b in enumerate(names)
        if i < j
    ]
    return features.sparkSession.createDataFrame(
        rows, "feature_a string, feature_b string, correlation double"
    )


# Below this an eigenvalue, or what the others leave of an input, is rounding.
SINGULAR = 1e-8


def tolerances(correlations: np.ndarray) -> np.ndarray:
    """What the others leave of each input: ``1 - R^2`` of its regression on all of them.

    1 / tolerance is the variance inflation factor. 0 for members of a singular group, which the others
    fix exactly; NaN for inputs that never vary. The inverse is taken where there is one: an
    input that no exact relation touches has its tolerance from the pseudo-inverse.
    """
    varies = np.diag(correlations) > 0.5
    found = np.full(len(correlations), np.nan)
    if varies.any():
        values, vectors = np.linalg.eigh(correlations[np.ix_(varies, varies)])
        fixed = values < SINGULAR
        tied = (vectors[:, fixed] ** 2).sum(axis=1) > SINGULAR
        inverse = ((vectors[:, ~fixed] ** 2) / values[~fixed]).sum(axis=1)
        found[varies] = np.where(tied, 0.0, 1 / inverse)
    return found


def singular_groups(correlations: np.ndarray) -> list[list[int]]:
    """Inputs tied by exact linear relations, those that share one together."""
    varies = np.flatnonzero(np.diag(correlations) > 0.5)
    if not len(varies):
        return []
    values, vectors = np.linalg.eigh(correlations[np.ix_(varies, varies)])
    null = vectors[:, values < SINGULAR]
    # The projection on the relations: two inputs that none connects have a 0.
    linked = np.abs(null @ null.T) > SINGULAR
    groups, seen = [], set()
    for i in range(len(varies)):
        if i in seen or not linked[i, i]:
            continue
        group, open_ones = {i}, [i]
        while open_ones:
            for j in np.flatnonzero(linked[open_ones.pop()]):
                if j not in group:
                    group.add(int(j))
                    open_ones.append(int(j))
        seen |= group
        groups.append(sorted(int(varies[j]) for j in group))
    return groups


def condition_indices(correlations: np.ndarray) -> np.ndarray:
    """Square roots of the largest eigenvalue over each, rising; infinite for exact relations."""
    varies = np.diag(correlations) > 0.5
    values = np.linalg.eigvalsh(correlations[np.ix_(varies, varies)])[::-1]
    return np.array([np.sqrt(values[0] / v) if v >= SINGULAR else np.inf for v in values])


def clustered_order(correlations: np.ndarray) -> list[int]:
    """An order of the inputs that puts correlated ones side by side, for the heat map.

    Average linkage on ``1 - |r|``; inputs that never vary come last.
    """
    varies = [int(i) for i in np.flatnonzero(np.diag(correlations) > 0.5)]
    clusters = [[i] for i in varies]
    apart = 1 - np.abs(correlations[np.ix_(varies, varies)])
    np.fill_diagonal(apart, np.inf)
    sizes = [1.0] * len(clusters)
    alive = list(range(len(clusters)))
    while len(alive) > 1:
        part = apart[np.ix_(alive, alive)]
        a, b = np.unravel_index(part.argmin(), part.shape)
        a, b = sorted((alive[a], alive[b]))
        joined = (sizes[a] * apart[a] + sizes[b] * apart[b]) / (sizes[a] + sizes[b])
        apart[a], apart[:, a] = joined, joined
        apart[a, a] = np.inf
        clusters[a] += clusters[b]
        sizes[a] += sizes[b]
        alive.remove(b)
    ordered = clusters[alive[0]] if alive else []
    return ordered + [i for i in range(len(correlations)) if i not in set(varies)]


def collinearity(inputs: Inputs) -> DataFrame:
    """Per model input: tolerance, variance inflation factor, its singular group, place in the heat map.

    From the matrix of inputs by inputs alone (training rows). ``vif`` is NULL for inputs that never vary
    (so is ``tolerance``) and for members of a ``singular_group``, numbered from 1.
    """
    left = tolerances(inputs.correlations)
    groups = {i: k + 1 for k, g in enumerate(singular_groups(inputs.correlations)) for i in g}
    places = {i: k for k, i in enumerate(clustered_order(inputs.correlations))}
    rows = [
        (
            *_name_and_category(name),
            None if np.isnan(left[i]) else float(left[i]),
            float(1 / left[i]) if left[i] > 0 else None,
            groups.get(i),
            places[i],
        )
        for i, name in enumerate(inputs.names)
    ]
    return inputs.rows.sparkSession.createDataFrame(
        rows,
        "processed_input string, category string, tolerance double, vif double, singular_group int, place int",
    )
