"""Connected components of a graph whose edges are rows.

Large-star and small-star steps in turn: each step links the neighbours of a node
to the smallest of them, until every component is a star around its smallest
node. Nothing is ever gathered per node: a step is a minimum by group, which
combines before the shuffle, and a join the planner can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.sources.workspace import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("low"))
    return (
        both.join(low, F.col("u") == F.col("at"))
        .where("v > u")
        .select(F.col("v").alias("u"), F.least("u", "low").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """``u`` is the larger end of every edge that comes in."""
    low = edges.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("low"))
    moved = (
        edges.join(low, F.col("u") == F.col("at"))
        .where("v != low")
        .select(F.col("v").alias("u"), F.col("low").alias("v"))
    )
    return moved.unionAll(low.select("at", "low")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node) of every node of ``edges`` (``u``, ``v``).

    Loops and repeated edges do no harm. A node that is the smallest of its
    component has no row of its own; nor has one without edges.
    """
    ordered = edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges = materialize(ordered.distinct(), "edges")
    before = _state(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)), "edges")
        now = _state(edges)
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
