"""Keep only the sessions inside each visitor's lookback window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.vocabulary import VISITOR

# Sessions of one visitor that share a join key.
ROWS_PER_KEY = 100_000


def within_window(sessions: DataFrame, visitors: DataFrame) -> DataFrame:
    """Sessions of kept visitors with ``visitStartTime`` inside the visitor's window.

    ``visitors`` has one row for every visitor of ``sessions``: ``kept``,
    ``front_lookback_window``, ``end_lookback_window`` and ``n_sessions``. It
    is read twice, so pass a materialised one.

    A visitor's sessions are dealt to as many salted copies of their window row as it
    takes to keep every join key near ``ROWS_PER_KEY`` sessions, so a visitor with any
    share of all sessions is spread in proportion. Those that need more than one
    salt are few, at most one in ``ROWS_PER_KEY`` of all sessions; the planner sees
    the size of their table and broadcasts it where it may.
    """
    salts = F.sequence(F.lit(0), F.greatest(_n_salts(), F.lit(1)) - 1)
    windows = visitors.where("kept").select(
        VISITOR, "front_lookback_window", "end_lookback_window", F.explode(salts).alias("salt")
    )
    start = F.timestamp_seconds("visitStartTime")
    return (
        salted(sessions, visitors)
        .join(windows, [VISITOR, "salt"])
        .where(start.between(F.col("front_lookback_window"), F.col("end_lookback_window")))
        .drop("salt", "front_lookback_window", "end_lookback_window")
    )


def _n_salts() -> Column:
    return F.ceil(F.col("n_sessions") / ROWS_PER_KEY).cast("int")


def salted(sessions: DataFrame, visitors: DataFrame) -> DataFrame:
    """Sessions with their ``salt``; those of split visitors that aren't kept are left out."""
    n_salts = _n_salts()
    several = visitors.where(n_salts > 1).select(
        VISITOR, n_salts.alias("n_salts"), F.col("kept").alias("several_kept")
    )
    spread = F.pmod(F.xxhash64(*sessions.columns), F.col("n_salts"))
    return (
        sessions.join(several, VISITOR, "left")
        .where("several_kept IS NULL OR several_kept")
        .withColumn("salt", F.coalesce(spread.cast("int"), F.lit(0)))
        .drop("several_kept", "n_salts")
    )
