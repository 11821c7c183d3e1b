"""The visitor feature table in one scan and one shuffle.

All stages read the same sessions and group by the same key, so their
aggregates run side by side in a single aggregation. Partial aggregation folds
a visitor's sessions to one row per task before the shuffle, however many
sessions the visitor has.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.columns import CORRECT_NAMES, NOT_FOR_TRAINING, RATIOS, USER_COLUMNS
from footfall.functions.flags import (
    fold_session_words,
    fold_words,
    session_words,
    unpack_words,
    with_page_levels,
)
from footfall.operators import engagement, habits, labels
from footfall.operators.lookback import within_window
from footfall.params import FeatureParams
from footfall.sources.sessions import select_sessions
from footfall.sources.workspace import materialize
from footfall.vocabulary import INDICATORS, VISITOR

# Fields of the totals that the behaviour aggregates sum.
SUMMED = ("visits", "pageviews", "timeOnSite")


def feature_table(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """One row per visitor: label, windows, ratios, indicators, habits."""
    base = select_sessions(sessions, params)
    if params.lookback_filter:
        return _inside_windows(base, params)
    folded = (
        prepared(base, params)
        .groupBy(VISITOR)
        .agg(had_visit(), *labels.label_aggregates(), *_behaviour_aggregates(fold_words(INDICATORS)))
    )
    windows = with_windows(folded.where(kept()), params)
    return windows.select(*USER_COLUMNS, *behaviour_columns())


def _inside_windows(base: DataFrame, params: FeatureParams) -> DataFrame:
    """The variant that counts only sessions inside the visitor's window.

    Sessions are packed before they join their windows: the shuffle carries words,
    bucket numbers and three numbers to sum, rows of one size whatever the hits.
    """
    labeled = base.groupBy(VISITOR).agg(
        had_visit(), F.count("*").alias("n_sessions"), *labels.label_aggregates()
    )
    visitors = with_windows(labeled, params).select(
        *USER_COLUMNS, "n_sessions", kept().alias("kept")
    )
    visitors = materialize(visitors, "windows")
    packed = prepared(base, params).select(
        VISITOR,
        "visitStartTime",
        *session_words(INDICATORS),
        "weekday_bucket",
        "daypart_bucket",
        *[F.col(f"totals.{c}") for c in SUMMED],
    )
    behaviour = (
        within_window(packed, visitors)
        .withColumn("totals", F.struct(*SUMMED))
        .groupBy(VISITOR)
        .agg(*_behaviour_aggregates(fold_session_words(INDICATORS)))
        .select(VISITOR, *behaviour_columns())
    )
    return visitors.where("kept").select(*USER_COLUMNS).join(behaviour, VISITOR, "left")


def kept() -> Column:
    return F.col("had_visit") & labels.bought_later_or_never()


def with_windows(labeled: DataFrame, params: FeatureParams) -> DataFrame:
    return labels.lookback_window(labels.anchor_timestamp(labels.with_timestamps(labeled)), params)


def prepared(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """Sessions with everything the behaviour aggregates read, computed once per row."""
    local = habits.with_daypart_bucket(sessions, params)
    return with_page_levels(habits.with_weekday_bucket(local))


def had_visit() -> Column:
    return F.bool_or(labels.is_visit()).alias("had_visit")


def _behaviour_aggregates(words: list[Column]) -> list[Column]:
    return [
        *engagement.engagement_aggregates(),
        *words,
        *habits.weekday_aggregates(),
        *habits.daypart_aggregates(),
    ]


def behaviour_columns() -> list[Column]:
    return [
        *[F.col(c) for c in RATIOS],
        *unpack_words(INDICATORS),
        habits.favourite_weekday(),
        habits.favourite_daypart(),
    ]


def with_names(features: DataFrame, names: Mapping[str, str] = CORRECT_NAMES) -> DataFrame:
    """Columns renamed; by default the misspelt ones are put right."""
    return features.withColumnsRenamed(dict(names))


def training_projection(features: DataFrame) -> DataFrame:
    """Label and model inputs only."""
    return features.drop(*NOT_FOR_TRAINING)
