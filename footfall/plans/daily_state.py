"""Feature tables of any date range from stored daily states.

A state is what a visitor's sessions of one day add to the feature table: extrema, sums
and bit words, all of which merge. Each day of sessions is read once, when it arrives;
feature tables of any range, training and holdout windows among them, come from the states, which hold
one short row per visitor, country and day whatever the number of sessions and hits.

A late session means computing its day again: writing replaces the days written and no
others. Days without a state have no sessions. Visitors and countries without a name have
no state. Only a table with ``lookback_filter`` needs the sessions themselves, since a window's border
lies inside a day.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.columns import USER_COLUMNS
from footfall.functions.flags import fold_session_words, fold_words
from footfall.operators import engagement, habits, labels
from footfall.params import FeatureParams
from footfall.plans.feature_table import (
    SUMMED,
    behaviour_columns,
    had_visit,
    kept,
    prepared,
    with_windows,
)
from footfall.sources.sessions import SESSION_SCHEMA, write_by_day
from footfall.vocabulary import INDICATORS, VISITOR

DAY = "table_suffix"
COUNTRY = "country"


def visitor_days(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """States of the days from ``session_start`` to ``session_end``, all countries.

    Of ``params`` the days and the rule of local time count.
    """
    country = F.col("geoNetwork.country")
    known = sessions.where(
        F.col(DAY).between(params.session_start, params.session_end)
        & country.isNotNull()
        & F.col(VISITOR).isNotNull()
    )
    return (
        prepared(known, params)
        .groupBy(DAY, country.alias(COUNTRY), VISITOR)
        .agg(
            had_visit(),
            *labels.label_aggregates(),
            *[F.sum(f"totals.{c}").alias(c) for c in SUMMED],
            *fold_words(INDICATORS),
            *habits.weekday_aggregates(),
            *habits.daypart_aggregates(),
        )
    )


def write_visitor_days(states: DataFrame, path: str) -> None:
    """Write states as one folder per day; only the days they hold are replaced."""
    write_by_day(states, path)


def read_visitor_days(spark: SparkSession, path: str) -> DataFrame:
    """The states below ``path``; the day stays a string."""
    none = spark.createDataFrame([], SESSION_SCHEMA)
    return spark.read.schema(visitor_days(none, FeatureParams()).schema).parquet(path)


def _merged() -> list[Column]:
    """The aggregates of ``visitor_days`` over their own results."""
    return [
        F.bool_or("had_visit").alias("had_visit"),
        *labels.merged_labels(),
        *engagement.engagement_aggregates(),
        *fold_session_words(INDICATORS),
        *habits.merged_weekdays(),
        *habits.merged_dayparts(),
    ]


def features_of_windows(
    states: DataFrame, windows: Mapping[str, FeatureParams], name: str = "window_name"
) -> DataFrame:
    """The feature tables of all windows in one scan and one shuffle, told apart by ``name``.

    Windows may overlap and may be of several countries; a state goes to every window
    it lies in. They report one lookback, and none may filter by it.
    """
    if not windows:
        raise ValueError("no windows")
    if any(p.lookback_filter for p in windows.values()):
        raise ValueError("lookback_filter needs the sessions: use feature_table")
    if len({p.lookback_days for p in windows.values()}) > 1:
        raise ValueError("all windows have to report the same lookback_days")
    inside = {
        label: F.col(DAY).between(p.session_start, p.session_end) & (F.col(COUNTRY) == p.country)
        for label, p in windows.items()
    }
    mine = F.array_compact(F.array(*[F.when(test, F.lit(label)) for label, test in inside.items()]))
    rows = (
        # Days and countries reach the scan as partition and pushed filters.
        states.where(reduce(Column.__or__, inside.values()))
        .withColumn("totals", F.struct(*SUMMED))
        .withColumn(name, F.explode(mine))
    )
    folded = rows.groupBy(name, VISITOR).agg(*_merged())
    any_window = next(iter(windows.values()))
    return with_windows(folded.where(kept()), any_window).select(name, *USER_COLUMNS, *behaviour_columns())


def feature_table_from_days(states: DataFrame, params: FeatureParams) -> DataFrame:
    """What ``feature_table`` gives for the sessions the states are of."""
    return features_of_windows(states, {"": params}).drop("window_name")
