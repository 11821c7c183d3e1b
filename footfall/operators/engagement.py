"""Time on site per visit and per page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.params import FeatureParams
from footfall.sources.sessions import select_sessions
from footfall.vocabulary import VISITOR


def engagement_aggregates() -> list[Column]:
    """Ratios of sums; NULL instead of an error where the divisor is zero.

    Sessions without a time still add their pages to the divisor.
    """
    seconds = F.sum("totals.timeOnSite")
    return [
        F.try_divide(seconds, F.sum("totals.visits")).alias("timeOnSite_per_visit"),
        F.try_divide(seconds, F.sum("totals.pageviews")).alias("timeOnSite_per_page"),
    ]


def summary_metrics(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """Both ratios per visitor, bounces included."""
    return select_sessions(sessions, params).groupBy(VISITOR).agg(*engagement_aggregates())
