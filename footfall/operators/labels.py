"""Who bought, when, and over which window their behaviour counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.columns import USER_COLUMNS
from footfall.params import FeatureParams
from footfall.sources.sessions import select_sessions
from footfall.vocabulary import VISITOR


def is_visit() -> Column:
    """Sessions that count for labels: all but bounces."""
    return F.col("totals.bounces").isNull()


def label_aggregates() -> list[Column]:
    """Label, first visit and conversion, last visit and conversion.

    Bounces are left out inside the aggregates, so the same list serves a pass
    that also reads bounces for other features. The first three and the
    epoch-second maxima stay plain longs until after the aggregation.
    """
    visit = is_visit()
    sale = visit & (F.col("totals.transactions") >= 1)
    start = F.col("visitStartTime")
    return [
        F.max(F.when(sale, 1).otherwise(0)).alias("labels"),
        F.min(F.when(visit, start)).alias("first_visit"),
        F.min(F.when(sale, start)).alias("first_conversion_session"),
        F.max(F.when(sale, start)).alias("last_conversion"),
        F.max(F.when(visit, start)).alias("last_visit"),
    ]


def merged_labels() -> list[Column]:
    """Aggregates: the results of ``label_aggregates`` over parts, put together."""
    least = ("first_visit", "first_conversion_session")
    most = ("labels", "last_conversion", "last_visit")
    return [*[F.max(c).alias(c) for c in most], *[F.min(c).alias(c) for c in least]]


def users_labeled(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """One row per visitor with at least one session that is not a bounce."""
    visits = select_sessions(sessions, params).where(is_visit())
    return with_timestamps(visits.groupBy(VISITOR).agg(*label_aggregates()))


def with_timestamps(labeled: DataFrame) -> DataFrame:
    return labeled.withColumns(
        {
            "last_conversion_timestamp": F.timestamp_seconds("last_conversion"),
            "last_visit_timestamp": F.timestamp_seconds("last_visit"),
        }
    ).drop("last_conversion", "last_visit")


def anchor_timestamp(labeled: DataFrame) -> DataFrame:
    """Add ``last_timestamp``: last conversion of buyers, last visit of others."""
    return labeled.withColumn(
        "last_timestamp",
        F.when(F.col("labels") == 1, F.col("last_conversion_timestamp")).otherwise(
            F.col("last_visit_timestamp")
        ),
    )


def lookback_window(anchored: DataFrame, params: FeatureParams) -> DataFrame:
    """Add the window of ``lookback_days`` (of 24 hours) that ends at the anchor.

    By microseconds: subtracting an interval counts days on the session's own
    calendar, which may skip or repeat an hour.
    """
    days = F.lit(params.lookback_days * 86_400_000_000).cast("bigint")
    return anchored.withColumns(
        {
            "front_lookback_window": F.timestamp_micros(F.unix_micros("last_timestamp") - days),
            "end_lookback_window": F.col("last_timestamp"),
        }
    )


def bought_later_or_never() -> Column:
    """False for buyers whose first visit already converted.

    Without a conversion time there is nothing to compare: that holds for all
    non-buyers, so one predicate covers both classes.
    """
    return F.col("first_conversion_session").isNull() | (
        F.col("first_visit") < F.col("first_conversion_session")
    )


def filtered_users(labeled: DataFrame, params: FeatureParams) -> DataFrame:
    """The visitors of the feature table with their windows."""
    kept = labeled.where(bought_later_or_never())
    return lookback_window(anchor_timestamp(kept), params).select(*USER_COLUMNS)
