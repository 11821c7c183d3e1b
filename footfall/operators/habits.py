"""Favourite weekday and local daypart: where most page views fell.

A visitor has at most eight buckets of each kind (seven names and the unknown
one), so the sums per bucket are plain columns of one aggregation and the
favourite is picked from them in the row. No second shuffle, no window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.params import FeatureParams
from footfall.sources.lookup import state_lookup, zone_lookup
from footfall.sources.sessions import select_sessions
from footfall.vocabulary import VISITOR, WEEKDAYS


def with_local_hour(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """Add ``hour_of_day_localized``; NULL for regions outside the lookup.

    The lookup is a literal of the parameters, 54 rows, hence the broadcast.
    """
    if params.zones is not None:
        zones = F.broadcast(zone_lookup(sessions.sparkSession, params.zones))
        hour = clock.hour_in_zone(F.col("visitStartTime"), F.col("zone"))
        return (
            sessions.join(zones, F.col("geoNetwork.region") == F.col("state_name"), "left")
            .withColumn("hour_of_day_localized", hour)
            .drop("state_name", "zone")
        )
    states = F.broadcast(state_lookup(sessions.sparkSession, params.states))
    offset = clock.utc_offset(F.col("date"), F.col("timezone"), F.col("dst"), params.dst_ranges)
    return (
        sessions.join(states, F.col("geoNetwork.region") == F.col("state_name"), "left")
        .withColumn("hour_of_day_localized", clock.local_hour(F.col("visitStartTime"), offset))
        .drop("state_name", "timezone", "dst")
    )


def with_weekday_bucket(sessions: DataFrame) -> DataFrame:
    """Add the weekday as position in ``WEEKDAYS``; one past the end is unknown."""
    number = clock.weekday_number(F.col("date")) - 1
    return sessions.withColumn("weekday_bucket", F.coalesce(number, F.lit(len(WEEKDAYS))))


def with_daypart_bucket(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """Add the local daypart as position in ``DAYPART_NAMES``; one past the end is unknown."""
    number = clock.daypart_number(F.col("hour_of_day_localized"))
    return with_local_hour(sessions, params).withColumn(
        "daypart_bucket", F.coalesce(number, F.lit(len(clock.DAYPART_NAMES)))
    )


def _bucket_aggregates(kind: str, names: Sequence[str]) -> list[Column]:
    """Views per bucket, and a mask of the buckets seen.

    The mask is needed because a bucket without a known view count still
    competes, and wins if it is the only one.
    """
    views = [
        F.expr(f"sum(if({kind}_bucket = {i}, totals.pageviews, NULL)) AS {kind}_views_{i}")
        for i in range(len(names) + 1)
    ]
    return [F.expr(f"bit_or(shiftleft(1, {kind}_bucket)) AS {kind}_seen"), *views]


def _merged_buckets(kind: str, names: Sequence[str]) -> list[Column]:
    views = [f"{kind}_views_{i}" for i in range(len(names) + 1)]
    return [F.bit_or(f"{kind}_seen").alias(f"{kind}_seen"), *[F.sum(v).alias(v) for v in views]]


def _favourite(kind: str, names: Sequence[str]) -> Column:
    """Name of the bucket with most views; ties go to the earlier bucket.

    Structs compare field by field with NULL lowest, and array_max skips the
    buckets that were never seen. The unknown bucket comes last and is NULL.
    """
    candidates = ", ".join(
        f"if({kind}_seen & {1 << i} != 0, struct({kind}_views_{i} AS views, -{i} AS place), NULL)"
        for i in range(len(names) + 1)
    )
    return F.get(F.lit(list(names)), F.expr(f"-array_max(array({candidates})).place"))


def weekday_aggregates() -> list[Column]:
    """Needs ``weekday_bucket``."""
    return _bucket_aggregates("weekday", WEEKDAYS)


def daypart_aggregates() -> list[Column]:
    """Needs ``daypart_bucket``."""
    return _bucket_aggregates("daypart", clock.DAYPART_NAMES)


def merged_weekdays() -> list[Column]:
    """The results of ``weekday_aggregates`` over parts, put together."""
    return _merged_buckets("weekday", WEEKDAYS)


def merged_dayparts() -> list[Column]:
    """The results of ``daypart_aggregates`` over parts, put together."""
    return _merged_buckets("daypart", clock.DAYPART_NAMES)


def favourite_weekday() -> Column:
    return _favourite("weekday", WEEKDAYS).alias("day")


def favourite_daypart() -> Column:
    return _favourite("daypart", clock.DAYPART_NAMES).alias("daypart")


def pageviews_by_day(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """Page views per visitor and weekday number."""
    return (
        select_sessions(sessions, params)
        .groupBy(VISITOR, clock.weekday_number(F.col("date")).alias("day"))
        .agg(F.sum("totals.pageviews").alias("pages_viewed"))
    )


def pageviews_by_daypart(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """Page views per visitor and local daypart."""
    part = clock.daypart_name(clock.daypart_number(F.col("hour_of_day_localized")))
    return (
        with_local_hour(select_sessions(sessions, params), params)
        .groupBy(VISITOR, part.alias("daypart"))
        .agg(F.sum("totals.pageviews").alias("pageviews"))
    )


def visitor_day(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """Each visitor's favourite weekday."""
    buckets = with_weekday_bucket(select_sessions(sessions, params))
    return buckets.groupBy(VISITOR).agg(*weekday_aggregates()).select(VISITOR, favourite_weekday())


def visitor_daypart(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """Each visitor's favourite local daypart."""
    buckets = with_daypart_bucket(select_sessions(sessions, params), params)
    return buckets.groupBy(VISITOR).agg(*daypart_aggregates()).select(VISITOR, favourite_daypart())
