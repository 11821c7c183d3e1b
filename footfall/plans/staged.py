"""The same feature table built stage by stage.

Every stage scans the sessions on its own and the results are joined on the
visitor. Slower than the one-pass plan by construction; tests and the
benchmark hold the two against each other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.operators import engagement, habits, labels
from footfall.params import FeatureParams
from footfall.sources.sessions import select_sessions
from footfall.vocabulary import INDICATORS, VISITOR, Indicator


def top_per_visitor(sums: DataFrame, views: str, bucket: str) -> DataFrame:
    """The bucket with most views: first row of a window, ties to the earlier bucket."""
    order = Window.partitionBy(VISITOR).orderBy(F.desc_nulls_last(views), F.asc_nulls_last(bucket))
    numbered = sums.withColumn("row_num", F.row_number().over(order))
    return numbered.where("row_num = 1").select(VISITOR, bucket)


def _flag(ind: Indicator) -> F.Column:
    value = ind.field.replace("hits.", "hit.")
    return F.max(F.when(F.col(value) == ind.literal, 1).otherwise(0)).alias(ind.column)


def flags_by_hit(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """Indicators over unnested hits, one conditional maximum each."""
    hits = select_sessions(sessions, params).withColumn("hit", F.explode("hits"))
    return hits.groupBy(VISITOR).agg(*[_flag(ind) for ind in INDICATORS])


def feature_table_staged(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    by_day = habits.pageviews_by_day(sessions, params)
    by_part = habits.pageviews_by_daypart(sessions, params)
    day = top_per_visitor(by_day, "pages_viewed", "day")
    stages = [
        labels.filtered_users(labels.users_labeled(sessions, params), params),
        engagement.summary_metrics(sessions, params),
        flags_by_hit(sessions, params),
        day.select(VISITOR, clock.weekday_name(F.col("day")).alias("day")),
        top_per_visitor(by_part, "pageviews", "daypart"),
    ]
    return reduce(lambda left, right: left.join(right, VISITOR, "left"), stages)
