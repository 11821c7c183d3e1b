"""The 0/1 indicator columns of a visitor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.flags import fold_words, has_hits, unpack_words, with_page_levels
from footfall.params import FeatureParams
from footfall.sources.sessions import select_sessions
from footfall.vocabulary import INDICATORS, VISITOR, Indicator


def indicators_of(*groups: str) -> list[Indicator]:
    """Indicators of the named groups: device, browser, channel, page, metro."""
    return [ind for ind in INDICATORS if ind.group in groups]


def visitor_flags(
    sessions: DataFrame, params: FeatureParams, indicators: Sequence[Indicator] = tuple(INDICATORS)
) -> DataFrame:
    """Indicators per visitor, for visitors that have hits at all.

    Hits are never unnested: session fields are tested once per session, page
    paths inside the array.
    """
    hit_sessions = with_page_levels(select_sessions(sessions, params)).where(has_hits())
    folded = hit_sessions.groupBy(VISITOR).agg(*fold_words(indicators))
    return folded.select(VISITOR, *unpack_words(indicators))


def hits_unnest(sessions: DataFrame, params: FeatureParams) -> DataFrame:
    """One row per hit; sessions without hits vanish."""
    return (
        select_sessions(sessions, params)
        .select(VISITOR, "visitStartTime", "date", F.explode("hits").alias("hit"))
        .select(VISITOR, "visitStartTime", "date", "hit.*")
        .select("*", "page.pagePathLevel2", "page.pagePathLevel3")
        .drop("page")
    )
