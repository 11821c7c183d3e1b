"""Hand-made session rows."""

from __future__ import annotations

import random
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from footfall import FeatureParams
from footfall.sources.sessions import SESSION_SCHEMA
from footfall.vocabulary import BROWSERS, CHANNELS, METROS, PAGES_LEVEL_2, PAGES_LEVEL_3, STATES

PARAMS = FeatureParams()


def epoch(day: str, hour: int = 12) -> int:
    return int(datetime.strptime(day, "%Y%m%d").replace(tzinfo=UTC).timestamp()) + hour * 3600


def session(
    visitor="v",
    day="20170110",
    hour=12,
    *,
    start=None,
    channel="Direct",
    visits=1,
    views=3,
    seconds=60,
    bounces=None,
    transactions=None,
    device="desktop",
    browser="Chrome",
    country="United States",
    region="Texas",
    metro="Austin TX",
    hits=(("/quickview", None),),
    suffix=None,
):
    return (
        visitor,
        epoch(day, hour) if start is None else start,
        day,
        channel,
        (visits, views, seconds, bounces, transactions),
        (device, browser),
        (country, region, metro),
        None if hits is None else [((l2, l3), None) for l2, l3 in hits],
        suffix or day,
    )


def sessions(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SESSION_SCHEMA)


def random_sessions(seed: int, n: int, visitors: int) -> list[tuple]:
    """Sessions with NULLs, ties, bounces, unknown regions and empty hits all over."""
    rng = random.Random(seed)

    def maybe(values, share=0.15):
        return None if rng.random() < share else rng.choice(list(values))

    rows = []
    for _ in range(n):
        hits = [
            (maybe([*PAGES_LEVEL_2, "/other"], 0.3), maybe([*PAGES_LEVEL_3, "/other"], 0.3))
            for _ in range(rng.choice([0, 0, 1, 2, 5]))
        ]
        rows.append(
            session(
                visitor=f"v{rng.randrange(visitors)}",
                day=f"2017{rng.choice(['0309', '0311', '0312', '0313', '0430', '0501'])}",
                hour=rng.randrange(24),
                channel=maybe([*CHANNELS, "Other"]),
                visits=maybe([1]),
                views=maybe([0, 1, 2, 3]),
                seconds=maybe([0, 10, 500]),
                bounces=maybe([1], 0.7),
                transactions=maybe([0, 1, 2], 0.8),
                device=maybe(["mobile", "desktop", "tablet", "tv"]),
                browser=maybe([*BROWSERS, "Opera"]),
                country=rng.choice(["United States"] * 9 + ["Canada"]),
                region=maybe([name for name, _, _ in STATES] + ["Guam"]),
                metro=maybe([*METROS, "(not set)"]),
                hits=rng.choice([hits, hits, hits, None]),
            )
        )
    return rows
