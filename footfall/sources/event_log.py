"""Session rows built from an event log and a customer star.

One session per user and UTC day. Times are moved by a fixed number of days so
that they fall in the span the daylight-saving ranges cover.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.vocabulary import BROWSERS, CHANNELS, DEVICE_CATEGORIES, METROS, STATES, VISITOR

SHIFT_DAYS = 2497
PURCHASE_FLOOR = 100

# event type -> page path of the hit; "error" events are no hits.
PAGES = {
    "view": ("/quickview", "/mens/"),
    "click": ("/brands/", None),
    "signup": ("/faqs", "/frequently-asked-questions/"),
    "purchase": (None, "/womens"),
}

DEVICES = list(DEVICE_CATEGORIES)
BROWSER_NAMES = [*BROWSERS, "Opera"]
CHANNEL_NAMES = [*CHANNELS, "Unknown"]
REGIONS = [name for name, _, _ in STATES[:23]] + ["Guam", STATES[23][0]]
METRO_NAMES = [*METROS[:24], "(not set)"]

HIT_TYPE = "struct<page: struct<pagePathLevel2: string, pagePathLevel3: string>, occurrences: bigint>"


def _day_start(day: str) -> datetime:
    return datetime.strptime(day, "%Y%m%d") + timedelta(days=SHIFT_DAYS)


def _pick(names: list[str], index: Column) -> Column:
    return F.get(F.lit(names), index.cast("int"))


def _epoch(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-free timestamp, in any session zone."""
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def _none_if_zero(count: Column) -> Column:
    return F.when(count > 0, count)


def _hits() -> Column:
    """One hit per page of the session, with how often it was hit.

    At most one entry per event type, so a session never outgrows a row
    however many events it has.
    """
    empty = F.array().cast(f"array<{HIT_TYPE}>")
    parts = []
    for event_type, (level2, level3) in PAGES.items():
        hit = F.struct(
            F.struct(
                F.lit(level2).cast("string").alias("pagePathLevel2"),
                F.lit(level3).cast("string").alias("pagePathLevel3"),
            ).alias("page"),
            F.col(f"n_{event_type}").alias("occurrences"),
        ).cast(HIT_TYPE)
        parts.append(F.when(F.col(f"n_{event_type}") > 0, F.array(hit)).otherwise(empty))
    return F.concat(*parts)


def sessions_from_events(
    spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Session rows; ``start`` and ``end`` (inclusive days) reach the event scan.

    Events fold to (user, day) before any join, with counters only, so a user
    with a third of all events costs one row per task and day. No side is
    broadcast by hand: the planner does it where the size allows.
    """

    def read(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    ts = F.col("ts").cast("timestamp_ntz")
    events = read("events").where(F.col("user_id").isNotNull())
    if start is not None:
        events = events.where(ts >= F.lit(str(_day_start(start))).cast("timestamp_ntz"))
    if end is not None:
        events = events.where(
            ts < F.lit(str(_day_start(end) + timedelta(days=1))).cast("timestamp_ntz")
        )

    is_sale = (F.col("event_type") == "purchase") & (F.col("value") >= PURCHASE_FLOOR)
    days = (
        events.groupBy("user_id", F.to_date(ts).alias("event_day"))
        .agg(
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
            F.min("event_id").alias("first_event"),
            F.count("*").alias("n_events"),
            *[F.count_if(F.col("event_type") == t).alias(f"n_{t}") for t in PAGES],
            F.count_if(is_sale).alias("n_sales"),
        )
        .withColumn("day", F.date_format(F.date_sub("event_day", SHIFT_DAYS), "yyyyMMdd"))
    )

    nations = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    places = read("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "n_nationkey", "r_name"
    )
    views = F.col("n_view") + F.col("n_click")
    seconds = _epoch(F.col("last_ts")) - _epoch(F.col("first_ts"))
    return days.join(places, F.col("user_id") == F.col("c_custkey")).select(
        F.col("user_id").cast("string").alias(VISITOR),
        (_epoch(F.col("first_ts")) - SHIFT_DAYS * 86400).alias("visitStartTime"),
        F.col("day").alias("date"),
        _pick(CHANNEL_NAMES, F.col("first_event") % 9).alias("channelGrouping"),
        F.struct(
            F.lit(1).cast("bigint").alias("visits"),
            _none_if_zero(views).alias("pageviews"),
            F.when(F.col("n_events") > 1, seconds).alias("timeOnSite"),
            F.when(F.col("n_events") == 1, F.lit(1).cast("bigint")).alias("bounces"),
            _none_if_zero(F.col("n_sales")).alias("transactions"),
        ).alias("totals"),
        F.struct(
            _pick(DEVICES, F.col("first_event") % 3).alias("deviceCategory"),
            _pick(BROWSER_NAMES, F.col("first_event") % 5).alias("browser"),
        ).alias("device"),
        F.struct(
            F.when(F.col("r_name") == "MIDDLE EAST", F.col("r_name"))
            .otherwise("United States")
            .alias("country"),
            _pick(REGIONS, F.col("n_nationkey")).alias("region"),
            _pick(METRO_NAMES, F.col("n_nationkey")).alias("metro"),
        ).alias("geoNetwork"),
        _hits().alias("hits"),
        F.col("day").alias("table_suffix"),
    )
