"""Weekday and local daypart of a session.

Hours come from the epoch by arithmetic, so no result depends on the time zone
of the Spark session.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall.vocabulary import DAYPARTS, WEEKDAYS

# Alphabetical: the order in which equally viewed dayparts win.
DAYPART_NAMES = sorted(DAYPARTS)


def _daypart_of(hour: int) -> str:
    return next(n for n, (lo, hi) in DAYPARTS.items() if lo <= hour < hi or lo <= hour + 24 < hi)


_DAYPART_BY_HOUR = [DAYPART_NAMES.index(_daypart_of(hour)) for hour in range(24)]


def weekday_number(date: Column) -> Column:
    """1 = Sunday … 7 = Saturday, of a ``YYYYMMDD`` string.

    The three numbers are cut out by position: a date pattern costs several
    times as much per row.
    """
    year, month, day = (F.substring(date, at, n).cast("int") for at, n in ((1, 4), (5, 2), (7, 2)))
    return F.dayofweek(F.make_date(year, month, day))


def weekday_name(number: Column) -> Column:
    return F.get(F.lit(WEEKDAYS), number.cast("int") - 1)


def utc_offset(
    date: Column, timezone: Column, dst: Column, dst_ranges: Iterable[tuple[str, str]]
) -> Column:
    """Hours from UTC on that day; NULL where the zone is unknown."""
    in_summer = reduce(lambda a, b: a | b, [date.between(lo, hi) for lo, hi in dst_ranges], F.lit(False))
    return timezone + F.when((dst == 1) & in_summer, 1).otherwise(0)


def local_hour(visit_start: Column, offset: Column) -> Column:
    """Hour of day (0-23) after moving an epoch second by ``offset`` hours."""
    utc_hour = F.call_function("div", F.pmod(visit_start, F.lit(86400)), F.lit(3600))
    return F.pmod(utc_hour + offset, F.lit(24)).cast("int")


def hour_in_zone(visit_start: Column, zone: Column) -> Column:
    """Hour of day (0-23) of an epoch second on the clocks of a named zone."""
    wall = F.from_utc_timestamp(F.timestamp_seconds(visit_start), zone)
    return local_hour(F.unix_seconds(wall), F.lit(0))


def daypart_number(hour: Column) -> Column:
    """Position in ``DAYPART_NAMES`` of the bucket an hour falls in."""
    return F.get(F.lit(_DAYPART_BY_HOUR), hour)


def daypart_name(number: Column) -> Column:
    return F.get(F.lit(DAYPART_NAMES), number)
