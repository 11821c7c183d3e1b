from dataclasses import replace

import pytest

from footfall.operators.habits import visitor_day, visitor_daypart, with_local_hour
from footfall.plans.staged import top_per_visitor
from tests.hand_made import PARAMS, session, sessions

BUCKETS = {
    0: "latenight_23_1",
    1: "night_1_6",
    5: "night_1_6",
    6: "morning_6_11",
    10: "morning_6_11",
    11: "lunch_11_14",
    13: "lunch_11_14",
    14: "afternoon_14_17",
    16: "afternoon_14_17",
    17: "dinner_17_19",
    18: "dinner_17_19",
    19: "evening_19_23",
    21: "evening_19_23",
    22: "latenight_23_1",
    23: "latenight_23_1",
}


def _hours(spark, rows):
    local = with_local_hour(sessions(spark, rows), PARAMS)
    return [r[0] for r in local.orderBy("fullVisitorId").select("hour_of_day_localized").collect()]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_daylight_saving(spark, zone):
    """Whatever the session's own time zone."""
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [
            session("1", "20170311", 12, region="Texas"),
            session("2", "20170312", 12, region="Texas"),
            session("3", "20171105", 12, region="Texas"),
            session("4", "20171106", 12, region="Texas"),
            session("5", "20160901", 12, region="Texas"),
            session("6", "20170715", 12, region="Arizona"),
            session("7", "20200701", 2, region="Nevada"),
            session("8", "20170115", 12, region="Guam"),
            session("9", "20170115", 12, region=None),
        ]
        assert _hours(spark, rows) == [6, 7, 7, 6, 6, 5, 19, None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_daypart_bounds(spark):
    rows = [session(f"{h:02d}", "20170110", h + 6, region="Texas") for h in BUCKETS]
    found = {r.fullVisitorId: r.daypart for r in visitor_daypart(sessions(spark, rows), PARAMS).collect()}
    assert found == {f"{h:02d}": name for h, name in BUCKETS.items()}


def _day(spark, rows):
    return visitor_day(sessions(spark, rows), PARAMS).first().day


def _daypart(spark, rows):
    return visitor_daypart(sessions(spark, rows), PARAMS).first().daypart


def test_weekday_with_most_views(spark):
    # 2017-01-08 is a Sunday.
    rows = [session(day="20170108", views=3), session(day="20170109", views=2)]
    assert _day(spark, rows) == "Sunday"
    assert _day(spark, [*rows, session(day="20170116", views=2)]) == "Monday"


def test_weekday_tie_goes_to_the_earlier_day(spark):
    rows = [session(day="20170109", views=2), session(day="20170108", views=2)]
    assert _day(spark, rows) == "Sunday"


def test_weekday_without_known_views(spark):
    assert _day(spark, [session(day="20170110", views=None)]) == "Tuesday"


def test_known_views_beat_unknown_ones(spark):
    rows = [session(day="20170108", views=None), session(day="20170109", views=0)]
    assert _day(spark, rows) == "Monday"


def test_bounces_count_for_habits(spark):
    rows = [session(day="20170108"), session(day="20170109", views=9, bounces=1)]
    assert _day(spark, rows) == "Monday"


def test_unknown_region_can_win(spark):
    rows = [session(views=5, region="Guam"), session(views=1, region="Texas")]
    assert _daypart(spark, rows) is None


def test_daypart_tie_goes_to_the_first_name_and_unknown_last(spark):
    night, noon = session(hour=9, region="Texas"), session(hour=18, region="Texas")
    assert _daypart(spark, [night, noon]) == "lunch_11_14"
    assert _daypart(spark, [session(region="Guam"), night]) == "night_1_6"


def test_day_from_the_date_hour_from_the_start(spark):
    """Two clocks: the date string names the day even where the start lies on another."""
    row = session(day="20170108", start=session(day="20170110")[1])
    assert _day(spark, [row]) == "Sunday"


def test_window_form_agrees(spark):
    sums = spark.createDataFrame(
        [("a", 1, 5), ("a", 2, 5), ("a", 3, None), ("b", 4, None)],
        "fullVisitorId string, day int, views long",
    )
    top = top_per_visitor(sums, "views", "day").collect()
    assert sorted(map(tuple, top)) == [("a", 1), ("b", 4)]


def test_named_zones_follow_every_summer(spark):
    """Texas: the listed summers begin in 2017 and end in 2020, the zone's don't."""
    days = ["20160701", "20170701", "20210701", "20211201"]
    rows = [session(d, d, hour=12, region="Texas") for d in days]
    zones = (("Texas", "America/Chicago"),)
    by_zone = with_local_hour(sessions(spark, rows), replace(PARAMS, zones=zones))
    listed = with_local_hour(sessions(spark, rows), PARAMS)
    hours = [{r.date: r.hour_of_day_localized for r in x.collect()} for x in (by_zone, listed)]
    assert hours[0] == {"20160701": 7, "20170701": 7, "20210701": 7, "20211201": 6}
    assert hours[1] == {"20160701": 6, "20170701": 7, "20210701": 6, "20211201": 6}
