"""Feature tables from daily states equal those from the sessions."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from footfall import FeatureParams, feature_table
from footfall.plans import daily_state
from footfall.sources.sessions import SESSION_SCHEMA
from tests.hand_made import PARAMS, random_sessions, session, sessions

ALL_DAYS = FeatureParams(session_start="20160801", session_end="20170801")
RANGES = {
    "first": FeatureParams(session_start="20170301", session_end="20170312"),
    "inside": FeatureParams(session_start="20170311", session_end="20170313"),
    "last": FeatureParams(session_start="20170313", session_end="20170801"),
    "other": FeatureParams(session_start="20170301", session_end="20170801", country="Canada"),
    "none": FeatureParams(session_start="20180101", session_end="20180131"),
}


def _rows(df):
    return sorted(map(repr, df.collect()))


def _stored(spark, data, path):
    daily_state.write_visitor_days(daily_state.visitor_days(data, ALL_DAYS), path)
    return daily_state.read_visitor_days(spark, path)


@pytest.mark.parametrize("seed", range(2))
def test_any_range_equals_the_one_pass_plan(spark, tmp_path, seed):
    data = sessions(spark, random_sessions(seed, 800, 60))
    states = _stored(spark, data, str(tmp_path / "days"))
    found = daily_state.features_of_windows(states, RANGES).cache()
    for label, params in RANGES.items():
        expected = feature_table(data, params)
        one = daily_state.feature_table_from_days(states, params)
        assert one.dtypes == expected.dtypes
        assert _rows(one) == _rows(expected)
        mine = found.where(F.col("window_name") == label).drop("window_name")
        assert _rows(mine) == _rows(expected)
    assert {r[0] for r in found.select("window_name").distinct().collect()} == set(RANGES) - {"none"}


def test_a_day_that_comes_again_is_replaced(spark, tmp_path):
    path = str(tmp_path / "days")
    early = [session("a", "20170110"), session("a", "20170111", views=9)]
    late = [session("a", "20170111", views=9), session("b", "20170111", transactions=1, hour=15)]
    _stored(spark, sessions(spark, early), path)
    states = _stored(spark, sessions(spark, late), path)
    expected = feature_table(sessions(spark, [early[0], *late]), PARAMS)
    assert _rows(daily_state.feature_table_from_days(states, PARAMS)) == _rows(expected)


def test_rows_without_visitor_country_or_sessions(spark, tmp_path):
    odd = [session(None), session(country=None), session("x", hits=None, views=None, visits=None)]
    data = sessions(spark, odd)
    states = _stored(spark, data, str(tmp_path / "days"))
    assert states.count() == 1
    assert _rows(daily_state.feature_table_from_days(states, PARAMS)) == _rows(feature_table(data, PARAMS))
    nothing = daily_state.visitor_days(spark.createDataFrame([], SESSION_SCHEMA), ALL_DAYS)
    assert daily_state.feature_table_from_days(nothing, PARAMS).collect() == []


def test_days_outside_are_not_read(spark, tmp_path):
    data = sessions(spark, random_sessions(5, 300, 40))
    states = _stored(spark, data, str(tmp_path / "days"))
    plan = daily_state.features_of_windows(states, RANGES)._jdf.queryExecution().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [" in scan and "20170312" in scan
    assert plan.count("FileScan") == 1
    physical = plan[plan.index("== Physical Plan ==") :]
    assert physical.count("Exchange hashpartitioning") == 1


def test_refused_windows(spark):
    states = daily_state.visitor_days(spark.createDataFrame([], SESSION_SCHEMA), ALL_DAYS)
    for windows in (
        {},
        {"a": replace(PARAMS, lookback_filter=True)},
        {"a": PARAMS, "b": replace(PARAMS, lookback_days=7)},
    ):
        with pytest.raises(ValueError):
            daily_state.features_of_windows(states, windows)
