from datetime import timedelta

import pytest

from footfall import FeatureParams
from footfall.operators.labels import filtered_users, users_labeled
from footfall.vocabulary import VISITOR
from tests.hand_made import PARAMS, epoch, session, sessions


def _users(spark, rows, params=PARAMS):
    labeled = users_labeled(sessions(spark, rows), params)
    return {r[VISITOR]: r for r in filtered_users(labeled, params).collect()}


def test_buyer_in_first_session_is_dropped(spark):
    assert not _users(spark, [session(transactions=1), session(day="20170111")])


def test_a_bounce_does_not_count_as_first_visit(spark):
    rows = [session(day="20170109", bounces=1), session(day="20170110", transactions=1)]
    assert not _users(spark, rows)


def test_buyer_window_ends_at_last_conversion(spark):
    rows = [
        session(day="20170110"),
        session(day="20170115", transactions=2),
        session(day="20170120"),
    ]
    user = _users(spark, rows)["v"]
    assert user.labels == 1
    assert user.first_conversion_session == epoch("20170115")
    assert user.end_lookback_window == user.last_conversion_timestamp
    assert user.last_visit_timestamp - user.last_conversion_timestamp == timedelta(days=5)
    assert user.end_lookback_window - user.front_lookback_window == timedelta(days=30)


def test_non_buyer_window_ends_at_last_visit(spark):
    user = _users(spark, [session(transactions=0), session(day="20170120")])["v"]
    assert user.labels == 0
    assert user.first_conversion_session is None
    assert user.last_conversion_timestamp is None
    assert user.end_lookback_window == user.last_visit_timestamp


def test_bounce_only_visitor_is_absent(spark):
    assert not _users(spark, [session(bounces=1), session(day="20170111", bounces=1)])


def test_a_conversion_that_bounced_is_no_conversion(spark):
    rows = [session(), session(day="20170111", bounces=1, transactions=1)]
    assert _users(spark, rows)["v"].labels == 0


@pytest.mark.parametrize(
    "outside",
    [
        dict(day="20160731"),
        dict(day="20170501"),
        dict(day="20170112", country="Canada"),
        dict(day="20170112", country=None),
    ],
)
def test_sessions_outside_are_ignored(spark, outside):
    rows = [session(), session(transactions=1, **outside)]
    assert _users(spark, rows)["v"].labels == 0


def test_day_range_is_inclusive(spark):
    rows = [session("a", "20160801"), session("b", "20170430")]
    assert set(_users(spark, rows)) == {"a", "b"}


def test_unknown_visitors_are_left_out(spark):
    assert not _users(spark, [session(visitor=None)])


def test_buyer_without_times_is_kept(spark):
    """No conversion time, nothing to compare with the first visit."""
    row = session(transactions=1)
    assert _users(spark, [(*row[:1], None, *row[2:])])["v"].labels == 1


def test_lookback_days(spark):
    params = FeatureParams(lookback_days=7)
    user = _users(spark, [session()], params)["v"]
    assert user.end_lookback_window - user.front_lookback_window == timedelta(days=7)
