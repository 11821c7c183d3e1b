import re
from collections import Counter
from dataclasses import replace
from datetime import UTC, datetime, timedelta

import pytest

from footfall import FeatureParams, feature_table, training_projection
from footfall.columns import CORRECT_NAMES, FEATURES, FLAGS
from footfall.operators import lookback
from footfall.plans.feature_table import with_names
from footfall.plans.staged import feature_table_staged
from footfall.sources.sessions import SESSION_SCHEMA
from footfall.vocabulary import VISITOR
from tests.hand_made import PARAMS, random_sessions, session, sessions


def _rows(df):
    return sorted(map(str, df.collect()))


def _one(spark, rows, params=PARAMS):
    return feature_table(sessions(spark, rows), params).first()


@pytest.mark.parametrize("seed", range(4))
def test_one_pass_equals_stages(spark, seed):
    data = sessions(spark, random_sessions(seed, 600, 120))
    one_pass = feature_table(data, PARAMS)
    stages = feature_table_staged(data, PARAMS)
    assert one_pass.columns == stages.columns
    assert one_pass.dtypes == stages.dtypes
    assert _rows(one_pass) == _rows(stages)
    assert one_pass.count() > 50


def test_layout(spark):
    table = feature_table(sessions(spark, [session()]), PARAMS)
    types = dict(table.dtypes)
    assert len(table.columns) == 122
    assert table.columns[:9] == [
        VISITOR,
        "labels",
        "first_conversion_session",
        "last_visit_timestamp",
        "last_conversion_timestamp",
        "front_lookback_window",
        "end_lookback_window",
        "timeOnSite_per_visit",
        "timeOnSite_per_page",
    ]
    assert table.columns[-2:] == ["day", "daypart"]
    assert types["first_conversion_session"] == "bigint"
    assert types["last_visit_timestamp"] == types["front_lookback_window"] == "timestamp"
    assert {types[c] for c in FLAGS} == {"int"}


def test_training_projection(spark):
    table = feature_table(sessions(spark, [session()]), PARAMS)
    assert training_projection(table).columns == ["labels", *FEATURES]
    assert len(FEATURES) == 115


def test_order_and_partitioning_do_not_matter(spark):
    rows = random_sessions(7, 400, 60)
    plain = feature_table(sessions(spark, rows), PARAMS)
    other = feature_table(sessions(spark, rows[::-1]).repartition(13), PARAMS)
    assert _rows(plain) == _rows(other)


def test_repeating_sessions_keeps_flags_and_ratios(spark):
    rows = random_sessions(8, 300, 60)
    once = feature_table(sessions(spark, rows), PARAMS)
    twice = feature_table(sessions(spark, rows + rows), PARAMS)
    assert _rows(once) == _rows(twice)


def test_visitor_without_hits_has_null_flags(spark):
    for hits in (None, []):
        row = _one(spark, [session(hits=hits)])
        assert {row[c] for c in FLAGS} == {None}
        assert row.day == "Tuesday"


def test_sessions_without_hits_lose_their_flags(spark):
    row = _one(spark, [session(browser="Safari", hits=[]), session(browser="Chrome")])
    assert (row.device_browser_Safari, row.device_browser_Chrome) == (0, 1)


def test_null_fields_give_zero(spark):
    empty = session(device=None, browser=None, channel=None, metro=None, hits=[(None, None)])
    row = _one(spark, [empty])
    assert {row[c] for c in FLAGS} == {0}


def test_flags_are_multi_hot_and_paths_not_normalised(spark):
    row = _one(
        spark,
        [session(browser="Chrome", hits=[("/lifestyle", None)]), session(browser="Safari")],
    )
    assert (row.device_browser_Chrome, row.device_browser_Safari) == (1, 1)
    assert row.hitspagepagePathLevel2_lifestyle == 1
    assert row.hitspagepagePathLevel2_lifestyle2 == 0


def test_ratios(spark):
    row = _one(
        spark,
        [session(seconds=100, views=4), session(seconds=None, views=6), session(bounces=1, seconds=None)],
    )
    assert row.timeOnSite_per_visit == pytest.approx(100 / 3)
    assert row.timeOnSite_per_page == pytest.approx(100 / 13)


def test_ratios_without_divisor(spark):
    row = _one(spark, [session(views=0, visits=None)])
    assert row.timeOnSite_per_visit is None
    assert row.timeOnSite_per_page is None


BUYER = [
    session(day="20170101", browser="Edge", views=50),
    session(day="20170301", browser="Chrome"),
    session(day="20170315", transactions=1, browser="Chrome"),
    session(day="20170320", browser="Safari"),
]


def test_sessions_outside_the_window_still_count(spark):
    row = _one(spark, BUYER)
    assert (row.device_browser_Edge, row.device_browser_Chrome, row.device_browser_Safari) == (1, 1, 1)


def test_lookback_filter(spark):
    row = _one(spark, BUYER, replace(PARAMS, lookback_filter=True))
    assert (row.device_browser_Edge, row.device_browser_Chrome, row.device_browser_Safari) == (0, 1, 0)
    assert row.end_lookback_window - row.front_lookback_window == timedelta(days=30)


@pytest.mark.parametrize("seed", range(2))
def test_lookback_filter_against_python(spark, seed, monkeypatch):
    """Also with nearly every visitor split over several keys."""
    if seed:
        monkeypatch.setattr("footfall.operators.lookback.ROWS_PER_KEY", 3)
    rows = random_sessions(seed, 500, 60)
    params = FeatureParams(lookback_days=3, lookback_filter=True)
    windows = {
        r[VISITOR]: (r.front_lookback_window.timestamp(), r.end_lookback_window.timestamp())
        for r in feature_table(sessions(spark, rows), replace(params, lookback_filter=False)).collect()
    }
    inside = [r for r in rows if r[0] in windows and windows[r[0]][0] <= r[1] <= windows[r[0]][1]]
    table = feature_table(sessions(spark, rows), params)
    behaviour = [VISITOR, *FEATURES]
    expected = {}
    for r in feature_table_staged(
        sessions(spark, [_as_plain_visit(r) for r in inside]), PARAMS
    ).select(*behaviour).collect():
        expected[r[VISITOR]] = tuple(r)
    found = {r[VISITOR]: tuple(r) for r in table.select(*behaviour).collect()}
    assert found == expected


def test_heavy_visitor_that_is_not_kept(spark):
    """Left out of the table, whatever their number of sessions."""
    rows = [session("hot", "20170101", h, bounces=1) for h in range(20)] + BUYER
    params = replace(PARAMS, lookback_filter=True)
    assert [r[VISITOR] for r in feature_table(sessions(spark, rows), params).collect()] == ["v"]


def test_join_keys_stay_small(spark, monkeypatch):
    """One visitor with a third of all sessions and several with somewhat fewer."""
    monkeypatch.setattr(lookback, "ROWS_PER_KEY", 50)
    counts = {"hot": 600, **{f"warm{i}": 149 for i in range(8)}}
    start = datetime(2017, 1, 10, tzinfo=UTC)
    rows = [(v, int(start.timestamp()) + i) for v, n in counts.items() for i in range(n)]
    window = (True, start, start + timedelta(days=1))
    visitors = spark.createDataFrame(
        [(v, *window, n) for v, n in counts.items()],
        f"{VISITOR} string, kept boolean, front_lookback_window timestamp, "
        "end_lookback_window timestamp, n_sessions long",
    )
    packed = spark.createDataFrame(rows, f"{VISITOR} string, visitStartTime long")
    found = lookback.within_window(packed, visitors)
    assert sorted(tuple(r) for r in found.collect()) == sorted(rows)
    keys = Counter((r[0], r[1]) for r in lookback.salted(packed, visitors).select(VISITOR, "salt").collect())
    assert max(keys.values()) < 100
    assert len(keys) == 12 + 8 * 3


def test_lookback_shuffles_packed_rows_only(spark, tmp_path):
    rows = random_sessions(1, 200, 20)
    sessions(spark, rows).write.parquet(str(tmp_path / "s"))
    stored = spark.read.schema(SESSION_SCHEMA).parquet(str(tmp_path / "s"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = feature_table(stored, replace(PARAMS, lookback_filter=True))
        plan = table._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanged = re.findall(r"^\(\d+\) Exchange\nInput \[\d+\]: (.*)$", plan, re.M)
    assert exchanged
    for columns in exchanged:
        assert not re.search(r"\b(hits|page_levels_\d|totals|device|geoNetwork)#", columns)


def test_correct_names(spark):
    features = feature_table(sessions(spark, BUYER), PARAMS)
    renamed = with_names(features)
    assert len(set(renamed.columns)) == len(features.columns)
    assert "channelGrouping_Referral" in renamed.columns
    assert set(features.columns) - set(renamed.columns) == set(CORRECT_NAMES)


def _as_plain_visit(row):
    """Same behaviour, but kept in the table: no bounce, no purchase."""
    visits, views, seconds, _, _ = row[4]
    return (*row[:4], (visits, views, seconds, None, None), *row[5:])
