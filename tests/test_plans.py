"""What the physical plans must and must not contain."""

import re

import pytest

from footfall import FeatureParams, feature_table, read_sessions, write_sessions
from footfall.operators.ntile import exact_ntile
from footfall.operators.indicators import visitor_flags
from footfall.plans.queries import QUERIES
from footfall.sources.tables import read_table, replace_table
from tests.hand_made import PARAMS, random_sessions, sessions

JIT_LIMIT = 8000


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "sessions")
    write_sessions(sessions(spark, random_sessions(1, 500, 50)), path)
    return path


def _plan(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def _code_sizes(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        text = df.select("*")._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    return [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def test_round_trip(spark, stored):
    rows = sessions(spark, random_sessions(1, 500, 50))
    back = read_sessions(spark, stored)
    assert back.dtypes == rows.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_day_range_prunes_partitions(spark, stored):
    plan = _plan(read_sessions(spark, stored, FeatureParams("20170311", "20170312")))
    filters = re.search(r"PartitionFilters: \[(.*)\]", plan).group(1)
    assert "table_suffix" in filters
    assert "20170311" in filters
    assert "20170312" in filters
    assert "EqualTo(geoNetwork.country,United States)" in plan


def test_features_scan_once_and_shuffle_once(spark, stored):
    plan = _plan(feature_table(read_sessions(spark, stored), PARAMS))
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 1
    assert len(re.findall(r"^\(\d+\) Exchange", plan, re.M)) == 1
    assert "ObjectHashAggregate" not in plan
    assert "SortAggregate" not in plan
    assert "Window" not in plan


def test_scan_reads_only_the_leaves_it_needs(spark, stored):
    plan = _plan(visitor_flags(read_sessions(spark, stored), PARAMS))
    schema = re.search(r"ReadSchema: (.*)", plan).group(1)
    assert "totals" not in schema
    assert "region" not in schema
    assert "visitStartTime" not in schema
    assert "metro" in schema


def test_generated_code_stays_compilable(spark, stored):
    table = read_sessions(spark, stored)
    sizes = _code_sizes(feature_table(table, PARAMS)) + _code_sizes(visitor_flags(table, PARAMS))
    assert sizes
    assert max(sizes) < JIT_LIMIT


@pytest.mark.parametrize("name", ["feature_table", "users_labeled", "metro_flags", "page_flags"])
def test_generated_code_of_queries(spark, name):
    sizes = _code_sizes(QUERIES[name](spark, "/root/testdata/sf0.001"))
    assert max(sizes) < JIT_LIMIT


def test_events_are_filtered_in_the_scan(spark):
    plan = _plan(QUERIES["users_labeled"](spark, "/root/testdata/sf0.001"))
    assert "GreaterThanOrEqual(ts,2024-01-01T00:00)" in plan
    assert "LessThan(ts,2024-01-23T00:00)" in plan
    assert "props" not in plan


def test_ntile_has_no_window_or_aggregate_over_all_rows(spark, tmp_path):
    path = str(tmp_path / "scores")
    scores = spark.range(5000).selectExpr("cast(id as string) AS fullVisitorId", "id / 5000D AS probability")
    scores.write.parquet(path)
    plan = exact_ntile(spark.read.parquet(path), 10)._jdf.queryExecution().sparkPlan().toString()
    windows = re.findall(r"Window \[.*?\], \[(.*?)\]", plan)
    assert windows and all("cell" in w for w in windows)
    assert "Aggregate" not in plan


def test_replace_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), "footfall_test", path)
    replaced = replace_table(spark.range(5).withColumnRenamed("id", "n"), "footfall_test", path)
    assert replaced.columns == ["n"]
    assert read_table(spark, "footfall_test").count() == 5
    spark.sql("DROP TABLE footfall_test")
