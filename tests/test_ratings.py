"""Thresholds, rank sums and borders taken from the scores themselves; daily tables."""

import random

from pyspark.sql import functions as F

from footfall.operators import metrics, scoring
from footfall.params import FeatureParams
from footfall.plans import queries
from footfall.sources.sessions import read_daily_tables, select_sessions, write_daily_tables
from footfall.vocabulary import VISITOR

TABLES = "/root/testdata/sf0.001"


def _scored(n=3000, seed=4):
    """Rare buyers, all scores within 1e-4, many ties."""
    rng = random.Random(seed)
    return [(int(rng.random() < 0.02), rng.randrange(700) / 7_000_000) for _ in range(n)]


def test_rank_sum_of_small_scores(spark):
    rows = _scored()
    pos, neg = ([p for y, p in rows if y == k] for k in (1, 0))
    wins = sum((p > q) + (p == q) / 2 for p in pos for q in neg)
    table = spark.createDataFrame(rows, "labels int, probability double").repartition(5)
    assert abs(metrics.evaluate(table).first().roc_auc - wins / len(pos) / len(neg)) < 1e-12


def test_roc_splits_the_positives_evenly(spark):
    rows = _scored()
    pos, neg = (sorted(p for y, p in rows if y == k) for k in (1, 0))
    table = spark.createDataFrame(rows, "labels int, probability double").repartition(5)
    found = {r.threshold: r for r in metrics.roc_at_quantiles(table, steps=10).collect()}
    expected = {max(p for p in set(pos) if sum(q >= p for q in pos) * 10 >= k * len(pos)) for k in range(1, 11)}
    assert set(found) == expected and len(found) <= 10
    for p, r in found.items():
        assert (r.true_positives, r.false_positives) == (sum(q >= p for q in pos), sum(q >= p for q in neg))
    nobody = table.where("labels = 0")
    assert metrics.roc_at_quantiles(nobody).collect() == []


def test_borders_give_the_deciles_they_come_from(spark):
    rng = random.Random(3)
    rows = [(str(i), rng.randrange(40) / 40) for i in range(1003)]
    table = spark.createDataFrame(rows, f"{VISITOR} string, probability double")
    deciles = scoring.score_deciles(table)
    rated = scoring.rate_by_borders(table, scoring.decile_borders(deciles))
    assert sorted(map(tuple, rated.collect())) == sorted(map(tuple, deciles.collect()))
    new = spark.createDataFrame([("x", 2.0), ("y", -1.0), ("z", None)], table.schema)
    found = scoring.rate_by_borders(new, scoring.decile_borders(deciles)).collect()
    assert [r.decile for r in found] == [1, 10, 10]


def test_daily_tables_are_chosen_by_name(spark, tmp_path):
    params = FeatureParams(session_start="20170305", session_end="20170309")
    sessions = queries._sessions(spark, TABLES)
    root = f"{tmp_path}/daily"
    write_daily_tables(sessions.where("table_suffix != '20170307'"), root)
    # A table outside the range that can't be read is never opened.
    (tmp_path / "daily" / "sessions_20160101").mkdir()
    (tmp_path / "daily" / "sessions_20160101" / "part-0.parquet").write_text("no table")
    found, missing = read_daily_tables(spark, root, params)
    expected = select_sessions(sessions, params).where("table_suffix != '20170307'")
    key = [VISITOR, "visitStartTime", "table_suffix"]
    assert missing == ["20170307"]
    assert sorted(found.select(*key).collect()) == sorted(expected.select(*key).collect())
    assert found.select("hits").exceptAll(expected.select("hits")).isEmpty()
    none, days = read_daily_tables(spark, f"{tmp_path}/none", params)
    assert none.isEmpty() and len(days) == 5
    assert {f.split("sessions_")[1][:8] for f in found.inputFiles()} <= {f"201703{d:02}" for d in range(5, 10)}


def test_running_counts_do_not_depend_on_the_ranges(spark):
    rows = [(i / 1000, i % 3, i % 5) for i in range(1000)]
    table = spark.createDataFrame(rows, "p double, pos long, neg long").repartition(7)
    total = table.agg(F.sum("pos"), F.sum("neg")).first()
    top = metrics.running_counts(table).orderBy("p").first()
    assert (top.pos_above + top.pos, top.neg_above + top.neg) == tuple(total)


def test_daily_tables_compute_the_sessions_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    sessions = queries._sessions(spark, TABLES)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    n = sessions.count()
    write_daily_tables(sessions.mapInArrow(count, sessions.schema), f"{tmp_path}/once")
    assert seen.value == n
