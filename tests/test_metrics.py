import math
import random

import pytest

from footfall.operators import metrics, scoring
from footfall.operators.split import train_eval_split


def _data(n=400, seed=3):
    rng = random.Random(seed)
    return [(int(rng.random() < p), p) for p in (round(rng.random(), 2) for _ in range(n))]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(_data(), "labels int, probability double")


def test_confusion_matrix(scored):
    expected = {(y, c): 0 for y in (0, 1) for c in (0, 1)}
    for y, p in _data():
        expected[y, int(p >= 0.5)] += 1
    for row in metrics.confusion_matrix(scored).collect():
        assert row.predicted_0 == expected[row.expected_label, 0]
        assert row.predicted_1 == expected[row.expected_label, 1]


def test_confusion_matrix_of_one_class(spark):
    rows = spark.createDataFrame([(1, 0.9)], "labels int, probability double")
    assert [tuple(r) for r in metrics.confusion_matrix(rows).collect()] == [(1, 0, 1)]


@pytest.mark.parametrize("thresholds", [metrics.ROC_THRESHOLDS, (0.29, 0.3, 0.71)])
def test_roc_curve(scored, thresholds):
    data = _data()
    positives = sum(y for y, _ in data)
    rows = metrics.roc_curve(scored, thresholds=thresholds).collect()
    assert sorted(r.threshold for r in rows) == list(thresholds)
    for r in rows:
        tp = sum(y for y, p in data if p >= r.threshold)
        fp = sum(1 - y for y, p in data if p >= r.threshold)
        assert (r.true_positives, r.false_positives) == (tp, fp)
        assert r.false_negatives == positives - tp
        assert r.true_negatives == len(data) - positives - fp
        assert r.recall == pytest.approx(tp / positives)


def test_evaluate(scored):
    data = _data()
    report = metrics.evaluate(scored).first()
    tp = sum(y for y, p in data if p >= 0.5)
    called = sum(p >= 0.5 for _, p in data)
    positives = sum(y for y, _ in data)
    pairs = [
        (a > b) + (a == b) / 2 for y, a in data if y for z, b in data if not z
    ]
    clip = lambda p: min(max(p, 1e-15), 1 - 1e-15)
    loss = -sum(math.log(clip(p)) if y else math.log(1 - clip(p)) for y, p in data) / len(data)
    assert report.precision == pytest.approx(tp / called)
    assert report.recall == pytest.approx(tp / positives)
    assert report.accuracy == pytest.approx(sum(y == (p >= 0.5) for y, p in data) / len(data))
    assert report.f1_score == pytest.approx(2 * tp / (called + positives))
    assert report.log_loss == pytest.approx(loss)
    assert report.roc_auc == pytest.approx(sum(pairs) / len(pairs))


def test_nothing_called_positive(spark):
    rows = spark.createDataFrame([(1, 0.1), (0, 0.2)], "labels int, probability double")
    report = metrics.evaluate(rows).first()
    assert report.precision is None
    assert report.recall == 0


def test_segment_summary(spark):
    rows = spark.createDataFrame(
        [("a", 0.9, 1, 1), ("b", 0.8, 0, 1), ("c", 0.2, 0, 2), ("d", 0.1, 0, 2)],
        "fullVisitorId string, probability double, labels int, decile int",
    )
    found = {r.decile: r for r in scoring.segment_summary(rows).collect()}
    assert (found[1].visitors, found[1].conversion_rate, found[1].lift) == (2, 0.5, 2.0)
    assert found[2].buyers == 0
    assert "lift" not in scoring.segment_summary(rows.drop("labels")).columns


def test_positive_class_probability(spark):
    rows = spark.createDataFrame([("a", 0.7), ("b", 0.2)], "fullVisitorId string, p double")
    predictions = scoring.with_predictions(rows, "p")
    assert [r.predicted_labels for r in predictions.orderBy("fullVisitorId").collect()] == [1, 0]
    found = scoring.positive_class_probability(predictions).collect()
    assert sorted(map(tuple, found)) == [("a", 0.7), ("b", 0.2)]


def test_split_is_stable_and_near_the_fraction(spark):
    ids = spark.range(20000).selectExpr("cast(id as string) AS fullVisitorId")
    first = {r[0]: r[1] for r in train_eval_split(ids).collect()}
    again = {r[0]: r[1] for r in train_eval_split(ids.repartition(9)).collect()}
    other = {r[0]: r[1] for r in train_eval_split(ids, seed=1).collect()}
    assert first == again
    assert first != other
    assert abs(sum(first.values()) / 20000 - 0.2) < 0.02


@pytest.mark.parametrize("rows", [[(1, 0.9), (1, 0.2)], [(0, 0.4)], []])
def test_no_area_without_both_classes(spark, rows):
    scored = spark.createDataFrame(rows, "labels int, probability double")
    assert metrics.evaluate(scored).first().roc_auc is None


def test_rows_without_a_probability_are_left_out_everywhere(spark):
    rows = [(1, 0.9), (0, 0.2), (0, 0.95), (1, None), (None, 0.5)]
    scored = spark.createDataFrame(rows, "labels int, probability double")
    report = metrics.evaluate(scored).first()
    assert (report.accuracy, report.roc_auc) == (2 / 3, 0.5)
    assert sorted(tuple(r) for r in metrics.confusion_matrix(scored).collect()) == [(0, 1, 1), (1, 0, 1)]
    first = metrics.roc_curve(scored).orderBy("threshold").first()
    assert (first.true_positives, first.false_positives) == (1, 2)
