import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from footfall import feature_table
from footfall.operators import metrics, scoring, training
from footfall.operators.correlation import feature_correlation
from footfall.operators.split import train_eval_split
from footfall.columns import FEATURES
from footfall.vocabulary import BROWSERS, VISITOR
from tests.hand_made import PARAMS, session, sessions


@pytest.fixture(scope="module")
def features(spark):
    """Mobile visitors buy far more often; browsers mean nothing."""
    rng = random.Random(5)
    rows = []
    for i in range(800):
        device = rng.choice(["mobile", "desktop"])
        browser = rng.choice(list(BROWSERS))
        hits = None if i % 40 == 7 else [("/quickview", None)]
        style = dict(
            device=device, browser=browser, hits=hits, region="Guam" if i % 30 == 3 else "Texas"
        )
        views = None if i % 50 == 1 else rng.randrange(1, 9)
        rows.append(session(str(i), "20170110", views=views, **style))
        buys = rng.random() < (0.7 if device == "mobile" else 0.15)
        rows.append(session(str(i), "20170112", transactions=int(buys), **style))
    return train_eval_split(feature_table(sessions(spark, rows), PARAMS)).cache()


@pytest.fixture(scope="module")
def models(features):
    return training.fit(features.where("not is_eval"), l1_strengths=(0, 1, 10, 1000))


def test_learns_the_signal(features, models):
    scored = training.score(models["logistic_reg", 1], features.where("is_eval"))
    assert metrics.evaluate(scored).first().roc_auc > 0.7


def test_stronger_penalty_leaves_fewer_weights(models):
    non_zero = [m.classifier.coefficients.numNonzeros() for m in models.values()]
    assert non_zero == sorted(non_zero, reverse=True)
    assert non_zero[0] > 10
    assert non_zero[-1] == 0


def test_weights(features, models):
    table = training.model_weights(models["logistic_reg", 1], features).collect()
    assert [r.weight for r in table] == sorted((r.weight for r in table), reverse=True)
    names = [(r.processed_input, r.category) for r in table]
    assert len(names) == len(set(names)) == 113 + 8 + 8 + 1
    assert ("day", "Sunday") in names
    assert ("__INTERCEPT__", None) in names
    by_name = {r.processed_input: r.weight for r in table if r.category is None}
    assert by_name["device_deviceCategory_mobile"] > 0.3 > abs(by_name["device_browser_Edge"])


def test_weights_are_standardised(features, models):
    model = models["logistic_reg", 1]
    raw = training.model_weights(model, features, standardize=False)
    scaled = training.model_weights(model, features)
    name = F.col("processed_input") == "timeOnSite_per_visit"
    imputed = features.select(F.stddev(F.coalesce("timeOnSite_per_visit", F.lit(60.0)))).first()[0]
    assert scaled.where(name).first().weight == pytest.approx(raw.where(name).first().weight * imputed)


def test_training_info(models):
    info = training.training_info(models["logistic_reg", 1]).orderBy("iteration")
    losses = [r.loss for r in info.collect()]
    assert len(losses) > 2
    assert losses[-1] < losses[0]


def test_predict_passes_inputs_through_and_needs_no_label(features, models):
    model = models["logistic_reg", 1].pipeline
    visitors = features.select(VISITOR, "labels", *FEATURES)
    predictions = scoring.predict(model, visitors)
    assert predictions.columns == [VISITOR, *FEATURES, "predicted_labels", "predicted_labels_probs"]
    assert dict(predictions.dtypes)["predicted_labels_probs"] == "array<struct<label:int,prob:double>>"
    again = scoring.predict(model, visitors.drop("labels"))
    assert sorted(map(str, predictions.collect())) == sorted(map(str, again.collect()))
    for row in predictions.limit(20).collect():
        probs = {p.label: p.prob for p in row.predicted_labels_probs}
        assert probs[0] + probs[1] == pytest.approx(1)
        assert row.predicted_labels == int(probs[1] >= 0.5)


def test_save_and_load(spark, features, models, tmp_path):
    path = str(tmp_path / "model")
    for l1 in (10, 1):
        training.save_model(models["logistic_reg", l1], path)
    loaded = training.load_model(spark, path)
    saved = models["logistic_reg", 1]
    assert (loaded.model_type, loaded.l1, loaded.losses) == ("logistic_reg", 1.0, saved.losses)
    assert sorted(training.score(loaded, features).collect()) == sorted(
        training.score(saved, features).collect()
    )


def test_compare_tags_each_model(features, models):
    table = training.compare(models, features.where("is_eval")).collect()
    assert [r.L1 for r in table] == ["0", "1", "10", "1000"]
    assert {r.model_type for r in table} == {"logistic_reg"}


def test_other_families(features):
    families = [t for t in training.MODEL_TYPES if t != "logistic_reg"]
    models = training.fit(features.where("not is_eval"), model_types=families, options=training.FitOptions(tolerance=1e-3))
    for r in training.compare(models, features.where("is_eval")).collect():
        assert r.roc_auc > 0.65, r


def test_unknown_family(features):
    with pytest.raises(ValueError, match="unknown model type"):
        training.fit(features, model_types=["nearest_neighbour"])


def test_vector_layout(features, models):
    pipeline = models["logistic_reg", 1].pipeline
    vectors = pipeline.transform(features).select("features", "daypart", "day")
    names = training.feature_names(vectors)
    assert names[:2] == ["timeOnSite_per_visit", "timeOnSite_per_page"]
    unknown = names.index("daypart=__unknown")
    row = vectors.where("daypart IS NULL").select(vector_to_array("features").alias("v")).first()
    assert row.v[unknown] == 1.0


def test_correlation(features):
    columns = [
        "timeOnSite_per_page",
        "device_deviceCategory_mobile",
        "device_deviceCategory_desktop",
        "geoNetworkmetro_AtlantaGA",
    ]
    pairs = feature_correlation(features, columns, {}).collect()
    found = {(r.feature_a, r.feature_b): r.correlation for r in pairs}
    assert len(found) == 6
    assert found[columns[1], columns[2]] == pytest.approx(-1)
    assert found[columns[1], columns[3]] is None
    frame = features.select(*columns).toPandas()
    frame = frame.fillna(frame.mean())
    assert found[columns[0], columns[1]] == pytest.approx(frame[columns[0]].corr(frame[columns[1]]))
