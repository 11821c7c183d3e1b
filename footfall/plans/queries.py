"""Registered queries: every operator on sessions derived from the given tables.

Each takes the Spark session and the folder of the tables and returns a
DataFrame. Timestamps leave as epoch seconds, so that no comparison depends on
a time zone.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from footfall.operators import engagement, habits, indicators, labels, metrics, scoring, training, wide_deep
from footfall.operators import regularization as path
from footfall.operators.correlation import collinearity as collinear
from footfall.operators.correlation import feature_correlation as correlate
from footfall.operators.split import train_eval_split as split
from footfall.params import FeatureParams
from footfall.plans import daily_state
from footfall.plans import feature_table as features
from footfall.plans.staged import feature_table_staged as staged
from footfall.sources.event_log import sessions_from_events
from footfall.sources.lookup import state_lookup as lookup
from footfall.sources.sessions import (
    read_daily_tables,
    read_sessions,
    select_sessions,
    write_daily_tables,
    write_sessions,
)
from footfall.sources.tables import read_table, replace_table
from footfall.sources.workspace import materialize, table_path
from footfall.vocabulary import VISITOR

Query = Callable[[SparkSession, str], DataFrame]

TRAINING = FeatureParams(session_start="20170301", session_end="20170322")
HOLDOUT = FeatureParams(session_start="20170323", session_end="20170330")

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _sessions(spark: SparkSession, sf_dir: str, params: FeatureParams = TRAINING) -> DataFrame:
    return sessions_from_events(spark, sf_dir, params.session_start, params.session_end)


def _epochs(df: DataFrame) -> DataFrame:
    """Timestamp columns as epoch seconds."""
    stamps = [name for name, dtype in df.dtypes if dtype == "timestamp"]
    return df.withColumns({name: F.unix_seconds(name) for name in stamps})


def _features(spark: SparkSession, sf_dir: str, params: FeatureParams = TRAINING) -> DataFrame:
    return features.feature_table(_sessions(spark, sf_dir, params), params)


# --- sources -----------------------------------------------------------------


@query
def sessions_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions written as a day-partitioned table and read back for one window."""
    folder = table_path(spark, "sessions")
    write_sessions(_sessions(spark, sf_dir, replace(TRAINING, session_end="20170330")), folder)
    return read_sessions(spark, folder, TRAINING).select(
        VISITOR,
        "table_suffix",
        "visitStartTime",
        "channelGrouping",
        "totals.*",
        "device.*",
        "geoNetwork.region",
        "geoNetwork.metro",
    )


@query
def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions per region of the lookup, regions without any included."""
    sessions = select_sessions(_sessions(spark, sf_dir), TRAINING)
    counts = sessions.groupBy("geoNetwork.region").agg(F.count("*").alias("n"))
    return (
        lookup(spark)
        .join(counts, F.col("state_name") == F.col("region"), "left")
        .select("state_name", "timezone", "dst", F.coalesce("n", F.lit(0)).alias("sessions"))
    )


@query
def daily_tables_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions written as one table per day, those of one window read back by their names."""
    root = table_path(spark, "daily")
    write_daily_tables(_sessions(spark, sf_dir, replace(TRAINING, session_end="20170330")), root)
    sessions, missing = read_daily_tables(spark, root, TRAINING)
    return sessions.groupBy("table_suffix").agg(
        F.count("*").alias("sessions"),
        F.sum("totals.pageviews").alias("pageviews"),
        F.lit(len(missing)).cast("long").alias("missing_days"),
    )


# --- labels and windows ------------------------------------------------------


@query
def users_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _epochs(labels.users_labeled(_sessions(spark, sf_dir), TRAINING))


@query
def anchor_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = labels.users_labeled(_sessions(spark, sf_dir), TRAINING)
    return _epochs(labels.anchor_timestamp(labeled).select(VISITOR, "labels", "last_timestamp"))


@query
def lookback_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = labels.users_labeled(_sessions(spark, sf_dir), TRAINING)
    windows = labels.lookback_window(labels.anchor_timestamp(labeled), TRAINING)
    return _epochs(windows.select(VISITOR, "front_lookback_window", "end_lookback_window"))


@query
def filtered_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    labeled = labels.users_labeled(_sessions(spark, sf_dir), TRAINING)
    return _epochs(labels.filtered_users(labeled, TRAINING))


# --- behaviour ---------------------------------------------------------------


@query
def summary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engagement.summary_metrics(_sessions(spark, sf_dir), TRAINING)


@query
def hits_unnest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits and sessions per page."""
    hits = indicators.hits_unnest(_sessions(spark, sf_dir), TRAINING)
    return hits.groupBy("pagePathLevel2", "pagePathLevel3").agg(
        F.sum(F.coalesce("occurrences", F.lit(1))).alias("hits"), F.count("*").alias("sessions")
    )


def _flags(spark: SparkSession, sf_dir: str, group: str) -> DataFrame:
    wanted = indicators.indicators_of(group)
    return indicators.visitor_flags(_sessions(spark, sf_dir), TRAINING, wanted)


@query
def device_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir, "device")


@query
def browser_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir, "browser")


@query
def channel_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir, "channel")


@query
def page_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir, "page")


@query
def metro_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir, "metro")


@query
def pageviews_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return habits.pageviews_by_day(_sessions(spark, sf_dir), TRAINING)


@query
def visitor_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return habits.visitor_day(_sessions(spark, sf_dir), TRAINING)


@query
def daypart_local_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = select_sessions(_sessions(spark, sf_dir), TRAINING)
    local = habits.with_local_hour(base, TRAINING)
    return local.select(
        VISITOR, "date", "visitStartTime", "geoNetwork.region", "hour_of_day_localized"
    )


@query
def pageviews_by_daypart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return habits.pageviews_by_daypart(_sessions(spark, sf_dir), TRAINING)


@query
def visitor_daypart(spark: SparkSession, sf_dir: str) -> DataFrame:
    return habits.visitor_daypart(_sessions(spark, sf_dir), TRAINING)


# --- the feature table -------------------------------------------------------


@query
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _epochs(_features(spark, sf_dir))


@query
def feature_table_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage by stage, joined on the visitor: what the one-pass plan must equal."""
    return _epochs(staged(_sessions(spark, sf_dir), TRAINING))


@query
def feature_table_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only sessions inside each visitor's window, here of seven days."""
    params = replace(TRAINING, lookback_filter=True, lookback_days=7)
    return _epochs(_features(spark, sf_dir, params))


@query
def holdout_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _epochs(_features(spark, sf_dir, HOLDOUT))


# The last window shares days with both others.
WINDOWS = {
    "training": TRAINING,
    "holdout": HOLDOUT,
    "middle": FeatureParams(session_start="20170315", session_end="20170326"),
}


def _visitor_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of all days of the windows, written in two lots and read back."""
    folder = table_path(spark, "visitor-days")
    for days in (TRAINING, HOLDOUT):
        states = daily_state.visitor_days(_sessions(spark, sf_dir, days), days)
        daily_state.write_visitor_days(states, folder)
    return daily_state.read_visitor_days(spark, folder)


@query
def feature_table_from_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table from stored daily states, sessions not read again."""
    return _epochs(daily_state.feature_table_from_days(_visitor_days(spark, sf_dir), TRAINING))


@query
def features_of_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training, holdout and an overlapping window from one scan of the daily states."""
    return _epochs(daily_state.features_of_windows(_visitor_days(spark, sf_dir), WINDOWS))


def _written_features(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return replace_table(_features(spark, sf_dir), name, table_path(spark, name))


def _unique(name: str) -> str:
    """A table name no other caller of the same session uses."""
    return f"{name}_{uuid.uuid4().hex}"


@query
def feature_table_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table replaced by name and read back."""
    return _epochs(_written_features(spark, sf_dir, _unique("footfall_features")))


@query
def training_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and inputs of the written table."""
    name = _unique("footfall_training")
    _written_features(spark, sf_dir, name)
    return features.training_projection(read_table(spark, name))


@query
def train_eval_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = split(_features(spark, sf_dir))
    return rows.select(VISITOR, "labels", F.col("is_eval").cast("int").alias("is_eval"))


@query
def feature_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = correlate(materialize(_features(spark, sf_dir), "features"))
    return pairs.withColumn("correlation", F.round("correlation", 6) + 0.0)


@query
def collinearity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the other inputs leave of each one; exact relations named, not failing."""
    found = collinear(_inputs(spark, sf_dir))
    left = F.round("tolerance", 6) + 0.0
    return found.select(
        "processed_input",
        "category",
        left.alias("tolerance"),
        F.col("singular_group").isNotNull().alias("singular"),
    )


# --- scoring and metrics with fixed weights ----------------------------------

# A logistic model with made-up weights: SQL can compute the same scores.
LINEAR_INTERCEPT = -0.4
LINEAR_WEIGHTS = {
    "coalesce(timeOnSite_per_visit, 0)": 0.00003,
    "coalesce(device_deviceCategory_mobile, 0)": 0.5,
    "coalesce(device_browser_Chrome, 0)": -0.25,
    "coalesce(channelGrouping_Paid_Search, 0)": 0.3,
    "coalesce(channelGrouping_Affiliates, 0)": -0.6,
    "coalesce(hitspagepagePathLevel2_brands, 0)": 0.2,
    "CASE WHEN day = 'Monday' THEN 1 ELSE 0 END": 0.15,
    "CASE WHEN daypart = 'evening_19_23' THEN 1 ELSE 0 END": -0.35,
}


def linear_logit() -> str:
    """The weighted sum as SQL, the same text for every engine."""
    terms = [f"CAST({w} AS DOUBLE) * ({x})" for x, w in LINEAR_WEIGHTS.items()]
    return " + ".join([f"CAST({LINEAR_INTERCEPT} AS DOUBLE)", *terms])


def _linear_probability() -> Column:
    return F.round(1 / (1 + F.exp(-F.expr(linear_logit()))), 6)


def _linear_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir)
    scores = rows.select(VISITOR, "labels", _linear_probability().alias("probability"))
    return materialize(scores, "scores")


@query
def linear_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir).withColumn("probability", _linear_probability())
    scored = scoring.with_predictions(rows, "probability")
    return scored.select(VISITOR, "predicted_labels", "probability")


@query
def positive_class_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _features(spark, sf_dir).withColumn("p", _linear_probability())
    return scoring.positive_class_probability(scoring.with_predictions(rows, "p"))


@query
def score_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_deciles(_linear_scores(spark, sf_dir).drop("labels"))


@query
def segment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = scoring.segment_summary(scoring.score_deciles(_linear_scores(spark, sf_dir)))
    rounded = ["avg_probability", "conversion_rate", "lift"]
    return segments.withColumns({c: F.round(c, 6) for c in rounded})


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(_linear_scores(spark, sf_dir))


@query
def roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_curve(_linear_scores(spark, sf_dir))


@query
def roc_at_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.roc_at_quantiles(_linear_scores(spark, sf_dir))


@query
def rated_by_borders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors of the later days, rated by decile borders of the earlier ones."""
    borders = scoring.decile_borders(scoring.score_deciles(_linear_scores(spark, sf_dir).drop("labels")))
    visitors = _features(spark, sf_dir, HOLDOUT).select(VISITOR, _linear_probability().alias("probability"))
    return scoring.rate_by_borders(visitors, borders)


@query
def evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.evaluate(_linear_scores(spark, sf_dir))
    return report.select([F.round(c, 6).alias(c) for c in report.columns])


# --- the model of all inputs -------------------------------------------------

L1_OF_THE_MODEL = 1.0
#: A violation per row below this counts as none.
OPTIMAL = 1e-7


def _inputs(spark: SparkSession, sf_dir: str) -> path.Inputs:
    return path.prepare_inputs(materialize(split(_features(spark, sf_dir)), "features"))


def _model(spark: SparkSession, sf_dir: str) -> tuple[path.Inputs, path.PathModel]:
    inputs = _inputs(spark, sf_dir)
    return inputs, path.fit_path(inputs, [L1_OF_THE_MODEL])[L1_OF_THE_MODEL]


@query
def train_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on all inputs, save, load; what the loaded model is, checked against the rows."""
    inputs, fitted = _model(spark, sf_dir)
    folder = table_path(spark, "model")
    path.save_path([fitted], folder)
    model = path.load_path(spark, folder)[L1_OF_THE_MODEL]
    checked = path.certificate([model], inputs)
    return checked.groupBy("l1").agg(
        F.lit("logistic_reg").alias("model_type"),
        F.lit(inputs.n).cast("long").alias("n_rows"),
        F.lit(len(inputs.names)).alias("n_inputs"),
        F.round(F.lit(model.log[-1].objective), 6).alias("objective"),
        (F.max("violation") < OPTIMAL).alias("optimal"),
        F.lit(model.converged).alias("converged"),
    )


@query
def training_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Losses of training and held-out rows before the first step and at the end."""
    _, model = _model(spark, sf_dir)
    log = path.training_log([model])
    ends = [
        F.round(by(loss, "iteration"), 6).alias(f"{when}_{loss}")
        for loss in ("loss", "eval_loss")
        for when, by in (("first", F.min_by), ("final", F.max_by))
    ]
    never_up = F.bool_and(F.expr("objective_before IS NULL OR objective <= objective_before + 1e-12"))
    steps = log.withColumn(
        "objective_before", F.lag("objective").over(Window.partitionBy("l1").orderBy("iteration"))
    )
    return steps.groupBy("l1").agg(
        *ends, never_up.alias("falls"), F.bool_and("converged").alias("converged")
    )


@query
def model_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _model(spark, sf_dir)
    weights = path.weights_table([model]).drop("l1")
    return weights.withColumn("weight", F.round("weight", 4) + 0.0)


@query
def optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gradient of every input at the models of all penalties, against the penalty."""
    inputs = _inputs(spark, sf_dir)
    strengths = [l1 for l1 in training.L1_STRENGTHS if l1]
    checked = path.certificate(list(path.fit_path(inputs, strengths).values()), inputs)
    return checked.select(
        "l1",
        "processed_input",
        "category",
        (F.round("gradient", 4) + 0.0).alias("gradient"),
        (F.col("violation") < OPTIMAL).alias("optimal"),
    )


def _holdout_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs, model = _model(spark, sf_dir)
    visitors = _features(spark, sf_dir, HOLDOUT).drop("labels")
    scored = path.with_probability(model, inputs.prepare, visitors)
    return scored.select(VISITOR, F.round("probability", 4).alias("probability"))


@query
def predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors of the later days, scored by the model of the earlier ones."""
    scored = scoring.with_predictions(_holdout_scores(spark, sf_dir), "probability")
    return scored.select(VISITOR, "predicted_labels", "probability")


@query
def predicted_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training, scoring and deciles in one go."""
    return scoring.score_deciles(materialize(_holdout_scores(spark, sf_dir), "scores"))


@query
def l1_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six strengths from the same passes: objective, proof, quality on the held-out rows.

    Without penalty there may be no best model (visitors told apart perfectly), so that numbers of it
    depend on where the fit ends; of that one only the proof is shown.
    """
    inputs = _inputs(spark, sf_dir)
    models = path.fit_path(inputs)
    proofs = path.certificate(list(models.values()), inputs).groupBy("l1").agg(
        (F.max("violation") < OPTIMAL).alias("optimal")
    )
    held_out = inputs.rows.where("is_eval")
    reports = [
        metrics.evaluate(held_out.withColumn("probability", path.probability(m, F.col("x")))).select(
            F.lit(m.l1).alias("l1"),
            F.lit(m.converged).alias("converged"),
            *[
                F.round(F.when(F.lit(m.l1 > 0), value), 4).alias(name)
                for name, value in (
                    ("objective", F.lit(m.log[-1].objective)),
                    ("accuracy", F.col("accuracy")),
                    ("log_loss", F.col("log_loss")),
                    ("roc_auc", F.col("roc_auc")),
                )
            ],
        )
        for m in models.values()
    ]
    return reduce(DataFrame.unionAll, reports).join(proofs, "l1")


# --- fitted models of one input ----------------------------------------------

# Documents and their quality label: rows with a signal, and few enough inputs for SQL to
# fit the same models. Ids are called as in the feature table.

EXACT = training.FitOptions(tolerance=1e-12)
ONE_TREE = training.FitOptions(boosted_trees=1, forest_trees=1, forest_bootstrap=False, tree_depth=1)
LONG_DOCUMENT = 1000
SWEPT_STRENGTHS = (0, 1, 5, 1000)
STRONG_PENALTY = 50


def _documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and holdout rows: logarithm of the length, whether it is long or English, label."""
    labeled = spark.read.parquet(f"{sf_dir}/labels.parquet").join(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id"
    )
    rows = labeled.select(
        F.col("doc_id").cast("string").alias(VISITOR),
        F.col("quality").alias("labels"),
        F.log1p("n_chars").alias("log_length"),
        (F.col("n_chars") >= LONG_DOCUMENT).cast("int").alias("is_long"),
        F.coalesce(F.col("lang") == "en", F.lit(False)).cast("int").alias("is_english"),
    )
    rows = materialize(split(rows.where("quality IS NOT NULL")), "documents")
    return rows.where("not is_eval"), rows.where("is_eval")


def _by_length(rows: DataFrame, **more: object) -> dict[tuple[str, float], training.FittedModel]:
    return training.fit(rows, options=EXACT, numbers=["log_length"], categories={}, **more)


@query
def train_logistic_one_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit, save, load; one row describing the model."""
    rows, _ = _documents(spark, sf_dir)
    folder = table_path(spark, "model")
    training.save_model(_by_length(rows)["logistic_reg", 1], folder)
    model = training.load_model(spark, folder)
    weights = model.classifier
    return spark.createDataFrame(
        [(model.model_type, float(model.l1), float(weights.coefficients[0]), weights.intercept, model.converged)],
        "model_type string, l1 double, weight double, intercept double, converged boolean",
    ).withColumns({c: F.round(c, 4) for c in ("weight", "intercept")})


@query
def training_info_one_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loss a fit starts from and the one it ends with."""
    rows, _ = _documents(spark, sf_dir)
    info = training.training_info(_by_length(rows)["logistic_reg", 1])
    ends = info.agg(
        F.min_by("loss", "iteration").alias("first_loss"),
        F.max_by("loss", "iteration").alias("final_loss"),
        F.bool_and("converged").alias("converged"),
    )
    return ends.withColumns({c: F.round(c, 6) for c in ("first_loss", "final_loss")})


@query
def model_weights_one_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _documents(spark, sf_dir)
    weights = training.model_weights(_by_length(rows)["logistic_reg", 1], rows)
    return weights.withColumn("weight", F.round("weight", 4))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, held_out = _documents(spark, sf_dir)
    model = _by_length(rows)["logistic_reg", 1]
    return scoring.predict(model.pipeline, held_out.select(VISITOR, "log_length"))


@query
def predict_one_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the holdout, scored by a model of the training rows."""
    predictions = _predictions(spark, sf_dir)
    chance = F.filter("predicted_labels_probs", lambda c: c.label == 1)[0].prob
    return predictions.select(
        VISITOR, "predicted_labels", F.round(chance, 4).alias("probability")
    )


@query
def predicted_deciles_one_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training, scoring and deciles in one go."""
    probabilities = scoring.positive_class_probability(_predictions(spark, sf_dir))
    rounded = probabilities.withColumn("probability", F.round("probability", 4))
    return scoring.score_deciles(materialize(rounded, "scores"))


@query
def l1_sweep_one_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models of several strengths: their weight, and their quality on the holdout."""
    rows, held_out = _documents(spark, sf_dir)
    models = _by_length(rows, l1_strengths=SWEPT_STRENGTHS)
    weights = spark.createDataFrame(
        [(f"{m.l1:g}", float(m.classifier.coefficients[0])) for m in models.values()],
        "L1 string, weight double",
    )
    report = training.compare(models, held_out).join(weights, "L1")
    numbers = ["weight", "accuracy", "log_loss", "roc_auc"]
    return report.select("L1", "converged", *[F.round(c, 4).alias(c) for c in numbers])


@query
def train_tree_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tree families, one tree of one split: the probability on each side."""
    rows, _ = _documents(spark, sf_dir)
    families = ("boosted_tree_classifier", "random_forest_classifier")
    models = training.fit(
        rows, model_types=families, options=ONE_TREE, numbers=["is_long"], categories={}
    )
    scored = [
        scoring.predict(model.pipeline, rows)
        .select("is_long", F.inline("predicted_labels_probs"))
        .where("label = 1")
        .groupBy(F.lit(family).alias("model_type"), "is_long")
        .agg(F.round(F.max("prob"), 6).alias("probability"))
        for (family, _), model in models.items()
    ]
    return scored[0].unionAll(scored[1])


# Without penalty the best model of two binary inputs gives each of the four cells its own rate.
SATURATED = wide_deep.DeepOptions(hidden=6, l2=0.0, tolerance=1e-6, max_passes=1000)


@query
def train_deep_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide-and-deep and deep classifier on two inputs and what they say together.

    The expected positives of a cell are a whole number at the optimum, so rounding meets no tie.
    """
    training_rows, held_out = _documents(spark, sf_dir)
    cell = ["is_long", "is_english"]
    inputs = path.prepare_inputs(training_rows.unionAll(held_out), cell, {})
    scored = []
    for wide in (True, False):
        model = wide_deep.fit(inputs, replace(SATURATED, wide=wide))
        cells = training_rows.groupBy(*cell).agg(F.count("*").alias("n"))
        cells = wide_deep.with_probability(model, inputs.prepare, cells)
        expected = F.round(F.col("probability") * F.col("n")).cast("long").alias("expected_positives")
        scored.append(cells.select(F.lit(model.model_type).alias("model_type"), *cell, "n", expected))
    return scored[0].unionAll(scored[1])


@query
def strong_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All model inputs, and a penalty that leaves none: everybody gets the base rate."""
    rows = materialize(split(_features(spark, sf_dir)), "features").where("not is_eval")
    model = training.fit(rows, l1_strengths=(STRONG_PENALTY,))["logistic_reg", STRONG_PENALTY]
    predictions = scoring.predict(model.pipeline, _features(spark, sf_dir, HOLDOUT))
    probabilities = scoring.positive_class_probability(predictions)
    return probabilities.withColumn("probability", F.round("probability", 4))
