"""Fit classifiers on the feature table.

Choices the features leave open: NULL numbers become the training mean (0 where
there is no value at all), an unknown weekday or daypart is a category of its own,
and features are scaled inside the fit. Fits end by their tolerance; one that
reaches its limit of iterations says so (``converged``). An L1 strength is spread over the training rows, because Spark
minimises the mean loss and not the summed one.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.columns import FLAGS, LABEL, RATIOS
from footfall.functions.clock import DAYPART_NAMES
from footfall.operators.metrics import evaluate
from footfall.sources.workspace import delete_folder, folder_exists, materialize
from footfall.vocabulary import WEEKDAYS

NUMBERS = [*RATIOS, *FLAGS]
CATEGORIES = {"day": WEEKDAYS, "daypart": DAYPART_NAMES}
L1_STRENGTHS = (0, 1, 10, 50, 100, 1000)
MODEL_TYPES = (
    "logistic_reg",
    "boosted_tree_classifier",
    "random_forest_classifier",
    "dnn_classifier",
)

_FILLED, _INDEX, _ONE_HOT = "filled__", "index__", "onehot__"


@dataclass
class FittedModel:
    """A fitted pipeline and what is known about its training."""

    pipeline: PipelineModel
    model_type: str
    l1: float
    losses: list[float] = field(default_factory=list)
    #: False if the fit ended at its limit of iterations; trees have no such limit.
    converged: bool = True

    @property
    def classifier(self) -> Model:
        return self.pipeline.stages[-1]


def fit_preprocessing(
    training: DataFrame,
    numbers: Sequence[str] = NUMBERS,
    categories: Mapping[str, Sequence[str]] = CATEGORIES,
) -> PipelineModel:
    """Feature columns to one vector column ``features``, means taken from ``training``.

    The category lists are fixed, so the vector has the same layout in every
    fit and indexing needs no pass over the data.
    """
    means = training.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in numbers]).first()
    filled = ", ".join(
        f"coalesce(CAST(`{c}` AS DOUBLE), {means[c] or 0.0!r}D) AS `{_FILLED}{c}`" for c in numbers
    )
    stages = [SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")]
    one_hot = [_ONE_HOT + c for c in categories]
    if categories:
        stages += [
            StringIndexerModel.from_arrays_of_labels(
                [list(names) for names in categories.values()],
                inputCols=list(categories),
                outputCols=[_INDEX + c for c in categories],
                handleInvalid="keep",
            ),
            OneHotEncoder(
                inputCols=[_INDEX + c for c in categories], outputCols=one_hot, dropLast=False
            ),
        ]
    stages.append(
        VectorAssembler(inputCols=[_FILLED + c for c in numbers] + one_hot, outputCol="features")
    )
    return Pipeline(stages=stages).fit(training)


def feature_names(vectors: DataFrame) -> list[str]:
    """Names of the vector's entries, in order: ``column`` or ``column=category``."""
    groups = vectors.schema["features"].metadata["ml_attr"]["attrs"].values()
    named = sorted((a["idx"], a["name"]) for attrs in groups for a in attrs)
    return [_readable(name) for _, name in named]


def _readable(name: str) -> str:
    if name.startswith(_ONE_HOT):
        column, _, category = name.removeprefix(_ONE_HOT).partition("_")
        return f"{column}={category}"
    return name.removeprefix(_FILLED)


@dataclass(frozen=True)
class FitOptions:
    """What a family needs to know besides its L1 strength.

    ``max_iter`` is a guard against a fit that never settles, not a way to end one.
    """

    max_iter: int = 10_000
    tolerance: float = 1e-6
    boosted_trees: int = 20
    forest_trees: int = 20
    forest_bootstrap: bool = True
    tree_depth: int = 5
    hidden: int = 32
    seed: int = 0


def make_classifier(
    model_type: str, l1: float, n_rows: int, n_features: int, options: FitOptions
) -> Estimator:
    """The estimator of a classifier family; only the logistic one takes an L1 strength."""
    columns = {"featuresCol": "features", "labelCol": LABEL}
    trees = {"seed": options.seed, "maxDepth": options.tree_depth}
    iterations = {"maxIter": options.max_iter, "tol": options.tolerance}
    if model_type == "logistic_reg":
        return LogisticRegression(
            **columns, **iterations, elasticNetParam=1.0, regParam=l1 / max(n_rows, 1)
        )
    if model_type == "boosted_tree_classifier":
        return GBTClassifier(**columns, **trees, maxIter=options.boosted_trees)
    if model_type == "random_forest_classifier":
        return RandomForestClassifier(
            **columns, **trees, numTrees=options.forest_trees, bootstrap=options.forest_bootstrap
        )
    if model_type == "dnn_classifier":
        return MultilayerPerceptronClassifier(
            **columns, **iterations, seed=options.seed, layers=[n_features, options.hidden, 2]
        )
    raise ValueError(f"unknown model type {model_type!r}, expected one of {MODEL_TYPES}")


def fit(
    training: DataFrame,
    model_types: Iterable[str] = ("logistic_reg",),
    l1_strengths: Iterable[float] = (1,),
    options: FitOptions = FitOptions(),
    numbers: Sequence[str] = NUMBERS,
    categories: Mapping[str, Sequence[str]] = CATEGORIES,
) -> dict[tuple[str, float], FittedModel]:
    """One model per family and L1 strength, keyed by both.

    The rows are turned into vectors once and written down; every iteration of
    every fit reads those. ``training`` itself is read twice, for the means
    and for the vectors.
    """
    prepare = fit_preprocessing(training, numbers, categories)
    vectors = prepare.transform(training).select(LABEL, "features")
    n_features = len(feature_names(vectors))
    vectors = materialize(vectors, "vectors")
    n_rows = vectors.count()
    models = {}
    for model_type in model_types:
        for l1 in l1_strengths:
            estimator = make_classifier(model_type, l1, n_rows, n_features, options)
            fitted = estimator.fit(vectors)
            pipeline = PipelineModel([*prepare.stages, fitted])
            losses = _losses(fitted)
            converged = len(losses) <= options.max_iter
            models[model_type, l1] = FittedModel(pipeline, model_type, l1, losses, converged)
    return models


def _losses(fitted: Model) -> list[float]:
    """Loss after each iteration; tree ensembles keep none."""
    if isinstance(fitted, LogisticRegressionModel):
        return [float(v) for v in fitted.summary.objectiveHistory]
    if isinstance(fitted, MultilayerPerceptronClassificationModel):
        return [float(v) for v in fitted.summary().objectiveHistory]
    return []


def score(model: FittedModel, visitors: DataFrame) -> DataFrame:
    """True label and P(label = 1) per row."""
    return _probabilities(model.pipeline.transform(visitors))


def _probabilities(scored: DataFrame) -> DataFrame:
    return scored.select(LABEL, vector_to_array("probability").getItem(1).alias("probability"))


def save_model(model: FittedModel, path: str) -> None:
    """Write the model with its training log, replacing one already there.

    Both go to a fresh version folder. A line appended to the list of versions makes it
    the current one, in a single commit; only then are former versions deleted.
    A save that fails leaves the former model as it was.
    """
    spark = SparkSession.active()
    former = _versions(spark, path)
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    model.pipeline.write().save(f"{path}/{version}/pipeline")
    _training_rows(model).write.parquet(f"{path}/{version}/training")
    listed = spark.createDataFrame([(version,)], "value string").coalesce(1)
    listed.write.mode("append").text(f"{path}/versions")
    for old in former:
        delete_folder(spark, f"{path}/{old}")


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Versions ever saved, oldest first."""
    if not folder_exists(spark, f"{path}/versions"):
        return []
    return sorted(r.value for r in spark.read.text(f"{path}/versions").collect())


def load_model(spark: SparkSession, path: str) -> FittedModel:
    folder = f"{path}/{_versions(spark, path)[-1]}"
    log = spark.read.parquet(f"{folder}/training").orderBy("iteration").collect()
    return FittedModel(
        PipelineModel.load(f"{folder}/pipeline"),
        log[0].model_type,
        log[0].l1,
        [row.loss for row in log if row.loss is not None],
        log[0].converged,
    )


def _training_rows(model: FittedModel) -> DataFrame:
    rows = [
        (model.model_type, float(model.l1), i, v, model.converged)
        for i, v in enumerate(model.losses or [None])
    ]
    return SparkSession.active().createDataFrame(
        rows, "model_type string, l1 double, iteration int, loss double, converged boolean"
    )


def training_info(model: FittedModel) -> DataFrame:
    """Loss (with penalty) after each iteration, and whether the fit came to its end."""
    return _training_rows(model).where("loss IS NOT NULL").select("iteration", "loss", "converged")


def model_weights(model: FittedModel, training: DataFrame, standardize: bool = True) -> DataFrame:
    """Weights of a logistic model, largest first.

    ``standardize`` multiplies each weight by its feature's standard deviation
    in ``training``, which makes them comparable.
    """
    if model.model_type != "logistic_reg":
        raise ValueError("only logistic models have weights")
    vectors = PipelineModel(model.pipeline.stages[:-1]).transform(training).select("features")
    names = feature_names(vectors)
    weights = [float(w) for w in model.classifier.coefficients.toArray()]
    if standardize:
        deviations = vectors.agg(Summarizer.std(F.col("features"))).first()[0].toArray()
        weights = [w * float(s) for w, s in zip(weights, deviations, strict=True)]
    rows = [
        *[(*_name_and_category(n), w) for n, w in zip(names, weights, strict=True)],
        ("__INTERCEPT__", None, float(model.classifier.intercept)),
    ]
    table = training.sparkSession.createDataFrame(
        rows, "processed_input string, category string, weight double"
    )
    return table.orderBy(F.desc("weight"), "processed_input", "category")


def _name_and_category(name: str) -> tuple[str, str | None]:
    column, _, category = name.partition("=")
    return column, category or None


def compare(models: dict[tuple[str, float], FittedModel], holdout: DataFrame) -> DataFrame:
    """One evaluation row per model, tagged with family and L1 strength.

    Models of one fit share their preprocessing; it runs once over ``holdout``.
    """
    vectors: dict[tuple[str, ...], DataFrame] = {}
    reports = []
    for (model_type, l1), model in models.items():
        prepare = model.pipeline.stages[:-1]
        key = tuple(stage.uid for stage in prepare)
        if key not in vectors:
            prepared = PipelineModel(prepare).transform(holdout).select(LABEL, "features")
            vectors[key] = materialize(prepared, "vectors")
        report = evaluate(_probabilities(model.classifier.transform(vectors[key])))
        tags = F.lit(model_type).alias("model_type"), F.lit(f"{l1:g}").alias("L1")
        reports.append(report.select(*tags, F.lit(model.converged).alias("converged"), "*"))
    return reduce(DataFrame.unionByName, reports)
