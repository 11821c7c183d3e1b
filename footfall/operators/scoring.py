"""From a fitted model to purchase probabilities, deciles and segments."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.operators.ntile import exact_ntile
from footfall.vocabulary import VISITOR

THRESHOLD = 0.5


def with_predictions(df: DataFrame, probability: str, threshold: float = THRESHOLD) -> DataFrame:
    """Add predicted label and per-class probabilities, given P(label = 1)."""
    p = F.col(probability)
    per_class = F.array(
        F.struct(F.lit(1).alias("label"), p.alias("prob")),
        F.struct(F.lit(0).alias("label"), (1 - p).alias("prob")),
    )
    return df.withColumns(
        {
            "predicted_labels": F.when(p >= threshold, 1).otherwise(0),
            "predicted_labels_probs": per_class,
        }
    )


def predict(model: Transformer, visitors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The input columns, without any label, and the model's predictions."""
    inputs = visitors.drop("labels")
    scored = model.transform(inputs).withColumn(
        "probability", vector_to_array("probability").getItem(1)
    )
    return with_predictions(scored, "probability", threshold).select(
        *inputs.columns, "predicted_labels", "predicted_labels_probs"
    )


def positive_class_probability(predictions: DataFrame, id_col: str = VISITOR) -> DataFrame:
    """One row per visitor: the probability of class 1.

    The outer form of the unnesting, as the filter drops its NULL rows anyway:
    for the inner one Spark adds a filter on the array's size and computes the
    whole prediction a second time for it.
    """
    classes = predictions.select(id_col, F.inline_outer("predicted_labels_probs"))
    return classes.where("label = 1").select(id_col, F.col("prob").alias("probability"))


def score_deciles(probabilities: DataFrame, id_col: str = VISITOR) -> DataFrame:
    """Visitors with their decile: 1 holds the most likely buyers, 10 the least."""
    return exact_ntile(probabilities, 10, "probability", id_col, "decile")


def segment_summary(scores: DataFrame) -> DataFrame:
    """Size and probability range of each decile.

    If ``scores`` still knows the outcome (``labels``), also the conversion
    rate and how far it lies above the overall one.
    """
    aggregates = [
        F.count("*").alias("visitors"),
        F.min("probability").alias("min_probability"),
        F.avg("probability").alias("avg_probability"),
        F.max("probability").alias("max_probability"),
    ]
    if "labels" not in scores.columns:
        return scores.groupBy("decile").agg(*aggregates)
    segments = scores.groupBy("decile").agg(*aggregates, F.sum("labels").alias("buyers"))
    everyone = Window.partitionBy()
    overall = F.sum("buyers").over(everyone) / F.sum("visitors").over(everyone)
    rate = F.col("buyers") / F.col("visitors")
    return segments.withColumns(
        {"conversion_rate": rate, "lift": F.try_divide(rate, overall)}
    )


def decile_borders(deciles: DataFrame, id_col: str = VISITOR) -> DataFrame:
    """The last row of every decile but the last, in the order of ``score_deciles``; to keep with a model.

    One row per decile, whatever the number of visitors.
    """
    digest = F.md5(F.col(id_col).cast("string"))
    key = F.struct((-F.col("probability")).alias("p"), digest.alias("digest"), F.col(id_col).alias("id"))
    last = deciles.groupBy("decile").agg(F.max(key).alias("last"))
    return last.where("decile < 10").select(
        "decile", (-F.col("last.p")).alias("probability"), "last.digest", "last.id"
    )


def rate_by_borders(probabilities: DataFrame, borders: DataFrame, id_col: str = VISITOR) -> DataFrame:
    """Deciles of new visitors by stored borders: no ranking, one look at nine rows per visitor.

    Visitors of the scores that the borders come from get the deciles they had, ties included.
    A visitor without a probability is in the last decile.
    """
    kept = borders.orderBy("decile").collect()
    rank = F.lit(1)
    digest = F.md5(F.col(id_col).cast("string"))
    for row in kept:
        p = F.col("probability")
        tied = F.struct(digest, F.col(id_col)) > F.struct(F.lit(row.digest), F.lit(row.id))
        after = p.isNull() | (p < row.probability) | ((p == row.probability) & tied)
        rank = rank + F.when(after, 1).otherwise(0)
    return probabilities.withColumn("decile", rank)
