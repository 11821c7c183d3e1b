"""Quality of a classifier, from rows of true label and predicted probability.

Rows without a label or a probability say nothing and are left out everywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.sources.workspace import materialize

ROC_THRESHOLDS = tuple(i / 100 for i in range(101))


def _known(scored: DataFrame, label: str, probability: str) -> DataFrame:
    return scored.select(label, probability).where(
        F.col(label).isNotNull() & F.col(probability).isNotNull()
    )


def confusion_matrix(
    scored: DataFrame,
    label: str = "labels",
    probability: str = "probability",
    threshold: float = 0.5,
) -> DataFrame:
    """Rows: true label; columns: how often each label was predicted."""
    predicted = F.when(F.col(probability) >= threshold, 1).otherwise(0)
    return (
        _known(scored, label, probability)
        .select(F.col(label).alias("expected_label"), predicted.alias("predicted"))
        .groupBy("expected_label")
        .pivot("predicted", [0, 1])
        .count()
        .select(
            "expected_label",
            F.coalesce("0", F.lit(0)).alias("predicted_0"),
            F.coalesce("1", F.lit(0)).alias("predicted_1"),
        )
    )


def roc_curve(
    scored: DataFrame,
    label: str = "labels",
    probability: str = "probability",
    thresholds: Sequence[float] = ROC_THRESHOLDS,
) -> DataFrame:
    """Counts and rates when everything from a threshold upwards is called positive.

    Rows are counted by the interval between thresholds they fall in; the sums
    over intervals run on one row per threshold.
    """
    steps = sorted(set(thresholds))
    split = Bucketizer(
        splits=[float("-inf"), *steps, float("inf")], inputCol=probability, outputCol="step"
    )
    positive = F.col(label) == 1
    per_step = (
        split.transform(_known(scored, label, probability))
        .groupBy(F.col("step").cast("int").alias("step"))
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )
    grid = scored.sparkSession.range(len(steps) + 1, numPartitions=1).select(
        F.col("id").cast("int").alias("step"),
        F.get(F.lit([float(t) for t in steps]), F.col("id").cast("int") - 1).alias("threshold"),
    )
    from_here = Window.orderBy(F.desc("step"))
    everything = Window.partitionBy()
    pos, neg = F.coalesce("pos", F.lit(0)), F.coalesce("neg", F.lit(0))
    counts = grid.join(F.broadcast(per_step), "step", "left").select(
        "threshold",
        F.sum(pos).over(from_here).alias("true_positives"),
        F.sum(neg).over(from_here).alias("false_positives"),
        F.sum(pos).over(everything).alias("positives"),
        F.sum(neg).over(everything).alias("negatives"),
    )
    tp, fp = F.col("true_positives"), F.col("false_positives")
    return counts.where("threshold IS NOT NULL").select(
        "threshold",
        F.try_divide(tp, F.col("positives")).alias("recall"),
        F.try_divide(fp, F.col("negatives")).alias("false_positive_rate"),
        tp,
        fp,
        (F.col("negatives") - fp).alias("true_negatives"),
        (F.col("positives") - tp).alias("false_negatives"),
    )


def evaluate(
    scored: DataFrame,
    label: str = "labels",
    probability: str = "probability",
    threshold: float = 0.5,
) -> DataFrame:
    """One row: precision, recall, accuracy, F1, log loss, area under ROC.

    All come from one table of positives and negatives per distinct score. The area
    is exact: each positive counts the negatives below it, and half of those
    at the same score. It is NULL where one of the classes is absent.
    """
    y, p = F.col(label) == 1, F.col(probability)
    per_score = (
        _known(scored, label, probability)
        .groupBy(p.alias("p"))
        .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    )
    per_score = materialize(per_score, "per-score")
    p, pos, neg = F.col("p"), F.col("pos"), F.col("neg")
    called = p >= threshold
    inside = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), p))
    loss = -(pos * F.ln(inside) + neg * F.ln(1 - inside))

    def total(count: Column) -> Column:
        return F.coalesce(F.sum(count), F.lit(0))

    counts = negatives_below(per_score).agg(
        total(F.when(called, pos)).alias("tp"),
        total(F.when(called, neg)).alias("fp"),
        total(F.when(~called, pos)).alias("fn"),
        total(pos).alias("positives"),
        total(neg).alias("negatives"),
        F.sum(loss).alias("loss"),
        F.sum(pos * (F.col("below") + neg / 2)).alias("wins"),
    )
    tp, fp, fn = (F.col(c) for c in ("tp", "fp", "fn"))
    positives, negatives = F.col("positives"), F.col("negatives")
    n = positives + negatives
    return counts.select(
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(n - fp - fn, n).alias("accuracy"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        F.try_divide(F.col("loss"), n).alias("log_loss"),
        F.try_divide(F.col("wins"), positives.cast("double") * negatives).alias("roc_auc"),
    )


def running_counts(per_score: DataFrame) -> DataFrame:
    """``p``, ``pos``, ``neg``, and how many of both have a larger score (``pos_above``, ``neg_above``).

    Distinct scores are dealt out by range, however they are spread, so every task sorts an
    equal share of them; what lies above its range comes from one count per task. Counts
    don't depend on where the ranges end.
    """
    ranged = per_score.repartitionByRange("p").withColumn("part", F.spark_partition_id())
    # Written down: the number of a range must not change between its two readers.
    ranged = materialize(ranged, "scores")
    above = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("part").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    starts = starts.select(
        "part", *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_start") for c in ("pos", "neg")]
    )
    inside = Window.partitionBy("part").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, -1)
    counts = {
        f"{c}_above": F.col(f"{c}_start") + F.coalesce(F.sum(c).over(inside), F.lit(0))
        for c in ("pos", "neg")
    }
    # One row per task of the shuffle before.
    counted = ranged.join(F.broadcast(starts), "part").withColumns(counts)
    return counted.drop("part", "pos_start", "neg_start")


def negatives_below(per_score: DataFrame) -> DataFrame:
    """``p``, ``pos``, ``neg`` and how many negatives have a smaller score (``below``)."""
    everything = per_score.agg(F.sum("neg").alias("all_neg"))
    return (
        running_counts(per_score)
        .join(F.broadcast(everything))
        .withColumn("below", F.col("all_neg") - F.col("neg_above") - F.col("neg"))
        .select("p", "pos", "neg", "below")
    )


def roc_at_quantiles(
    scored: DataFrame, label: str = "labels", probability: str = "probability", steps: int = 100
) -> DataFrame:
    """The ROC curve at the scores that split the positives evenly.

    For each of ``steps`` shares of the positives the highest threshold that finds them: where
    buyers are rare and all scores small, a fixed grid of thresholds would show one step. At
    most ``steps`` rows; fewer where many positives share a score. Empty without positives.
    """
    y = F.col(label) == 1
    per_score = (
        _known(scored, label, probability)
        .groupBy(F.col(probability).alias("p"))
        .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    )
    per_score = materialize(per_score, "per-score")
    totals = per_score.agg(F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    counted = running_counts(per_score).join(F.broadcast(totals))
    tp, fp = F.col("pos_above") + F.col("pos"), F.col("neg_above") + F.col("neg")
    before, now = (F.floor(n * steps / F.col("positives")) for n in (F.col("pos_above"), tp))
    return counted.where((F.col("pos") > 0) & (now > before)).select(
        F.col("p").alias("threshold"),
        (tp / F.col("positives")).alias("recall"),
        F.try_divide(fp, F.col("negatives")).alias("false_positive_rate"),
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        (F.col("negatives") - fp).alias("true_negatives"),
        (F.col("positives") - tp).alias("false_negatives"),
    )
