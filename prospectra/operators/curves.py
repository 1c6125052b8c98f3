"""Exact ROC and precision-recall curves, and the areas under them.

The rows are first reduced to positives and negatives per distinct score; running totals over the
scores then come from `running_totals`, so no task sees all scores. Of a step table (`score_steps`)
that is there already, the functions named `..._of_steps` make the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prospectra.functions import named, nan_to_null
from prospectra.operators.metrics import LABEL, SCORE
from prospectra.operators.prefix import running_totals


def score_steps(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """Per distinct score, from the highest down: pos, neg and the totals at or above it (tp, fp).

    Rows whose score is NULL or NaN have no place in the order and are left out.
    """
    return with_running_totals(score_counts(scored, label, score))


def score_counts(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """(score, pos, neg) per distinct score, NULL and NaN included."""
    return scored.groupBy(named(score).alias("score")).agg(
        F.count_if(named(label) == 1).alias("pos"), F.count_if(named(label) == 0).alias("neg")
    )


def with_running_totals(counts: DataFrame) -> DataFrame:
    """`score_counts` with tp and fp; NULL and NaN are left out."""
    placed = counts.where(nan_to_null(F.col("score")).isNotNull())
    steps = running_totals(placed, ["score"], ["pos", "neg"], descending=True)
    return steps.withColumnsRenamed({"cum_pos": "tp", "cum_neg": "fp"})


def _with_totals(steps: DataFrame) -> DataFrame:
    totals = steps.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("totals"))
    return steps.withColumn("_totals", totals.scalar())


def area_metrics(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """One row: roc_auc and average_precision, from one pass.

    roc_auc counts equal scores half and is NULL with one class only. average_precision is the
    precision at each distinct score, weighted by the recall it adds, and 0 without a positive.
    """
    return areas_of_steps(score_steps(scored, label, score))


def areas_of_steps(steps: DataFrame) -> DataFrame:
    area = F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2.0)
    gain = F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")).cast("double"))
    positives, negatives = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    return steps.agg(
        F.try_divide(F.sum(area), positives * negatives).alias("roc_auc"),
        F.coalesce(F.try_divide(F.sum(gain), positives), F.lit(0.0)).alias("average_precision"),
    )


def roc_auc(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    return area_metrics(scored, label, score).select("roc_auc")


def average_precision(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    return area_metrics(scored, label, score).select("average_precision")


def roc_curve(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the origin at an infinite threshold."""
    return roc_of_steps(score_steps(scored, label, score))


def roc_of_steps(steps: DataFrame) -> DataFrame:
    points = _with_totals(steps).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp"), F.col("_totals.n")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("_totals.p")).alias("tpr"),
    )
    origin = steps.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def pr_curve(scored: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """(threshold, precision, recall) per distinct score, and the end point (1, 0) without threshold."""
    return pr_of_steps(score_steps(scored, label, score))


def pr_of_steps(steps: DataFrame) -> DataFrame:
    points = _with_totals(steps).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        # Without positives recall is defined as 1 throughout.
        F.coalesce(F.try_divide(F.col("tp"), F.col("_totals.p")), F.lit(1.0)).alias("recall"),
    )
    end = steps.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)
