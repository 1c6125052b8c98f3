"""Metrics of whole runs, and the comparison of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prospectra.functions import named
from prospectra.operators.curves import area_metrics
from prospectra.operators.metrics import (
    LABEL,
    SCORE,
    classification_metrics,
    threshold_predictions,
)

RUN_METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision")


def all_metrics(
    scored: DataFrame, threshold: float = 0.5, label: str = LABEL, score: str = SCORE
) -> DataFrame:
    """One row with all of `RUN_METRICS`; the threshold applies to the score."""
    predicted = threshold_predictions(scored, threshold, score)
    return with_areas(classification_metrics(predicted, label), area_metrics(scored, label, score))


def with_areas(metrics: DataFrame, areas: DataFrame) -> DataFrame:
    """Two tables of one row each as one."""
    areas = areas.select(F.struct("*").alias("areas"))
    return metrics.withColumn("_areas", areas.scalar()).select(
        "accuracy", "precision", "recall", "f1", "_areas.*"
    )


def metrics_table(metrics: DataFrame, run_id: str, run_time: str) -> DataFrame:
    """One-row metrics as (run_id, run_time, metric, value) rows."""
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("metric"), named(c).cast("double").alias("value"))
            for c in metrics.columns
        ]
    )
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_time).cast("timestamp_ntz").alias("run_time"),
        F.inline(rows),
    )


def run_comparison(metrics: DataFrame) -> DataFrame:
    """All runs of a metrics table, one row each, oldest first."""
    wide = metrics.groupBy("run_id", "run_time").pivot("metric", list(RUN_METRICS))
    return wide.agg(F.max("value")).orderBy("run_time", "run_id")


def best_run(metrics: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The run with the highest value of a metric; the earliest of equals."""
    rank = F.struct((-F.col("value")).alias("value"), "run_time", "run_id")
    found = metrics.where((F.col("metric") == metric) & F.col("value").isNotNull())
    return found.agg(F.min(rank).alias("best")).select(
        "best.run_id", "best.run_time", (-F.col("best.value")).alias(metric)
    )
