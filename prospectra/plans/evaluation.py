"""All evaluation tables of a set of predictions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from prospectra.operators.cleaning import LABEL
from prospectra.operators.curves import (
    areas_of_steps,
    pr_of_steps,
    roc_of_steps,
    score_counts,
    with_running_totals,
)
from prospectra.operators.metrics import (
    best_thresholds,
    business_of_counts,
    counts_at,
    histogram_of_tally,
    matrix_of_counts,
    metrics_of_counts,
    report_of_counts,
    thresholds_of_tally,
)
from prospectra.operators.runs import with_areas
from prospectra.sources.scratch import materialize


@dataclass(frozen=True)
class Evaluation:
    metrics: DataFrame
    confusion: DataFrame
    report: DataFrame
    business: DataFrame
    best_threshold: DataFrame
    roc: DataFrame
    precision_recall: DataFrame
    histogram: DataFrame


def evaluate(
    predictions: DataFrame,
    threshold: float = 0.5,
    label: str = LABEL,
    score: str = "probability",
    conversion_value: float = 100.0,
    contact_cost: float = 1.0,
) -> Evaluation:
    """Metrics at a threshold, curves, histogram and the best threshold by f1.

    The predictions are read once, so the model scores each row once: classes are counted per
    distinct score, running totals added, and all tables follow from this one, which is in scratch.
    Rows whose score is NULL or NaN are left out of all of them.
    """
    tally = materialize(score_counts(predictions, label, score), "score-counts")
    steps = materialize(with_running_totals(tally), "score-steps")
    found = counts_at(steps, threshold)
    counts = predictions.sparkSession.createDataFrame(found.collect(), found.schema)  # four numbers
    return Evaluation(
        metrics=with_areas(metrics_of_counts(counts), areas_of_steps(steps)),
        confusion=matrix_of_counts(counts),
        report=report_of_counts(counts),
        business=business_of_counts(counts, conversion_value, contact_cost),
        best_threshold=best_thresholds(thresholds_of_tally(steps), ["f1"]).drop("metric"),
        roc=roc_of_steps(steps),
        precision_recall=pr_of_steps(steps),
        histogram=histogram_of_tally(steps),
    )
