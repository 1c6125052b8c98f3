"""Cross-validation."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from statistics import fmean, pstdev

from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prospectra.operators.cleaning import LABEL
from prospectra.operators.curves import roc_auc
from prospectra.operators.split import with_folds

CV_RESULT = "fold int, roc_auc double, cv_mean double, cv_std double"


def cross_validate(
    classifier: Estimator,
    rows: DataFrame,
    folds: int = 5,
    seed: int = 42,
    label: str = LABEL,
    key: str = "id",
    parallelism: int = 4,
) -> DataFrame:
    """ROC-AUC per stratified fold, with mean and population deviation over the folds.

    `rows` hold prepared features; they are read once per fold and side, so cache them. The folds
    are independent jobs and run `parallelism` at a time.
    """
    folded = with_folds(rows, folds, seed, key, label)

    def score(fold: int) -> float | None:
        model = classifier.fit(folded.where(F.col("fold") != fold))
        held_out = model.transform(folded.where(F.col("fold") == fold))
        probability = vector_to_array("probability")[1]
        return roc_auc(held_out.withColumn("_p", probability), label, "_p").first()["roc_auc"]

    with ThreadPoolExecutor(parallelism) as pool:
        # Each in a copy of the context, so that their scratch belongs to the caller's run.
        running = [pool.submit(copy_context().run, score, fold) for fold in range(folds)]
        scores = [job.result() for job in running]
    known = [s for s in scores if s is not None]
    mean, deviation = (fmean(known), pstdev(known)) if known else (None, None)
    return rows.sparkSession.createDataFrame(
        [(i, s, mean, deviation) for i, s in enumerate(scores)], CV_RESULT
    )
