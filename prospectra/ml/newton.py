"""Logistic models with an L2 penalty by Newton's method, for many rows of few inputs.

The loss is strictly convex, so there is one best model, and a step of Newton's method gets to it in some ten passes
over the rows where a quasi-Newton solver takes hundreds, more the closer inputs are to depending on each other. A pass
adds up loss, gradient and second derivatives per task; sums are grouped by place, so the driver gets one matrix as wide
as the inputs, whatever the number of tasks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from prospectra.functions import named

#: Inputs up to which the matrix of second derivatives is small.
MAX_WIDTH = 64


def _blocks(rows: DataFrame, label: str, features: str, weight: str, width: int) -> DataFrame:
    """Rows of inputs, 1 for the intercept, label and weight as binary matrices, one per batch."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
            y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            if not np.isfinite(x).all():
                raise ValueError("inputs must be finite")
            block = np.column_stack([x, np.ones(len(x)), y, w])
            yield pa.record_batch([pa.array([block.tobytes()], pa.binary())], ["block"])

    taken = rows.select(
        vector_to_array(named(features)).alias("x"), named(label).cast("double").alias("y"), named(weight).alias("w")
    )
    return taken.mapInArrow(pack, "block binary")


def _sums(blocks: DataFrame, point: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted loss at `point`, its gradient and its second derivatives, added up over all rows."""
    size = len(point)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + size + size * size)
        for batch in batches:
            for value in batch.column(0):
                block = np.frombuffer(value.as_buffer(), np.float64).reshape(-1, size + 2)
                x, y, w = block[:, :size], block[:, size], block[:, size + 1]
                margin = x @ point
                p = 1.0 / (1.0 + np.exp(-np.clip(margin, -700.0, 700.0)))
                total[0] += w @ (np.logaddexp(0.0, margin) - y * margin)
                total[1 : 1 + size] += x.T @ (w * (p - y))
                total[1 + size :] += ((x * (w * p * (1.0 - p))[:, None]).T @ x).ravel()
        yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["place", "value"])

    added = blocks.mapInArrow(add_up, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    table = added.toArrow().sort_by("place").column("value").to_numpy()
    return float(table[0]), table[1 : 1 + size], table[1 + size :].reshape(size, size)


def fit_newton(
    rows: DataFrame, classifier: LogisticRegression, width: int, total: float, positive: float
) -> LogisticRegressionModel:
    """The model that `classifier` would fit; `total` and `positive` are the weights of all rows and of those of label 1."""
    label, features, weight = classifier.getLabelCol(), classifier.getFeaturesCol(), classifier.getWeightCol()
    blocks = _blocks(rows, label, features, weight, width).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        point = _minimum(blocks, classifier, width, total, positive)
    finally:
        blocks.unpersist()
    spark = SparkSession.active()
    java = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        f"LogisticRegression_{uuid.uuid4().hex[:12]}",
        _py2java(spark.sparkContext, Vectors.dense(point[:width])),
        float(point[width]),
    )
    return classifier._copyValues(LogisticRegressionModel(java))


def _minimum(
    blocks: DataFrame, classifier: LogisticRegression, width: int, total: float, positive: float
) -> np.ndarray:
    free = np.arange(width + 1 if classifier.getFitIntercept() else width)
    ridge = np.full(width + 1, classifier.getRegParam())
    ridge[width] = 0.0
    point, step, last = np.zeros(width + 1), None, np.inf
    if classifier.getFitIntercept():
        point[width] = np.log(positive / (total - positive))
    for _ in range(classifier.getMaxIter()):
        loss, slope, bend = _sums(blocks, point)
        loss = loss / total + 0.5 * (ridge * point) @ point
        if step is not None and loss > last * (1 + 1e-12):  # too far: back by half of the step
            step /= 2
            point = point - step
            continue
        slope = (slope / total + ridge * point)[free]
        bend = (bend / total + np.diag(ridge))[np.ix_(free, free)]
        # Inputs of any scale; a direction that the sums cannot tell from flat is left alone.
        scale = 1.0 / np.sqrt(np.maximum(np.diag(bend), np.finfo(float).tiny))
        move = scale * np.linalg.lstsq(bend * scale[:, None] * scale, -slope * scale, rcond=None)[0]
        last, step = loss, np.zeros(width + 1)
        step[free] = move
        point = point + step
        if -0.5 * slope @ move <= classifier.getTol() * abs(loss):  # what is left to gain
            break
    return point
