"""Top-k reports and the link from predictions back to their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prospectra.functions import named


def top_prospects(predictions: DataFrame, n: int = 100, id_column: str = "id") -> DataFrame:
    """The `n` most likely conversions; equal probabilities go by id.

    Planned as a top-k per task and a merge of those, not as a sort of all rows.
    """
    return predictions.orderBy(F.desc("probability"), named(id_column).asc()).limit(n)


def top_features(importance: DataFrame, n: int = 20) -> DataFrame:
    """The `n` most important features; equal ones by name."""
    return importance.orderBy(F.desc("importance"), F.asc("feature")).limit(n)


def join_predictions(rows: DataFrame, predictions: DataFrame, id_column: str = "id") -> DataFrame:
    """Predictions beside the rows they were made for."""
    return rows.join(predictions, id_column)
