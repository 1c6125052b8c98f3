"""Sinks. Every sink writes a directory of part files, one per task; nothing passes the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORMATS = ("csv", "json", "parquet")


def _write(df: DataFrame, path: str, format: str, mode: str = "overwrite") -> None:
    if format not in FORMATS:
        raise ValueError(f"Unsupported format: {format}; use one of {', '.join(FORMATS)}")
    writer = df.write.mode(mode)
    if format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(format).save(path)


def write_predictions(predictions: DataFrame, path: str, format: str = "csv") -> None:
    """Predictions as csv with header, json (one record per line) or parquet."""
    _write(predictions, path, format)


def write_quarantine(
    groups: DataFrame, path: str, keys: Sequence[str], order_column: str, format: str = "csv"
) -> None:
    """All rows of duplicated keys (see `dup_groups`), sorted by key over the files of the output.

    The order column takes part in the sort, so that a key with very many rows is cut over several
    range partitions instead of landing in one.
    """
    _write(groups.orderBy(*keys, order_column), path, format)


def write_removed_rows(removed: DataFrame, path: str, format: str = "csv") -> None:
    _write(removed, path, format)


def write_splits(rows: DataFrame, path: str, label: str = "is_customer") -> None:
    """Train and test rows below `split=train` and `split=test`, the label named `target`."""
    rows.withColumnRenamed(label, "target").write.mode("overwrite").partitionBy("split").parquet(path)


def write_importance(importance: DataFrame, path: str, format: str = "csv") -> None:
    """(feature, importance), largest first; one row per model input."""
    _write(importance.orderBy(F.desc("importance"), "feature").coalesce(1), path, format)


def append_metrics(metrics: DataFrame, path: str) -> None:
    """Add (run_id, run_time, metric, value) rows to the table of all runs.

    Partitions are per run and replaced as a whole, so writing the same run again, after a failure
    for example, leaves one copy.
    """
    (
        metrics.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id")
        .parquet(path)
    )
