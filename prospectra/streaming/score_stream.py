"""Scoring of requests as they arrive in a folder."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from prospectra.plans.scoring import answer_requests
from prospectra.schemas import REQUESTS


def read_request_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REQUESTS,
    max_files_per_trigger: int | None = None,
    file_pattern: str | None = None,
) -> DataFrame:
    """Stream of the Parquet files that appear below `path`."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_pattern:
        reader = reader.option("pathGlobFilter", file_pattern)
    return reader.parquet(path)


def score_stream(
    model: PipelineModel,
    requests: DataFrame,
    output_path: str,
    checkpoint_path: str,
    once: bool = False,
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Start writing responses below `output_path`, one folder per outcome.

    `status=answered` holds the scores, `status=refused` the requests that break a rule, with the
    names of those rules in `failed_rules`. Scoring keeps no state, so the query runs in append mode without watermark; the file sink and
    the checkpoint together write each response exactly once, also after a restart. `once` stops
    when all requests present at the start are answered.
    """
    writer = (
        answer_requests(model, requests)
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("status")
        .option("checkpointLocation", checkpoint_path)
        .option("path", output_path)
    )
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
