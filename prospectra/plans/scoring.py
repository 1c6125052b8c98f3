"""Score rows with a fitted model.

Scoring moves no row, but for the join that an encoded text column adds where its categories are too
many to be broadcast.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prospectra.functions import confidence_band, confidence_score, named, numeric_columns, round4
from prospectra.ml.models import classifier_of, importances, input_columns
from prospectra.operators.ranking import top_prospects
from prospectra.operators.requests import check_requests, valid_requests
from prospectra.schemas import EMPLOYEE_RANGES

# Names that models and the functions below write; in input rows they are stale and dropped.
_OUTPUTS = ("features", "rawPrediction", "probability", "prediction", "confidence")


def predict(model: PipelineModel, rows: DataFrame, return_proba: bool = True) -> DataFrame:
    """`rows` with prediction and, unless declined, probability of conversion and confidence.

    Columns of `rows` that carry the names of model outputs are replaced.
    """
    kept = [named(c) for c in rows.columns if c not in _OUTPUTS]
    return _scored(model, rows).select(*kept, *_prediction_columns(return_proba))


def predict_batch(model: PipelineModel, rows: DataFrame, return_proba: bool = True) -> DataFrame:
    """As `predict`: the partitions of `rows` are the batches."""
    return predict(model, rows, return_proba)


def predict_with_ids(
    model: PipelineModel, rows: DataFrame, id_column: str = "id", return_proba: bool = True
) -> DataFrame:
    """Id, prediction and, unless declined, probability and confidence."""
    if id_column not in rows.columns:
        raise ValueError(f"the rows have no column '{id_column}' to identify them by")
    return _scored(model, rows).select(named(id_column), *_prediction_columns(return_proba))


def score_prospects(
    model: PipelineModel, rows: DataFrame, n: int = 100, id_column: str = "id"
) -> DataFrame:
    """The `n` rows most likely to convert."""
    return top_prospects(predict_with_ids(model, rows, id_column), n, id_column)


def score_requests(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """Responses to the valid requests, on a batch or a stream of them.

    `rejected_requests` has the others, with the rules they break.
    """
    return _scored(model, valid_requests(requests)).select(*_response())


def answer_requests(model: PipelineModel, requests: DataFrame) -> DataFrame:
    """A row per request, on a batch or a stream: the response to a valid one, `status` "answered",
    or the rules that the request breaks, `status` "refused".

    The requests are read once: the model sees stand-ins for the inputs of a refused one, whose
    response is NULL.
    """
    refused = F.size("failed_rules") > 0
    checked = check_requests(requests)
    scored = _scored(model, checked.withColumns(_stand_ins(requests, refused)))
    identity, *response = _response()
    return scored.select(
        identity,
        *[F.when(~refused, column).alias(name) for name, column in zip(_RESPONSE[1:], response)],
        "failed_rules",
        F.when(refused, "refused").otherwise("answered").alias("status"),
    )


_RESPONSE = ("company_id", "conversion_probability", "prediction", "confidence")


def _response() -> list[Column]:
    values = [F.col("id"), round4(F.col("_p")), F.col("_y"), confidence_band(F.col("_p"))]
    return [value.alias(name) for value, name in zip(values, _RESPONSE, strict=True)]


def _stand_ins(requests: DataFrame, refused: Column) -> dict[str, Column]:
    """The inputs, where a request is refused replaced by values that any model takes."""
    inputs = {c: F.lit(1).cast(requests.schema[c].dataType) for c in numeric_columns(requests) if c != "id"}
    inputs |= {"EMPLOYEE_RANGE": F.lit(EMPLOYEE_RANGES[0]), "INDUSTRY": F.lit("Other")}
    return {c: F.when(refused, value).otherwise(named(c)) for c, value in inputs.items()}


def explain_rows(
    model: PipelineModel,
    rows: DataFrame,
    n: int = 10,
    id_column: str = "id",
    importance: str = "gain",
) -> DataFrame:
    """Prediction and the `n` most important features of the model, for every row.

    `importance` is as in `feature_importance`.
    A linear model also tells per row which inputs moved its score: coefficient times value, the `n`
    largest by size.
    """
    ranked = sorted(importances(model, importance), key=lambda pair: (-pair[1], pair[0]))[:n]
    top = F.array(
        *[
            F.struct(F.lit(name).alias("feature"), F.lit(value).alias("importance"))
            for name, value in ranked
        ]
    )
    columns = [named(id_column), F.col("_y").alias("prediction"), F.col("_p").alias("probability")]
    columns.append(top.alias("top_features"))
    if hasattr(classifier_of(model), "coefficients"):
        columns.append(F.slice(_contributions(model), 1, n).alias("contributions"))
    return _scored(model, rows).select(*columns)


def _contributions(model: PipelineModel) -> Column:
    names = F.array(*[F.lit(name) for name in input_columns(model)])
    weights = F.array(*[F.lit(float(w)) for w in classifier_of(model).coefficients.toArray()])
    parts = F.zip_with(vector_to_array("features"), weights, lambda value, weight: value * weight)

    def ranked(name: Column, part: Column) -> Column:
        rank = (-F.abs(part)).alias("rank")
        return F.struct(rank, name.alias("feature"), part.alias("contribution"))

    largest_first = F.array_sort(F.zip_with(names, parts, ranked))
    return F.transform(largest_first, lambda pair: pair.dropFields("rank"))


def _scored(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """`rows` with the assembled features, `_p` and `_y`.

    The feature stages replace columns, so the originals travel in a struct beside them.
    """
    rows = rows.drop(*_OUTPUTS)
    original = F.struct(*[named(c) for c in rows.columns])
    scored = model.transform(rows.withColumn("_row", original))
    return scored.select(
        "_row.*",
        "features",
        vector_to_array("probability")[1].alias("_p"),
        F.col("prediction").cast("int").alias("_y"),
    )


def _prediction_columns(return_proba: bool) -> list[Column]:
    columns = [F.col("_y").alias("prediction")]
    if return_proba:
        columns += [F.col("_p").alias("probability"), confidence_score(F.col("_p")).alias("confidence")]
    return columns
