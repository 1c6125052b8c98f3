"""Models that Spark ML does not have: any function from a feature matrix to probabilities."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from importlib import import_module

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Params
from pyspark.ml.util import MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prospectra.ml.stages import _Stage, _string


class FunctionModel(_Stage, Model):
    """Last stage of a `PipelineModel` that scores with `score(matrix, **arguments) -> probability of class 1`.

    The function is called per Arrow batch with a float matrix, one row per record, and must be
    picklable. The outputs are those of a Spark classifier, so `predict` and the like work with it.
    Saving keeps the function's module and name and the arguments, as JSON; loading imports it again.
    A function without an importable name, a lambda for example, can score but not be saved.
    """

    function = _string(Params._dummy(), "function", "module:name of the scoring function")
    arguments = _string(Params._dummy(), "arguments", "further arguments of the function as JSON")
    featuresCol = _string(Params._dummy(), "featuresCol", "vector column")

    def __init__(
        self,
        score: Callable[..., np.ndarray] | None = None,
        featuresCol: str | None = None,
        **arguments,
    ):
        super().__init__()
        self._setDefault(featuresCol="features", arguments="{}")
        self._score = score
        self._take(
            function=None if score is None else _address(score),
            featuresCol=featuresCol,
            arguments=json.dumps(arguments) if arguments else None,
        )

    def _probability(self) -> Column:
        score = self._score or _imported(self._value("function"))
        arguments = json.loads(self._value("arguments"))

        @F.pandas_udf("double")
        def probability(features: pd.Series) -> pd.Series:
            matrix = np.stack(features.to_numpy())
            return pd.Series(np.asarray(score(matrix, **arguments), dtype=float))

        return probability(vector_to_array(self._value("featuresCol")))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = F.col("_foreign")
        return (
            dataset.withColumn("_foreign", self._probability())
            .withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))
            .withColumn("prediction", F.when(p > 0.5, 1.0).otherwise(0.0))
            .drop("_foreign")
        )

    def write(self) -> MLWriter:
        address = self._value("function")
        try:
            _imported(address)
        except (ImportError, AttributeError) as error:
            raise ValueError(f"{address} cannot be imported again: define it in a module") from error
        return super().write()


def _address(function: Callable) -> str:
    kind = function if hasattr(function, "__qualname__") else type(function)
    return f"{kind.__module__}:{kind.__qualname__}"


def _imported(address: str) -> Callable:
    module, _, name = address.partition(":")
    return reduce(getattr, name.split("."), import_module(module))
