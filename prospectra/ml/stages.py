"""Feature stages: fitted on the training rows, applied to any rows.

All fitted state is a few numbers or names per column and lives in Params, so the stages are saved
and loaded with the `PipelineModel` that holds them. The one exception, the categories of
`EncodeCategorical`, can be many and is a table; up to a size it is also held with the model.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReader,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prospectra.functions import named, numeric_columns, range_ordinal
from prospectra.operators.cleaning import category_frequency
from prospectra.operators.prefix import running_totals
from prospectra.operators.quantiles import column_modes, column_quantiles, value_counts
from prospectra.sources.scratch import materialize

OTHER = "Other"


def _string(owner: str, name: str, doc: str) -> Param:
    return Param(owner, name, doc, typeConverter=TypeConverters.toString)


def _strings(owner: str, name: str, doc: str) -> Param:
    return Param(owner, name, doc, typeConverter=TypeConverters.toListString)


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """Params from keyword arguments, for stages built by name or loaded from disk."""

    def _take(self, **values) -> None:
        self._set(**{name: value for name, value in values.items() if value is not None})

    def _value(self, name: str):
        return self.getOrDefault(self.getParam(name))


class RangeOrdinal(_Stage, Transformer):
    """Replace the company size label by its rank; a table without the label passes unchanged."""

    inputCol = _string(Params._dummy(), "inputCol", "label column")
    outputCol = _string(Params._dummy(), "outputCol", "rank column")

    def __init__(self, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._setDefault(inputCol="EMPLOYEE_RANGE", outputCol="employee_range_ordinal")
        self._take(inputCol=inputCol, outputCol=outputCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        source = self._value("inputCol")
        if source not in dataset.columns:
            return dataset
        rank = range_ordinal(named(source))
        return dataset.withColumn(self._value("outputCol"), rank).drop(source)


class OneHotFrequent(_Stage, Estimator):
    """A 0/1 input per frequent category, and one for all others, NULL and unseen ones included.

    `output="columns"` makes a column of each, which suits a few hundred categories; `"vector"` makes
    one sparse vector, however many there are.
    """

    OUTPUTS = ("columns", "vector")

    inputCol = _string(Params._dummy(), "inputCol", "category column")
    prefix = _string(Params._dummy(), "prefix", "prefix of the new columns")
    minFrequency = Param(
        Params._dummy(), "minFrequency", "rows a category needs", typeConverter=TypeConverters.toInt
    )
    output = _string(Params._dummy(), "output", "columns or vector")

    def __init__(
        self,
        inputCol: str | None = None,
        prefix: str | None = None,
        minFrequency: int | None = None,
        output: str | None = None,
    ):
        super().__init__()
        self._setDefault(inputCol="INDUSTRY", prefix="industry", minFrequency=5, output="columns")
        self._take(inputCol=inputCol, prefix=prefix, minFrequency=minFrequency, output=output)
        if self._value("output") not in self.OUTPUTS:
            raise ValueError(f"Unknown output: {output}; use one of {', '.join(self.OUTPUTS)}")

    def _fit(self, dataset: DataFrame) -> "OneHotFrequentModel | OneHotVectorModel":
        source, kept = self._value("inputCol"), []
        if source in dataset.columns:
            frequent = category_frequency(dataset, source, self._value("minFrequency"))
            # As many names as the classifier will have coefficients for them.
            kept = sorted(str(row["category"]) for row in frequent.select("category").collect())
        model = OneHotVectorModel if self._value("output") == "vector" else OneHotFrequentModel
        return model(source, self._value("prefix"), kept)


class OneHotFrequentModel(_Stage, Model):
    """Columns are those of the fit, in name order, whatever categories a table holds."""

    inputCol = _string(Params._dummy(), "inputCol", "category column")
    prefix = _string(Params._dummy(), "prefix", "prefix of the new columns")
    categories = _strings(Params._dummy(), "categories", "categories with a column of their own")

    def __init__(
        self,
        inputCol: str | None = None,
        prefix: str | None = None,
        categories: Sequence[str] | None = None,
    ):
        super().__init__()
        self._take(inputCol=inputCol, prefix=prefix, categories=categories)

    def output_columns(self) -> dict[str, str]:
        """Category -> column name. Dots and backticks, which Spark ML cannot address, become _."""
        names: dict[str, str] = {}
        for category in sorted({*self._value("categories"), OTHER}):
            name = f"{self._value('prefix')}_{category}".replace(".", "_").replace("`", "_")
            if name in names.values():
                raise ValueError(f"two categories share the column name {name}")
            names[category] = name
        return names

    def _transform(self, dataset: DataFrame) -> DataFrame:
        source = self._value("inputCol")
        if source not in dataset.columns:
            return dataset
        frequent = [c for c in self._value("categories") if c != OTHER]
        value = named(source)
        columns = []
        for category, name in self.output_columns().items():
            if category == OTHER:
                hit = value.isNull() | ~value.isin(frequent) if frequent else F.lit(True)
            else:
                hit = value == category
            columns.append(F.when(hit, 1).otherwise(0).alias(name))
        rest = [named(c) for c in dataset.columns if c != source]
        return dataset.select(*rest, *columns)


class OneHotVectorModel(_Stage, Model):
    """One sparse vector: a slot per category of the fit in name order, the last one for all others."""

    inputCol = _string(Params._dummy(), "inputCol", "category column")
    prefix = _string(Params._dummy(), "prefix", "prefix of the names")
    categories = _strings(Params._dummy(), "categories", "categories with a slot of their own")

    def __init__(
        self,
        inputCol: str | None = None,
        prefix: str | None = None,
        categories: Sequence[str] | None = None,
    ):
        super().__init__()
        if categories is not None:
            categories = [c for c in categories if c != OTHER]
        self._take(inputCol=inputCol, prefix=prefix, categories=categories)

    def output_column(self) -> str:
        return f"{self._value('prefix')}_onehot"

    def slot_names(self) -> list[str]:
        return [f"{self._value('prefix')}_{c}" for c in [*self._value("categories"), OTHER]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        source = self._value("inputCol")
        if source not in dataset.columns:
            return dataset
        # NULL and unseen values get the index after the last category.
        indexer = StringIndexerModel.from_labels(
            self._value("categories"), inputCol="_category", outputCol="_slot", handleInvalid="keep"
        )
        indexed = indexer.transform(dataset.withColumn("_category", named(source).cast("string")))
        # The number of slots is in the schema of the index, so this fit reads no rows.
        encoder = OneHotEncoder(inputCols=["_slot"], outputCols=[self.output_column()], dropLast=False)
        return encoder.fit(indexed).transform(indexed).drop("_category", "_slot", source)


class ImputeMissing(_Stage, Estimator):
    """Fill missing values by a value learned per column.

    A fill value is learned for every column that may hold NULL by its schema, also if the training
    rows have none, so that scoring never meets a gap. `auto` takes the median of numeric and the
    most frequent value of text columns. Medians are exact unless `accuracy` asks for the sketch.
    """

    STRATEGIES = ("auto", "mean", "median", "mode", "zero", "constant")

    strategy = _string(Params._dummy(), "strategy", "auto, mean, median, mode, zero or constant")
    constantValue = Param(
        Params._dummy(),
        "constantValue",
        "value of the constant strategy",
        typeConverter=TypeConverters.toFloat,
    )
    excludeCols = _strings(Params._dummy(), "excludeCols", "columns left as they are")
    accuracy = Param(
        Params._dummy(), "accuracy", "rank accuracy, 0 for exact", typeConverter=TypeConverters.toInt
    )

    def __init__(
        self,
        strategy: str | None = None,
        constantValue: float | None = None,
        excludeCols: Sequence[str] | None = None,
        accuracy: int | None = None,
    ):
        super().__init__()
        self._setDefault(strategy="auto", constantValue=-1.0, excludeCols=[], accuracy=0)
        self._take(
            strategy=strategy,
            constantValue=constantValue,
            excludeCols=excludeCols,
            accuracy=accuracy,
        )

    def _fit(self, dataset: DataFrame) -> "ImputeMissingModel":
        strategy = self._value("strategy")
        if strategy not in self.STRATEGIES:
            raise ValueError(f"Unknown strategy: {strategy}; use one of {', '.join(self.STRATEGIES)}")
        excluded = set(self._value("excludeCols"))
        open_columns = [f.name for f in dataset.schema if f.nullable and f.name not in excluded]
        numbers = [c for c in numeric_columns(dataset) if c in open_columns]
        texts = [c for c in open_columns if isinstance(dataset.schema[c].dataType, T.StringType)]
        if strategy in ("mean", "median") and texts:
            raise ValueError(f"strategy {strategy} needs numeric columns, not {', '.join(texts)}")

        fills: dict[str, float | int | str] = {}
        if strategy in ("zero", "constant"):
            value = 0.0 if strategy == "zero" else self._value("constantValue")
            fills = {c: value for c in numbers} | {c: f"{value:g}" for c in texts}
        elif strategy == "mean" and numbers:
            means = dataset.agg(
                *[
                    F.avg(F.nanvl(named(c).cast("double"), F.lit(None).cast("double"))).alias(f"_{i}")
                    for i, c in enumerate(numbers)
                ]
            ).first()
            fills = {c: means[i] for i, c in enumerate(numbers)}
        elif strategy in ("auto", "median") and numbers:
            accuracy = self._value("accuracy") or None
            rows = column_quantiles(dataset, numbers, [0.5], accuracy).collect()
            fills = {row["column"]: row["quantiles"][0] for row in rows}
        elif strategy == "mode" and numbers:
            whole = [c for c in numbers if isinstance(dataset.schema[c].dataType, T.IntegralType)]
            # As doubles, whole numbers beyond 2^53 would fall together.
            for kind, names in (("bigint", whole), ("double", [c for c in numbers if c not in whole])):
                if names:
                    modes = column_modes(dataset, names, kind).collect()
                    fills |= {r["column"]: r["mode"] for r in modes}
        if strategy in ("auto", "mode") and texts:
            found = {r["column"]: r["mode"] for r in column_modes(dataset, texts, "string").collect()}
            fills |= {c: found.get(c, "Unknown") for c in texts}
        # A numeric column without any value teaches nothing and stays as it is.
        return ImputeMissingModel({c: v for c, v in fills.items() if v is not None})


class ImputeMissingModel(_Stage, Model):
    fillValues = _string(Params._dummy(), "fillValues", "column to fill value, as JSON")

    def __init__(self, fills: dict[str, float | int | str] | None = None):
        super().__init__()
        self._take(fillValues=None if fills is None else json.dumps(fills))

    def fills(self) -> dict[str, float | int | str]:
        return json.loads(self._value("fillValues"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        types = {field.name: field.dataType for field in dataset.schema}
        filled = {}
        for name, fill in self.fills().items():
            if name not in types:
                continue
            value, kind = named(name), types[name]
            if isinstance(kind, T.IntegralType) and isinstance(fill, float) and not fill.is_integer():
                # A median or mean may lie between two whole numbers.
                value, kind = value.cast("double"), T.DoubleType()
            if isinstance(kind, (T.DoubleType, T.FloatType)):
                value = F.nanvl(value, F.lit(None).cast(kind))
            filled[name] = F.coalesce(value, F.lit(fill).cast(kind))
        return dataset.withColumns(filled) if filled else dataset


#: Bytes of categories up to which a model holds them itself and looks them up in every task.
HELD_BYTES = 16 << 20


class EncodeCategorical(_Stage, Estimator):
    """Text to the index of its value among the training values, in value order; else -1.

    Categories of up to `HELD_BYTES` are held by the model, which then needs no table and moves no rows.
    """

    inputCols = _strings(Params._dummy(), "inputCols", "text columns; all if not set")
    excludeCols = _strings(Params._dummy(), "excludeCols", "columns left as they are")

    def __init__(
        self, inputCols: Sequence[str] | None = None, excludeCols: Sequence[str] | None = None
    ):
        super().__init__()
        self._setDefault(inputCols=[], excludeCols=[])
        self._take(inputCols=inputCols, excludeCols=excludeCols)

    def _fit(self, dataset: DataFrame) -> "EncodeCategoricalModel":
        excluded = set(self._value("excludeCols"))
        names = self._value("inputCols") or [
            f.name
            for f in dataset.schema
            if isinstance(f.dataType, T.StringType) and f.name not in excluded
        ]
        if not names:
            return EncodeCategoricalModel([], 0, None)
        counts = value_counts(dataset, names, "string").withColumn("one", F.lit(1))
        ranked = running_totals(counts, ["value"], ["one"], ["column"])
        index = (F.col("cum_one") - 1).cast("bigint").alias("index")
        table = materialize(ranked.select("column", "value", index), "categories")
        return EncodeCategoricalModel(names, table.count(), table).hold()


class EncodeCategoricalModel(_Stage, Model):
    inputCols = _strings(Params._dummy(), "inputCols", "text columns")
    categoryCount = Param(
        Params._dummy(), "categoryCount", "rows of the table", typeConverter=TypeConverters.toInt
    )

    def __init__(
        self,
        inputCols: Sequence[str] | None = None,
        categoryCount: int | None = None,
        table: DataFrame | None = None,
    ):
        super().__init__()
        self.table = table
        self.labels: dict[str, list[str]] | None = None
        self._take(inputCols=inputCols, categoryCount=categoryCount)

    def hold(self) -> "EncodeCategoricalModel":
        """Reads the categories into the model if they are small enough; one scan of the table."""
        size = self.table.agg(F.sum(F.octet_length("value") + 64)).first()[0] or 0
        if size <= HELD_BYTES:
            labels: dict[str, list[str]] = {name: [] for name in self._value("inputCols")}
            for row in self.table.orderBy("column", "index").toLocalIterator():
                labels[row["column"]].append(row["value"])
            self.labels = labels
        return self

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = [name for name in self._value("inputCols") if name in dataset.columns]
        if self.labels is None:
            return self._joined(dataset, names)
        # Columns without categories have no index to look up.
        known = [name for name in names if self.labels[name]]
        indexed = dataset
        if known:
            texts = {f"_text_{i}": named(name).cast("string") for i, name in enumerate(known)}
            indexer = StringIndexerModel.from_arrays_of_labels(
                [self.labels[name] for name in known],
                inputCols=list(texts),
                outputCols=[f"_index_{i}" for i in range(len(known))],
                handleInvalid="keep",  # NULL and unseen values get the index after the last
            )
            indexed = indexer.transform(dataset.withColumns(texts))
        codes = {name: F.lit(-1) for name in names}
        for i, name in enumerate(known):
            index = F.col(f"_index_{i}")
            codes[name] = F.when(index < len(self.labels[name]), index).otherwise(-1)
        columns = [codes[c].cast("bigint").alias(c, metadata={}) if c in codes else named(c) for c in dataset.columns]
        return indexed.select(*columns)

    def _joined(self, dataset: DataFrame, names: Sequence[str]) -> DataFrame:
        """By a join with the table for each column, where there are very many categories."""
        for name in names:
            indexes = self.table.where(F.col("column") == name).select(
                F.col("value").alias("_value"), F.col("index").alias("_index")
            )
            joined = dataset.join(indexes, named(name) == F.col("_value"), "left")
            encoded = F.coalesce(F.col("_index"), F.lit(-1).cast("bigint")).alias(name)
            dataset = joined.select(*[encoded if c == name else named(c) for c in dataset.columns])
        return dataset

    def write(self) -> MLWriter:
        return _CategoriesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CategoriesReader(cls)


class _CategoriesWriter(MLWriter):
    def __init__(self, instance: EncodeCategoricalModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        if self.instance.labels is not None:
            rows = [(c, v, i) for c, values in self.instance.labels.items() for i, v in enumerate(values)]
            table = self.sparkSession.createDataFrame(rows, "column string, value string, index bigint")
            table.write.parquet(os.path.join(path, "categories"))
        elif self.instance.table is not None:
            self.instance.table.write.parquet(os.path.join(path, "categories"))


class _CategoriesReader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> EncodeCategoricalModel:
        model = DefaultParamsReader(self.cls).load(path)
        if model._value("inputCols"):
            spark = SparkSession.active()
            model.table = spark.read.parquet(os.path.join(path, "categories"))
            model.hold()
        return model


class ScaleFeatures(_Stage, Estimator):
    """(value - center) / spread per column; a spread of 0 counts as 1.

    standard: mean and population deviation; minmax: minimum and range; robust: median and
    interquartile range, exact unless `accuracy` asks for the sketch; none: unchanged.
    """

    METHODS = ("standard", "minmax", "robust", "none")

    method = _string(Params._dummy(), "method", "standard, minmax, robust or none")
    inputCols = _strings(Params._dummy(), "inputCols", "columns to scale; all numeric if not set")
    excludeCols = _strings(Params._dummy(), "excludeCols", "columns left as they are")
    accuracy = Param(
        Params._dummy(), "accuracy", "rank accuracy, 0 for exact", typeConverter=TypeConverters.toInt
    )

    def __init__(
        self,
        method: str | None = None,
        inputCols: Sequence[str] | None = None,
        excludeCols: Sequence[str] | None = None,
        accuracy: int | None = None,
    ):
        super().__init__()
        self._setDefault(method="standard", inputCols=[], excludeCols=[], accuracy=0)
        self._take(
            method=method, inputCols=inputCols, excludeCols=excludeCols, accuracy=accuracy
        )
        if self._value("method") not in self.METHODS:
            raise ValueError(f"Unknown scaling method: {method}; use one of {', '.join(self.METHODS)}")

    def _fit(self, dataset: DataFrame) -> "ScaleFeaturesModel":
        method, excluded = self._value("method"), set(self._value("excludeCols"))
        wanted = self._value("inputCols") or numeric_columns(dataset)
        names = [c for c in wanted if c in dataset.columns and c not in excluded]
        if method == "none" or not names:
            return ScaleFeaturesModel([], [], [])
        if method == "robust":
            accuracy = self._value("accuracy") or None
            rows = column_quantiles(dataset, names, [0.25, 0.5, 0.75], accuracy).collect()
            found = {row["column"]: row["quantiles"] for row in rows}
            parts = {c: (q[1], q[2] - q[0]) for c, q in found.items()}
        else:
            values = {c: F.nanvl(named(c).cast("double"), F.lit(None).cast("double")) for c in names}
            if method == "standard":
                pairs = {c: (F.avg(v), F.stddev_pop(v)) for c, v in values.items()}
            else:
                pairs = {c: (F.min(v), F.max(v) - F.min(v)) for c, v in values.items()}
            row = dataset.agg(
                *[
                    part.alias(f"{side}_{i}")
                    for i, c in enumerate(names)
                    for side, part in zip("cs", pairs[c])
                ]
            ).first()
            parts = {
                c: (row[f"c_{i}"], row[f"s_{i}"])
                for i, c in enumerate(names)
                if row[f"c_{i}"] is not None
            }
        known = [c for c in names if c in parts]
        return ScaleFeaturesModel(
            known, [parts[c][0] for c in known], [parts[c][1] or 1.0 for c in known]
        )


class ScaleFeaturesModel(_Stage, Model):
    inputCols = _strings(Params._dummy(), "inputCols", "columns to scale")
    centers = Param(
        Params._dummy(), "centers", "center per column", typeConverter=TypeConverters.toListFloat
    )
    spreads = Param(
        Params._dummy(), "spreads", "spread per column", typeConverter=TypeConverters.toListFloat
    )

    def __init__(
        self,
        inputCols: Sequence[str] | None = None,
        centers: Sequence[float] | None = None,
        spreads: Sequence[float] | None = None,
    ):
        super().__init__()
        self._take(inputCols=inputCols, centers=centers, spreads=spreads)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scaled = {
            name: (named(name).cast("double") - F.lit(center)) / F.lit(spread)
            for name, center, spread in zip(
                self._value("inputCols"), self._value("centers"), self._value("spreads")
            )
            if name in dataset.columns
        }
        return dataset.withColumns(scaled) if scaled else dataset


class AssembleFeatures(_Stage, Estimator):
    """Fixes the list of model inputs: every column of the training table but the excluded ones.

    Fitting gives a `VectorAssembler` over that list, so later tables are read by name.
    """

    excludeCols = _strings(Params._dummy(), "excludeCols", "columns that are no model input")
    outputCol = _string(Params._dummy(), "outputCol", "vector column")

    def __init__(self, excludeCols: Sequence[str] | None = None, outputCol: str | None = None):
        super().__init__()
        self._setDefault(excludeCols=[], outputCol="features")
        self._take(excludeCols=excludeCols, outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> VectorAssembler:
        excluded = set(self._value("excludeCols"))
        names = [c for c in dataset.columns if c not in excluded]
        return VectorAssembler(inputCols=names, outputCol=self._value("outputCol"))
