"""Binary classifiers by type name, on top of Spark ML.

`create_model` translates the usual hyperparameters of the scikit-learn, XGBoost and LightGBM
estimators to their Spark ML counterparts. Settings that only concern those libraries (threads,
verbosity, solver choice) are accepted and have no effect; an unknown setting is an error.
"""

from __future__ import annotations

import json
import math

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from prospectra.functions import named
from prospectra.ml.boosting import Growth, fit_boosted
from prospectra.ml.newton import MAX_WIDTH, fit_newton
from prospectra.ml.stages import OneHotVectorModel, _Stage, _string
from prospectra.operators.cleaning import LABEL
from prospectra.sources.scratch import new_scratch_path

_WEIGHT = "_weight"
#: Rows that a fit, which caches its rows and reads them many times, takes in one partition.
TASK_ROWS = 500_000
_MAX_DEPTH = 30  # Spark's limit
_NO_EFFECT = {"n_jobs", "verbose", "verbosity", "use_label_encoder", "eval_metric", "solver"}

# Defaults as in the libraries the type names come from.
_DEFAULTS = {
    "logistic_regression": {
        "C": 1.0,
        "penalty": "l2",
        "l1_ratio": 0.5,
        "max_iter": 1000,
        "tol": 1e-6,
        "fit_intercept": True,
        "class_weight": None,
        "random_state": 42,
    },
    "random_forest": {
        "n_estimators": 100,
        "max_depth": None,
        "min_samples_split": 2,
        "min_samples_leaf": 1,
        "max_features": "sqrt",
        "max_samples": None,
        "min_impurity_decrease": 0.0,
        "criterion": "gini",
        "bootstrap": True,
        "max_bins": 64,
        "class_weight": None,
        "random_state": 42,
    },
    "xgboost": {
        "n_estimators": 100,
        "learning_rate": 0.3,
        "max_depth": 6,
        "subsample": 1.0,
        "colsample_bytree": 1.0,
        "gamma": 0.0,
        "scale_pos_weight": 1.0,
        "max_bins": 64,
        "trees": "spark",
        "reg_lambda": 1.0,
        "reg_alpha": 0.0,
        "min_child_weight": 1.0,
        "max_leaves": 0,
        "base_score": 0.5,
        "random_state": 42,
    },
    "lightgbm": {
        "n_estimators": 100,
        "learning_rate": 0.1,
        "num_leaves": 31,
        "max_depth": -1,
        "subsample": 1.0,
        "colsample_bytree": 1.0,
        "min_child_samples": 20,
        "min_split_gain": 0.0,
        "scale_pos_weight": 1.0,
        "is_unbalance": False,
        "class_weight": None,
        "max_bins": 64,
        "trees": "spark",
        "reg_lambda": 0.0,
        "reg_alpha": 0.0,
        "min_child_weight": 1e-3,
        "random_state": 42,
    },
}

MODEL_TYPES = tuple(_DEFAULTS)
# Settings that Spark's own boosted trees, of first order and grown by level, do not know.
_SECOND_ORDER = {"reg_lambda", "reg_alpha", "min_child_weight", "max_leaves", "base_score"}


def create_model(model_type: str, hyperparameters: dict | None = None) -> "ConversionClassifier":
    if model_type not in _DEFAULTS:
        raise ValueError(f"Unknown model type: {model_type}. Available: {', '.join(MODEL_TYPES)}")
    given = hyperparameters or {}
    unknown = set(given) - set(_DEFAULTS[model_type]) - _NO_EFFECT
    if unknown:
        raise ValueError(f"Unknown hyperparameters of {model_type}: {', '.join(sorted(unknown))}")
    trees = given.get("trees", "spark")
    if trees not in ("spark", "second_order"):
        raise ValueError(f"Unknown trees: {trees}; use spark or second_order")
    if "trees" in _DEFAULTS[model_type] and trees == "spark" and _SECOND_ORDER & set(given):
        raise ValueError(f"Only trees of second order have {', '.join(sorted(_SECOND_ORDER & set(given)))}")
    return ConversionClassifier(modelType=model_type, hyperparameters=json.dumps(given))


class ConversionClassifier(_Stage, Estimator):
    """Fits the Spark ML classifier of its type and returns Spark's own model.

    Class weights and the size-dependent part of the regularisation come from one count per class.
    """

    modelType = _string(Params._dummy(), "modelType", "one of " + ", ".join(MODEL_TYPES))
    hyperparameters = _string(Params._dummy(), "hyperparameters", "settings as JSON")
    labelCol = _string(Params._dummy(), "labelCol", "0/1 label")
    featuresCol = _string(Params._dummy(), "featuresCol", "vector column")
    aggregationDepth = Param(
        Params._dummy(),
        "aggregationDepth",
        "depth of the tree that sums gradients; raise it with many partitions and features",
        typeConverter=TypeConverters.toInt,
    )

    def __init__(
        self,
        modelType: str | None = None,
        hyperparameters: str | None = None,
        labelCol: str | None = None,
        featuresCol: str | None = None,
        aggregationDepth: int | None = None,
    ):
        super().__init__()
        self._setDefault(
            modelType="logistic_regression",
            hyperparameters="{}",
            labelCol=LABEL,
            featuresCol="features",
            aggregationDepth=2,
        )
        self._take(
            modelType=modelType,
            hyperparameters=hyperparameters,
            labelCol=labelCol,
            featuresCol=featuresCol,
            aggregationDepth=aggregationDepth,
        )

    def settings(self) -> dict:
        return _DEFAULTS[self._value("modelType")] | json.loads(self._value("hyperparameters"))

    def weighted(self, dataset: DataFrame) -> tuple[DataFrame, float]:
        """`dataset` with the weight of each row by its class, and the sum of the weights."""
        rows, classes, _ = self._weighted(dataset)
        return rows, classes[0] + classes[1]

    def _weighted(self, dataset: DataFrame) -> tuple[DataFrame, tuple[float, float], int]:
        """`dataset` with the weight of each row, the sum of the weights of either class, and the rows of both."""
        label, given = named(self._value("labelCol")), self.settings()
        counts = dataset.agg(
            F.count_if(label == 0).alias("neg"), F.count_if(label == 1).alias("pos")
        ).first()
        weights = _class_weights(given, counts["neg"], counts["pos"])
        classes = counts["neg"] * weights[0], counts["pos"] * weights[1]
        return dataset.withColumn(_WEIGHT, _weight_column(label, weights)), classes, counts["neg"] + counts["pos"]

    def _fit(self, dataset: DataFrame) -> Model:
        weighted, classes, n = self._weighted(dataset)
        if self.settings().get("trees") == "second_order":
            label, features = self._value("labelCol"), self._value("featuresCol")
            model = fit_boosted(weighted, label, features, _WEIGHT, _growth(self._value("modelType"), self.settings()))
            return model._set(labelCol=label, featuresCol=features)
        classifier = self._classifier(self.settings(), classes[0] + classes[1])
        classifier.setParams(
            labelCol=self._value("labelCol"),
            featuresCol=self._value("featuresCol"),
            weightCol=_WEIGHT,
        )
        columns = [self._value("labelCol"), self._value("featuresCol"), _WEIGHT]
        # A loss that is strictly convex has one minimum, whoever finds it.
        convex = isinstance(classifier, LogisticRegression) and classifier.getRegParam() > 0 and not classifier.getElasticNetParam()
        if convex and n > TASK_ROWS and min(classes) > 0:
            width = weighted.select(named(self._value("featuresCol"))).first()[0].size
            if width <= MAX_WIDTH:
                rows = _spread(weighted, columns) or weighted
                return fit_newton(rows, classifier, width, sum(classes), classes[1])
        dealt = _spread(weighted, columns)
        if dealt is None:
            return classifier.fit(weighted)
        dealt.persist(StorageLevel.MEMORY_AND_DISK)  # a fit starts from its rows several times
        try:
            return classifier.fit(dealt)
        finally:
            dealt.unpersist()

    def _classifier(self, given: dict, total_weight: float) -> Estimator:
        kind = self._value("modelType")
        if kind == "logistic_regression":
            # Spark divides the loss by the total weight, scikit-learn multiplies it by C.
            penalty = given["penalty"]
            if penalty not in (None, "none", "l1", "l2", "elasticnet"):
                raise ValueError(f"Unknown penalty: {penalty}")
            strength = 0.0 if penalty in (None, "none") else 1.0 / (given["C"] * total_weight)
            mix = {"l1": 1.0, "elasticnet": given["l1_ratio"]}.get(penalty, 0.0)
            return LogisticRegression(
                regParam=strength,
                elasticNetParam=mix,
                standardization=False,
                maxIter=given["max_iter"],
                tol=given["tol"],
                fitIntercept=given["fit_intercept"],
                family="binomial",
                aggregationDepth=self._value("aggregationDepth"),
            )
        if kind == "random_forest":
            depth = _MAX_DEPTH if given["max_depth"] is None else _allowed(given["max_depth"])
            # A split that leaves half of min_samples_split on each side had that many rows.
            leaf = max(given["min_samples_leaf"], math.ceil(given["min_samples_split"] / 2))
            return RandomForestClassifier(
                numTrees=given["n_estimators"],
                maxDepth=depth,
                minInstancesPerNode=leaf,
                minInfoGain=given["min_impurity_decrease"],
                subsamplingRate=1.0 if given["max_samples"] is None else given["max_samples"],
                featureSubsetStrategy=_feature_subset(given["max_features"]),
                impurity=given["criterion"],
                bootstrap=given["bootstrap"],
                maxBins=given["max_bins"],
                seed=given["random_state"],
            )
        depth = given["max_depth"]
        if kind == "lightgbm" and depth < 0:
            depth = math.ceil(math.log2(given["num_leaves"]))
        return GBTClassifier(
            maxIter=given["n_estimators"],
            stepSize=given["learning_rate"],
            maxDepth=_allowed(depth),
            subsamplingRate=given["subsample"],
            # Spark draws the columns anew for each node, not for each tree.
            featureSubsetStrategy=_feature_subset(_share(given["colsample_bytree"])),
            minInstancesPerNode=given.get("min_child_samples", 1),
            minInfoGain=given["gamma"] if kind == "xgboost" else given["min_split_gain"],
            maxBins=given["max_bins"],
            seed=given["random_state"],
        )


def _spread(rows: DataFrame, columns: list[str]) -> DataFrame | None:
    """`columns` of `rows` over more partitions if one holds more than `TASK_ROWS`, else nothing.

    Partitions of files follow the bytes, and few bytes can hold very many rows.
    """
    partitions = rows.groupBy(F.spark_partition_id().alias("_partition")).agg(F.count("*").alias("n"))
    found = partitions.agg(F.max("n").alias("largest"), F.sum("n").alias("n"), F.count("*").alias("partitions")).first()
    if (found["largest"] or 0) <= TASK_ROWS:
        return None
    return rows.select(*[named(c) for c in columns]).repartition(max(math.ceil(found["n"] / TASK_ROWS), found["partitions"]))


def _growth(kind: str, given: dict) -> Growth:
    """Trees of second order: `xgboost` splits whole levels, `lightgbm` the leaf that gains most."""
    shared = {
        "trees": given["n_estimators"],
        "rate": given["learning_rate"],
        "max_depth": max(given["max_depth"], 0),
        "l1": given["reg_alpha"],
        "l2": given["reg_lambda"],
        "min_hessian": given["min_child_weight"],
        "row_share": given["subsample"],
        "column_share": given["colsample_bytree"],
        "max_bins": given["max_bins"],
        "seed": given["random_state"],
    }
    if kind == "xgboost":
        return Growth(**shared, min_gain=given["gamma"], max_leaves=given["max_leaves"], base_score=given["base_score"])
    return Growth(**shared, min_gain=given["min_split_gain"], max_leaves=given["num_leaves"], min_rows=given["min_child_samples"])


def _allowed(depth: int) -> int:
    """A tree depth that Spark can build; a deeper one is refused, not cut."""
    if depth > _MAX_DEPTH:
        raise ValueError(f"max_depth {depth}: Spark builds trees down to depth {_MAX_DEPTH}")
    return depth


def _share(columns: float) -> float | None:
    """A share of the columns in Spark's terms, where all of them are no share."""
    if not 0.0 < columns <= 1.0:
        raise ValueError(f"colsample_bytree {columns}: must be above 0 and at most 1")
    return None if columns == 1.0 else float(columns)


def _feature_subset(max_features) -> str:
    return "all" if max_features is None else str(max_features)


def _class_weights(given: dict, neg: int, pos: int) -> tuple[float, float]:
    """Weight of a row of class 0 and of class 1."""
    total, choice = neg + pos, given.get("class_weight")
    positive = float(given.get("scale_pos_weight", 1.0))
    if given.get("is_unbalance") and pos:
        positive = neg / pos
    if choice == "balanced":
        return total / (2.0 * neg) if neg else 1.0, total / (2.0 * pos) if pos else 1.0
    if isinstance(choice, dict):
        by_label = {str(key): float(weight) for key, weight in choice.items()}
        return by_label.get("0", 1.0), by_label.get("1", 1.0)
    if choice is not None:
        raise ValueError(f"Unknown class_weight: {choice}")
    return 1.0, positive


def _weight_column(label: Column, weights: tuple[float, float]) -> Column:
    return F.when(label == 1, F.lit(weights[1])).otherwise(F.lit(weights[0]))


def input_columns(fitted: Model) -> list[str]:
    """Names of the model inputs, from the assembler of a fitted `PipelineModel`; one per vector slot."""
    slots = {s.output_column(): s.slot_names() for s in fitted.stages if isinstance(s, OneHotVectorModel)}
    for stage in fitted.stages:
        if isinstance(stage, VectorAssembler):
            return [name for column in stage.getInputCols() for name in slots.get(column, [column])]
    raise ValueError("no VectorAssembler among the stages")


def classifier_of(fitted: Model) -> Model:
    return fitted.stages[-1]


IMPORTANCES = ("gain", "split")


def importance_kind(model_type: str) -> str:
    """What the library a type is named after reports by default."""
    return "split" if model_type == "lightgbm" else "gain"


def importances(fitted: Model, kind: str = "gain") -> list[tuple[str, float]]:
    """(feature, importance) in input order.

    `gain` is what the splits on a feature gained, as shares of one, and `split` their number over
    all trees. A linear model has absolute coefficients, whichever is asked for.
    """
    if kind not in IMPORTANCES:
        raise ValueError(f"Unknown importance: {kind}; use one of {', '.join(IMPORTANCES)}")
    model, names = classifier_of(fitted), input_columns(fitted)
    if not hasattr(model, "featureImportances"):
        values = abs(model.coefficients.toArray())
    elif kind == "split":
        counts = {row["feature"]: row["n"] for row in _splits_by_feature(model).collect()}
        values = [counts.get(i, 0) for i in range(len(names))]
    else:
        values = model.featureImportances.toArray()
    return [(name, float(value)) for name, value in zip(names, values, strict=True)]


def _splits_by_feature(model: Model) -> DataFrame:
    """(feature, n): inner nodes per input number, from the node table that Spark saves of the trees."""
    path = new_scratch_path(SparkSession.active(), "trees")
    model.write().save(path)
    nodes = SparkSession.active().read.parquet(f"{path}/data").select("nodeData.*")
    inner = nodes.where("leftChild >= 0").select(F.col("split.featureIndex").alias("feature"))
    return inner.groupBy("feature").agg(F.count("*").alias("n"))


def feature_importance(fitted: Model, kind: str = "gain") -> DataFrame:
    """Importances as a table, one row per model input; see `importances`."""
    spark = SparkSession.active()
    return spark.createDataFrame(importances(fitted, kind), "feature string, importance double")


def logistic_optimality(
    fitted: Model, classifier: ConversionClassifier, rows: DataFrame
) -> DataFrame:
    """How far a fitted logistic model is from the least loss over `rows`, its training rows.

    `fitted` holds the feature stages and the model that `classifier` fitted. A row per input, and
    one for the intercept if the model has one: `moment`, the weighted mean of label times input (1
    for the intercept), and `slope`, the derivative of the penalised mean loss by the coefficient.
    The loss is convex, so the model is the best there is if and only if every slope is zero. An L1
    part has no derivative where a coefficient is zero; `slope` is then what the rest exceeds it by.
    One aggregation, whose result is as long as the coefficients; `rows` need both classes.
    """
    model, names = classifier_of(fitted), input_columns(fitted)
    weighted, total = classifier.weighted(fitted.transform(rows))
    observed = F.col(_WEIGHT) * named(model.getLabelCol())
    expected = F.col(_WEIGHT) * vector_to_array(model.getProbabilityCol())[1]
    inputs = F.col(model.getFeaturesCol())
    sums = weighted.agg(
        F.sum(observed).alias("y"),
        F.sum(expected).alias("p"),
        Summarizer.mean(inputs, observed).alias("mean_y"),
        Summarizer.mean(inputs, expected).alias("mean_p"),
    ).first()
    moments = sums["mean_y"].toArray() * sums["y"] / total
    slopes = sums["mean_p"].toArray() * sums["p"] / total - moments
    strength, mix = model.getRegParam(), model.getElasticNetParam()
    table = [
        (name, float(moment), _penalised(float(slope), float(b), strength * (1 - mix), strength * mix))
        for name, moment, slope, b in zip(names, moments, slopes, model.coefficients.toArray(), strict=True)
    ]
    if model.getFitIntercept():
        table.append(("intercept", sums["y"] / total, (sums["p"] - sums["y"]) / total))
    return SparkSession.active().createDataFrame(table, "feature string, moment double, slope double")


def _penalised(slope: float, coefficient: float, ridge: float, lasso: float) -> float:
    """The slope of the loss with its penalty; of the one-sided ones at zero, what keeps them from it."""
    slope += ridge * coefficient
    if coefficient:
        return slope + math.copysign(lasso, coefficient)
    return math.copysign(max(abs(slope) - lasso, 0.0), slope)
