"""Split, fit, cross-validate and evaluate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel

from prospectra.functions import named, numeric_columns
from prospectra.ml.evaluation import cross_validate
from prospectra.ml.models import create_model, feature_importance, importance_kind
from prospectra.ml.stages import (
    AssembleFeatures,
    EncodeCategorical,
    ImputeMissing,
    OneHotFrequent,
    RangeOrdinal,
    ScaleFeatures,
)
from prospectra.operators.cleaning import LABEL, NON_FEATURES
from prospectra.operators.runs import metrics_table
from prospectra.operators.split import split_stratified
from prospectra.plans.evaluation import Evaluation, evaluate
from prospectra.plans.scoring import predict
from prospectra.sources.scratch import materialize
from prospectra.sources.writers import append_metrics, write_importance, write_splits

# Columns that travel with the rows and are no model input.
PASS_THROUGH = (*NON_FEATURES, "split", "fold")


@dataclass
class TrainingConfig:
    model_type: str = "logistic_regression"
    hyperparameters: dict = field(default_factory=lambda: {"C": 1.0, "class_weight": "balanced"})
    test_share: float = 0.2
    seed: int = 42
    industry_min_frequency: int = 5
    onehot: str = "vector"
    missing_strategy: str = "auto"
    missing_constant: float = -1.0
    scaling: str = "standard"
    exclude_columns: tuple[str, ...] = ()
    exclude_from_scaling: tuple[str, ...] = ()
    folds: int = 5
    threshold: float = 0.5
    quantile_accuracy: int = 0


@dataclass
class TrainingResult:
    model: PipelineModel
    rows: DataFrame
    predictions: DataFrame
    evaluation: Evaluation
    importance: DataFrame
    cross_validation: DataFrame | None


def feature_stages(columns: DataFrame, config: TrainingConfig | None = None) -> list:
    """The feature stages in their fixed order: rank labels, one-hot, impute, encode, scale, assemble.

    `columns` is any table with the schema of the training rows; only the schema is used.
    """
    config = config or TrainingConfig()
    outside = [*PASS_THROUGH, *config.exclude_columns]
    measures = [c for c in numeric_columns(columns) if c not in outside]
    if "EMPLOYEE_RANGE" in columns.columns:
        measures.append("employee_range_ordinal")
    return [
        RangeOrdinal(),
        OneHotFrequent(minFrequency=config.industry_min_frequency, output=config.onehot),
        ImputeMissing(
            config.missing_strategy, config.missing_constant, outside, config.quantile_accuracy
        ),
        EncodeCategorical(excludeCols=outside),
        ScaleFeatures(
            config.scaling, measures, list(config.exclude_from_scaling), config.quantile_accuracy
        ),
        AssembleFeatures(excludeCols=outside),
    ]


def train(dataset: DataFrame, config: TrainingConfig | None = None) -> TrainingResult:
    """Fit on the train rows of `dataset` (see `prepare_dataset`), evaluate on its test rows.

    The dataset is written to scratch once; all later passes, of which the fit needs many, start from
    its files and not from the raw tables.
    """
    config = config or TrainingConfig()
    rows = split_stratified(materialize(dataset, "dataset"), config.test_share, config.seed)
    train_rows, test_rows = rows.where("split = 'train'"), rows.where("split = 'test'")

    features = Pipeline(stages=feature_stages(train_rows, config)).fit(train_rows)
    prepared = features.transform(train_rows).select("id", LABEL, "features")
    prepared.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        classifier = create_model(config.model_type, config.hyperparameters)
        fitted = classifier.fit(prepared)
        folds = cross_validate(classifier, prepared, config.folds, config.seed) if config.folds else None
    finally:
        prepared.unpersist()

    model = PipelineModel(stages=[*features.stages, fitted])
    predictions = predict(model, test_rows)
    return TrainingResult(
        model=model,
        rows=rows,
        predictions=predictions,
        evaluation=evaluate(predictions, config.threshold),
        importance=feature_importance(model, importance_kind(config.model_type)),
        cross_validation=folds,
    )


def processed_splits(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Key, label and split of `rows` with the model's inputs as they are after all feature stages."""
    features = PipelineModel(stages=list(model.stages[:-1])).transform(rows)
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    inputs = [named(c) for c in assembler.getInputCols()]
    return features.select("id", LABEL, "split", *inputs)


def save_artifacts(result: TrainingResult, path: str, run_id: str, run_time: str) -> None:
    """Model, processed train and test rows, importances, metrics and scores per fold below one path."""
    result.model.write().overwrite().save(f"{path}/model")
    write_splits(processed_splits(result.model, result.rows), f"{path}/splits")
    if result.cross_validation is not None:
        result.cross_validation.write.mode("overwrite").parquet(f"{path}/cross_validation")
    write_importance(result.importance, f"{path}/feature_importance")
    append_metrics(metrics_table(result.evaluation.metrics, run_id, run_time), f"{path}/metrics")


def load_model(path: str) -> PipelineModel:
    """The model saved by `save_artifacts`, feature stages included."""
    return PipelineModel.load(f"{path}/model")
