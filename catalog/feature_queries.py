"""Feature estimators: fitted on a table, applied to it."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.data_queries import companies, prepared
from catalog.function_queries import RANGE_CASE
from catalog.registry import query, rounded
from catalog.roles import SEGMENTS, USAGE_FEATURES, sql
from prospectra.ml.stages import EncodeCategorical, ImputeMissing, OneHotFrequent, ScaleFeatures
from prospectra.operators.split import split_by_hash, split_stratified
from prospectra.plans.training import feature_stages
from prospectra.sources import materialize

HASH_SQL = "md5(CAST(id AS VARCHAR) || ':42')"
SPLIT_SQL = f"CASE WHEN substr({HASH_SQL}, 1, 8) < '33333333' THEN 'test' ELSE 'train' END"


@query(
    "onehot_frequent",
    sql(
        "SELECT id, 'industry_' || CASE WHEN INDUSTRY IN (SELECT INDUSTRY FROM companies "
        "GROUP BY INDUSTRY HAVING count(*) >= 300) THEN INDUSTRY ELSE 'Other' END AS hot FROM companies",
        "companies",
    ),
)
def onehot_frequent(spark, d):
    rows = companies(spark, d).select("id", "INDUSTRY")
    model = OneHotFrequent(minFrequency=300, output="vector").fit(rows)
    slots = F.transform(
        vector_to_array(model.output_column()), lambda value, i: F.when(value == 1, _slot_names(model)[i])
    )
    return model.transform(rows).select("id", F.array_join(slots, ",").alias("hot"))


def _slot_names(model):
    return F.array(*[F.lit(name) for name in model.slot_names()])


# Imputation -------------------------------------------------------------------------------------

_NUMBERS = ["MRR", "ALEXA_RANK"]
_TEXTS = ["EMPLOYEE_RANGE", "INDUSTRY"]


def _imputed(spark, d, strategy: str, texts: bool):
    rows = companies(spark, d).select("id", *_NUMBERS, *(_TEXTS if texts else []))
    model = ImputeMissing(strategy, -1.0, ["id"]).fit(rows)
    numbers = {name: F.col(name).cast("double") for name in _NUMBERS}
    return rounded(model.transform(rows).withColumns(numbers))


def _impute_sql(number: str, text: str | None) -> str:
    columns = [f"round(COALESCE(CAST({c} AS DOUBLE), {number.format(c)}), 6) AS {c}" for c in _NUMBERS]
    if text:
        columns += [f"COALESCE({c}, {text.format(c)}) AS {c}" for c in _TEXTS]
    return sql(f"SELECT id, {', '.join(columns)} FROM companies", "companies")


_MEDIAN = "(SELECT median(CAST({0} AS DOUBLE)) FROM companies)"
_MODE = (
    "(SELECT {0} FROM companies WHERE {0} IS NOT NULL GROUP BY {0} ORDER BY count(*) DESC, {0} LIMIT 1)"
)


@query("impute_auto", _impute_sql(_MEDIAN, _MODE))
def impute_auto(spark, d):
    return _imputed(spark, d, "auto", texts=True)


@query("impute_mean", _impute_sql("(SELECT avg({0}) FROM companies)", None))
def impute_mean(spark, d):
    return _imputed(spark, d, "mean", texts=False)


@query("impute_median", _impute_sql(_MEDIAN, None))
def impute_median(spark, d):
    return _imputed(spark, d, "median", texts=False)


@query("impute_mode", _impute_sql(_MODE, _MODE))
def impute_mode(spark, d):
    return _imputed(spark, d, "mode", texts=True)


@query("impute_zero", _impute_sql("0", "'0'"))
def impute_zero(spark, d):
    return _imputed(spark, d, "zero", texts=True)


@query("impute_constant", _impute_sql("-1", "'-1'"))
def impute_constant(spark, d):
    return _imputed(spark, d, "constant", texts=True)


# Encoding and scaling ---------------------------------------------------------------------------


def _index_sql(column: str) -> str:
    return (
        f"COALESCE((SELECT i FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i FROM "
        f"(SELECT DISTINCT {column} AS v FROM companies WHERE {column} IS NOT NULL)) "
        f"WHERE v = c.{column}), -1) AS {column}"
    )


@query(
    "encode_categorical",
    sql(f"SELECT id, {', '.join(_index_sql(c) for c in _TEXTS)} FROM companies c", "companies"),
)
def encode_categorical(spark, d):
    rows = companies(spark, d).select("id", *_TEXTS)
    return EncodeCategorical().fit(rows).transform(rows)


_SCALED = ["ALEXA_RANK", "total_actions", "days_active", "activity_frequency"]


def _scaled(spark, d, method: str, exclude: list[str] | None = None):
    rows = prepared(spark, d).select("id", *[F.col(c).cast("double").alias(c) for c in _SCALED])
    rows = materialize(rows, "scaled")  # fit and transform both read it
    model = ScaleFeatures(method, _SCALED, exclude).fit(rows)
    return rounded(model.transform(rows))


def _scale_sql(center: str, spread: str, columns: list[str] = _SCALED) -> str:
    parts = [f"{center.format(c)} AS c_{c}, {spread.format(c)} AS s_{c}" for c in columns]
    scaled = [
        f"round((CAST({c} AS DOUBLE) - c_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END, 6) AS {c}"
        if c in columns
        else f"round(CAST({c} AS DOUBLE), 6) AS {c}"
        for c in _SCALED
    ]
    if not parts:
        return sql(f"SELECT id, {', '.join(scaled)} FROM prepared", "prepared")
    return sql(
        f"SELECT id, {', '.join(scaled)} FROM prepared, fitted",
        "prepared",
        extra=f"fitted AS (SELECT {', '.join(parts)} FROM prepared)",
    )


_QUANTILE = "quantile_cont(CAST({{0}} AS DOUBLE), {0})"


@query("scale_standard", _scale_sql("avg({0})", "stddev_pop({0})"))
def scale_standard(spark, d):
    return _scaled(spark, d, "standard")


@query("scale_minmax", _scale_sql("min({0})", "CAST(max({0}) - min({0}) AS DOUBLE)"))
def scale_minmax(spark, d):
    return _scaled(spark, d, "minmax")


@query(
    "scale_robust",
    _scale_sql(_QUANTILE.format(0.5), f"({_QUANTILE.format(0.75)} - {_QUANTILE.format(0.25)})"),
)
def scale_robust(spark, d):
    return _scaled(spark, d, "robust")


@query("scale_none", _scale_sql("", "", []))
def scale_none(spark, d):
    return _scaled(spark, d, "none")


@query("scale_exclude", _scale_sql("avg({0})", "stddev_pop({0})", _SCALED[1:]))
def scale_exclude(spark, d):
    return _scaled(spark, d, "standard", ["ALEXA_RANK"])


# All stages together ----------------------------------------------------------------------------

MODEL_INPUTS = ["ALEXA_RANK", "EMPLOYEE_RANGE", "INDUSTRY", *USAGE_FEATURES]
_REQUEST_MEASURES = ["ALEXA_RANK", "total_actions", "total_users", "days_active", "activity_frequency"]


def split_inputs(spark, d, inputs=MODEL_INPUTS):
    """Key, label, split and inputs."""
    return split_by_hash(prepared(spark, d)).select("id", "is_customer", "split", *inputs)


_STAGED = ["ALEXA_RANK", *USAGE_FEATURES]
STAGED_ALL = [*_STAGED, "employee_range_ordinal"]
FEATURE_STAGES_EXTRA = (
    f"inputs AS (SELECT id, is_customer, {SPLIT_SQL} AS split, {', '.join(_STAGED)}, INDUSTRY, "
    f"{RANGE_CASE} AS employee_range_ordinal FROM prepared), "
    "filled AS (SELECT * REPLACE (COALESCE(CAST(ALEXA_RANK AS DOUBLE), (SELECT "
    "median(CAST(ALEXA_RANK AS DOUBLE)) FROM inputs WHERE split = 'train')) AS ALEXA_RANK) FROM inputs), "
    "fitted AS (SELECT "
    + ", ".join(f"avg({c}) AS c_{c}, stddev_pop({c}) AS s_{c}" for c in STAGED_ALL)
    + " FROM filled WHERE split = 'train')"
)

# Name of an input -> SQL of its value after all stages.
STAGED_SQL = {
    c: f"(({c} - c_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END)" for c in STAGED_ALL
} | {f"industry_{s}": f"CASE WHEN INDUSTRY = '{s}' THEN 1 ELSE 0 END" for s in SEGMENTS} | {
    "industry_Other": "CASE WHEN COALESCE(INDUSTRY, 'Other') = 'Other' THEN 1 ELSE 0 END"
}


def staged_sql(columns: str, left_out: set[str] = frozenset()) -> str:
    """`columns` and the inputs after all stages."""
    inputs = ", ".join(
        f"round({value}, 6) AS {c}" if c in STAGED_ALL else f'{value} AS "{c}"'
        for c, value in STAGED_SQL.items()
        if c not in left_out
    )
    select = f"SELECT {columns}, {inputs} FROM filled, fitted"
    return sql(select, "prepared", extra=FEATURE_STAGES_EXTRA)


def with_onehot_columns(fitted, staged):
    """The one-hot vector as a column per category."""
    onehot = fitted.stages[1]
    slots = vector_to_array(onehot.output_column())
    hot = [slots[i].cast("int").alias(name) for i, name in enumerate(onehot.slot_names())]
    return staged.select("*", *hot).drop(onehot.output_column())


def _staged(spark, d, inputs):
    rows = materialize(split_inputs(spark, d, inputs), "inputs")  # every stage reads it
    train = rows.where("split = 'train'")
    fitted = Pipeline(stages=feature_stages(train)).fit(train)
    staged = fitted.transform(rows).drop("features", "is_customer")
    return rounded(with_onehot_columns(fitted, staged))


@query("feature_stages", staged_sql("id, split", {*_STAGED} - {*_REQUEST_MEASURES}))
def feature_stages_query(spark, d):
    """Over the inputs that a scoring request has as well."""
    return _staged(spark, d, [*_REQUEST_MEASURES, "EMPLOYEE_RANGE", "INDUSTRY"])


@query("feature_stages_all_inputs", staged_sql("id, split"))
def feature_stages_all_inputs(spark, d):
    return _staged(spark, d, MODEL_INPUTS)


# Splits -----------------------------------------------------------------------------------------


@query("split_hash", sql(f"SELECT id, is_customer, {SPLIT_SQL} AS split FROM companies", "companies"))
def split_hash_query(spark, d):
    return split_by_hash(companies(spark, d)).select("id", "is_customer", "split")


@query(
    "split_stratified",
    sql(
        "SELECT id, is_customer, CASE WHEN row_number() OVER (PARTITION BY is_customer "
        f"ORDER BY {HASH_SQL}) <= floor(count(*) OVER (PARTITION BY is_customer) * CAST(0.2 AS DOUBLE) + 0.5) "
        "THEN 'test' ELSE 'train' END AS split FROM companies",
        "companies",
    ),
)
def split_stratified_query(spark, d):
    return split_stratified(companies(spark, d)).select("id", "is_customer", "split")
