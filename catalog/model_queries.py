"""Models, evaluation and scoring.

Where a model has a closed form, the query uses it and SQL checks the result of the training: an
unpenalised logistic model over one-hot categories predicts each category's (weighted) rate, and an
unbagged forest over a single input predicts the majority per value.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import functions as F

from catalog.data_queries import (
    AREAS_SQL,
    FAILED_RULES_SQL,
    RUN_COLUMNS,
    RUNS_SQL,
    VALID_REQUEST_SQL,
    companies,
    metrics_of_runs,
    prepared,
)
from catalog.feature_queries import (
    FEATURE_STAGES_EXTRA,
    HASH_SQL,
    SPLIT_SQL,
    STAGED_ALL,
    STAGED_SQL,
    split_inputs,
    staged_sql,
    with_onehot_columns,
)
from catalog.function_queries import RANGE_CASE
from catalog.registry import query, rounded
from catalog.roles import role, sql
from prospectra.ml.evaluation import cross_validate
from prospectra.ml.foreign import FunctionModel
from prospectra.ml.models import MODEL_TYPES, create_model, feature_importance, logistic_optimality
from prospectra.ml.stages import AssembleFeatures, OneHotFrequent, RangeOrdinal, ScaleFeatures, ScaleFeaturesModel
from prospectra.operators.curves import average_precision, pr_curve, roc_auc, roc_curve
from prospectra.operators.metrics import (
    business_metrics,
    classification_metrics,
    classification_report,
    confusion_matrix,
    optimal_thresholds,
    score_histogram,
    threshold_predictions,
)
from prospectra.operators.ranking import top_features
from prospectra.operators.runs import best_run, run_comparison
from prospectra.operators.split import split_by_hash
from prospectra.plans.scoring import (
    answer_requests,
    explain_rows,
    predict,
    predict_batch,
    predict_with_ids,
    score_requests,
)
from prospectra.plans.training import feature_stages, processed_splits
from prospectra.sources.scratch import materialize, new_scratch_path
from prospectra.sources.writers import write_importance, write_splits
from prospectra.streaming import read_request_stream, score_stream

_FITTED: dict[tuple[str, str, str], PipelineModel] = {}


def _fitted(spark, d, name: str, fit) -> PipelineModel:
    """Models are trained once per session and table set."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _FITTED:
        _FITTED[key] = fit()
    return _FITTED[key]


def _fit(rows, stages: list, model_type: str, **hyperparameters) -> PipelineModel:
    return Pipeline(stages=[*stages, create_model(model_type, hyperparameters)]).fit(rows)


# Rates per industry -----------------------------------------------------------------------------

_NOT_INDUSTRY = ["id", "is_customer", "split"]
_RATE_SETTINGS = {"penalty": None, "class_weight": "balanced"}


def _industry_rows(spark, d):
    return split_by_hash(companies(spark, d)).select("id", "INDUSTRY", "is_customer", "split")


def _rate_model(spark, d) -> PipelineModel:
    def fit():
        rows = materialize(_industry_rows(spark, d).where("split = 'train'"), "train")
        stages = [OneHotFrequent(), AssembleFeatures(_NOT_INDUSTRY)]
        return _fit(rows, stages, "logistic_regression", **_RATE_SETTINGS)

    return _fitted(spark, d, "rates", fit)


_RATES = f"""labelled AS (
    SELECT id, is_customer AS y, INDUSTRY, COALESCE(INDUSTRY, 'Other') AS grp, {SPLIT_SQL} AS split,
        {HASH_SQL} AS hash FROM companies),
    totals AS (SELECT CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg
        FROM labelled WHERE split = 'train'),
    rates AS (SELECT grp, sum(y) / any_value(t.pos) / (sum(y) / any_value(t.pos)
        + sum(1 - y) / any_value(t.neg)) AS p FROM labelled, totals t WHERE split = 'train' GROUP BY grp)"""


def _predicted_sql(where: str = "TRUE", columns: str = "id") -> str:
    return sql(
        f"SELECT {columns}, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, "
        "round(p, 4) AS probability, round(greatest(p, 1 - p), 4) AS confidence "
        f"FROM labelled JOIN rates USING (grp) WHERE {where}",
        "companies",
        extra=_RATES,
    )


@query(
    "train_logistic",
    sql(
        "SELECT grp AS industry, count(*) AS n, round(any_value(p), 4) AS probability "
        "FROM labelled JOIN rates USING (grp) GROUP BY grp",
        "companies",
        extra=_RATES,
    ),
)
def train_logistic(spark, d):
    scored = predict(_rate_model(spark, d), _industry_rows(spark, d))
    industry = F.coalesce("INDUSTRY", F.lit("Other")).alias("industry")
    groups = scored.groupBy(industry).agg(
        F.count("*").alias("n"), F.max("probability").alias("probability")
    )
    return rounded(groups, 4)


@query("predict", _predicted_sql(columns="id, INDUSTRY"))
def predict_query(spark, d):
    rows = _industry_rows(spark, d).select("id", "INDUSTRY")
    return rounded(predict(_rate_model(spark, d), rows), 4)


@query("predict_batch", _predicted_sql(columns="id, INDUSTRY"))
def predict_batch_query(spark, d):
    rows = _industry_rows(spark, d).select("id", "INDUSTRY")
    return rounded(predict_batch(_rate_model(spark, d), rows), 4)


@query("predict_with_ids", _predicted_sql())
def predict_with_ids_query(spark, d):
    return rounded(predict_with_ids(_rate_model(spark, d), _industry_rows(spark, d)), 4)


@query("model_persist", _predicted_sql())
def model_persist(spark, d):
    path = new_scratch_path(spark, "model")
    _rate_model(spark, d).write().save(path)
    return rounded(predict_with_ids(PipelineModel.load(path), _industry_rows(spark, d)), 4)


_RESPONSES = (
    "SELECT r.id AS company_id, round(p, 4) AS conversion_probability, "
    "CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, "
    "CASE WHEN p < 0.3 OR p > 0.7 THEN 'high' WHEN p < 0.4 OR p > 0.6 THEN 'medium' ELSE 'low' END "
    "AS confidence{} "
    f"FROM requests r JOIN rates ON grp = r.INDUSTRY WHERE {VALID_REQUEST_SQL}"
)


@query("score_requests", sql(_RESPONSES.format(""), "companies", "requests", extra=_RATES))
def score_requests_query(spark, d):
    return score_requests(_rate_model(spark, d), role(spark, d, "requests"))


@query(
    "score_stream",
    sql(
        _RESPONSES.format(", 'answered' AS status, '' AS failed")
        + f" UNION ALL SELECT id, NULL, NULL, NULL, 'refused', {FAILED_RULES_SQL} FROM requests "
        f"WHERE NOT ({VALID_REQUEST_SQL})",
        "companies",
        "requests",
        extra=_RATES,
    ),
)
def score_stream_query(spark, d):
    orders = spark.read.parquet(f"{d}/orders.parquet").schema
    arriving = read_request_stream(spark, d, orders, file_pattern="orders.parquet")
    output, progress = new_scratch_path(spark, "responses"), new_scratch_path(spark, "progress")
    model, requests = _rate_model(spark, d), role(spark, d, "requests", arriving)
    score_stream(model, requests, output, progress, once=True).awaitTermination()
    schema = answer_requests(model, role(spark, d, "requests")).schema
    answers = spark.read.schema(schema).parquet(output)
    return answers.withColumn("failed", F.array_join("failed_rules", ",")).drop("failed_rules")


_CV_SQL = f"""{_RATES},
    placed AS (SELECT grp, y, row_number() OVER (PARTITION BY y ORDER BY hash) AS place,
        count(*) OVER (PARTITION BY y) AS n FROM labelled WHERE split = 'train'),
    cells AS (SELECT {" + ".join(f"CAST(place > (2 * n * {i} + 5) // 10 AS INT)" for i in range(1, 5))} AS fold, grp,
        CAST(sum(y) AS DOUBLE) AS pos, CAST(sum(1 - y) AS DOUBLE) AS neg
        FROM placed GROUP BY ALL),
    outside AS (SELECT *, sum(pos) OVER (PARTITION BY grp) - pos AS out_pos,
        sum(neg) OVER (PARTITION BY grp) - neg AS out_neg FROM cells),
    ordered AS (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY out_pos / (out_pos + out_neg) DESC) AS tp
        FROM outside),
    aucs AS (SELECT fold, sum(neg * (tp - pos / 2)) / (sum(pos) * sum(neg)) AS roc_auc FROM ordered GROUP BY fold)"""


@query(
    "cross_validate",
    sql(
        "SELECT fold, round(roc_auc, 6) AS roc_auc, round(avg(roc_auc) OVER (), 6) AS cv_mean, "
        "round(stddev_pop(roc_auc) OVER (), 6) AS cv_std FROM aucs",
        "companies",
        extra=_CV_SQL,
    ),
)
def cross_validate_query(spark, d):
    rows = _industry_rows(spark, d).where("split = 'train'")
    stages = Pipeline(stages=[OneHotFrequent(), AssembleFeatures(_NOT_INDUSTRY)]).fit(rows)
    features = materialize(stages.transform(rows).select("id", "is_customer", "features"), "folds")
    return rounded(cross_validate(create_model("logistic_regression", _RATE_SETTINGS), features))


# Two binary inputs ------------------------------------------------------------------------------

_FLAGS = ["has_usage", "low_rank"]
_FLAG_SETTINGS = {"C": 1.0, "penalty": "l2", "class_weight": "balanced", "tol": 1e-12}


def _flag_rows(spark, d):
    used = F.when(F.col("total_actions") > 0, 1.0).otherwise(0.0)
    low = F.when(F.col("ALEXA_RANK") < 500_000, 1.0).otherwise(0.0)
    return prepared(spark, d).select("id", "is_customer", used.alias(_FLAGS[0]), low.alias(_FLAGS[1]))


def _flag_model(spark, d) -> PipelineModel:
    """The standard model: L2 penalty and balanced classes."""

    def fit():
        rows = materialize(_flag_rows(spark, d), "flags")
        stages = [AssembleFeatures(["id", "is_customer"])]
        return _fit(rows, stages, "logistic_regression", **_FLAG_SETTINGS)

    return _fitted(spark, d, "flags", fit)


# Newton steps for c * weighted log loss + (b1 ^ 2 + b2 ^ 2) / 2 at c = 1, over the four cells of two flags:
# t is the weight of a cell, y that of its customers, r and v the cell's share of gradient and curvature.
_CELLS = {"00": "b0", "01": "b0 + b2", "10": "b0 + b1", "11": "b0 + b1 + b2"}
_NEWTON = f"""flags AS (SELECT id, is_customer AS y, CASE WHEN total_actions > 0 THEN 1 ELSE 0 END AS has_usage,
        CASE WHEN ALEXA_RANK < 500000 THEN 1 ELSE 0 END AS low_rank FROM prepared),
    classes AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(y) AS pos, sum(1 - y) AS neg FROM flags),
    weighted AS (SELECT y, has_usage || '' || low_rank AS cell,
        CASE WHEN y = 1 THEN n / (2 * pos) ELSE n / (2 * neg) END AS w FROM flags, classes),
    cells AS (SELECT {", ".join(
        f"COALESCE(sum(w) FILTER (WHERE cell = '{k}'), 0) AS t{k}, "
        f"COALESCE(sum(w * y) FILTER (WHERE cell = '{k}'), 0) AS y{k}" for k in _CELLS)} FROM weighted),
    steps_taken AS (
        SELECT 0 AS i, CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1, CAST(0 AS DOUBLE) AS b2
        UNION ALL
        SELECT i + 1,
            b0 - (g0 * (h11 * h22 - h12 * h12) - h01 * (g1 * h22 - h12 * g2) + h02 * (g1 * h12 - h11 * g2)) / det,
            b1 - (h00 * (g1 * h22 - h12 * g2) - g0 * (h01 * h22 - h12 * h02) + h02 * (h01 * g2 - g1 * h02)) / det,
            b2 - (h00 * (h11 * g2 - g1 * h12) - h01 * (h01 * g2 - g1 * h02) + g0 * (h01 * h12 - h11 * h02)) / det
        FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02)
                + h02 * (h01 * h12 - h11 * h02) AS det
            FROM (SELECT i, b0, b1, b2, r00 + r01 + r10 + r11 AS g0, r10 + r11 + b1 AS g1, r01 + r11 + b2 AS g2,
                    v00 + v01 + v10 + v11 AS h00, v10 + v11 AS h01, v01 + v11 AS h02,
                    v10 + v11 + 1 AS h11, v11 AS h12, v01 + v11 + 1 AS h22
                FROM (SELECT i, b0, b1, b2, {", ".join(f"t{k} * p{k} - y{k} AS r{k}, t{k} * p{k} * (1 - p{k}) AS v{k}" for k in _CELLS)}
                    FROM (SELECT *, {", ".join(f"1 / (1 + exp(-({eta}))) AS p{k}" for k, eta in _CELLS.items())}
                        FROM steps_taken, cells WHERE i < 25))))),
    fitted AS (SELECT b0, b1, b2 FROM steps_taken WHERE i = 25),
    importances AS (SELECT 'has_usage' AS feature, round(abs(b1), 4) AS importance FROM fitted
        UNION ALL SELECT 'low_rank', round(abs(b2), 4) FROM fitted),
    scored_flags AS (SELECT f.*, 1 / (1 + exp(-(b0 + b1 * has_usage + b2 * low_rank))) AS p,
        has_usage * b1 AS c1, low_rank * b2 AS c2, b1, b2 FROM flags f, fitted)"""


def _newton_sql(select: str) -> str:
    return sql(select, "prepared", extra=_NEWTON).replace("WITH ", "WITH RECURSIVE ", 1)


@query(
    "train_logistic_l2",
    _newton_sql(
        "SELECT has_usage, low_rank, count(*) AS n, round(any_value(p), 4) AS probability "
        "FROM scored_flags GROUP BY has_usage, low_rank"
    ),
)
def train_logistic_l2(spark, d):
    scored = predict(_flag_model(spark, d), _flag_rows(spark, d))
    flags = [F.col(c).cast("int").alias(c) for c in _FLAGS]
    cells = scored.groupBy(*flags).agg(F.count("*").alias("n"), F.max("probability").alias("probability"))
    return rounded(cells, 4)


@query("feature_importance", _newton_sql("SELECT * FROM importances"))
def feature_importance_query(spark, d):
    return rounded(feature_importance(_flag_model(spark, d)), 4)


@query("sink_importance", _newton_sql("SELECT * FROM importances"))
def sink_importance(spark, d):
    path = new_scratch_path(spark, "importance")
    write_importance(feature_importance(_flag_model(spark, d)), path)
    written = spark.read.schema("feature string, importance double").option("header", True).csv(path)
    return rounded(written, 4)


@query(
    "top_features",
    _newton_sql("SELECT * FROM importances ORDER BY importance DESC, feature LIMIT 1"),
)
def top_features_query(spark, d):
    return rounded(top_features(feature_importance(_flag_model(spark, d)), 1), 4)


@query(
    "explain_row",
    _newton_sql(
        "SELECT id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, round(p, 4) AS probability, "
        "CASE WHEN abs(b1) >= abs(b2) THEN 'has_usage' ELSE 'low_rank' END AS top_feature, "
        "round(greatest(abs(b1), abs(b2)), 4) AS top_importance, "
        "round(least(abs(b1), abs(b2)), 4) AS next_importance, "
        "CASE WHEN abs(c1) >= abs(c2) THEN 'has_usage' ELSE 'low_rank' END AS mover, "
        "round(CASE WHEN abs(c1) >= abs(c2) THEN c1 ELSE c2 END, 4) + 0 AS moved, "
        "round(CASE WHEN abs(c1) >= abs(c2) THEN c2 ELSE c1 END, 4) + 0 AS moved_next FROM scored_flags"
    ),
)
def explain_row(spark, d):
    """The most important feature of the model, and the input that moved the score of a row most."""
    explained = explain_rows(_flag_model(spark, d), _flag_rows(spark, d))
    top, moved = F.col("top_features"), F.col("contributions")
    flat = explained.select(
        "id",
        "prediction",
        "probability",
        top[0]["feature"].alias("top_feature"),
        top[0]["importance"].alias("top_importance"),
        top[1]["importance"].alias("next_importance"),
        moved[0]["feature"].alias("mover"),
        moved[0]["contribution"].alias("moved"),
        moved[1]["contribution"].alias("moved_next"),
    )
    zero = F.lit(0.0)  # no minus sign on a zero
    return rounded(flat, 4).withColumns({c: F.when(F.col(c) == 0, zero).otherwise(F.col(c)) for c in ("moved", "moved_next")})


# Trees ------------------------------------------------------------------------------------------

# Trees deep enough to give every value of their only input a leaf of its own.
_SATURATED = {
    "logistic_regression": {"penalty": None, "class_weight": "balanced"},
    "random_forest": {
        "n_estimators": 3,
        "bootstrap": False,
        "max_features": None,
        "max_depth": 12,
        "class_weight": "balanced",
    },
    "xgboost": {"n_estimators": 3, "learning_rate": 0.3, "max_depth": 12, "scale_pos_weight": 1.5},
    "lightgbm": {"n_estimators": 3, "learning_rate": 0.1, "num_leaves": 4096, "is_unbalance": True, "min_child_samples": 1},
}


def _range_rows(spark, d):
    return companies(spark, d).select("id", "is_customer", "EMPLOYEE_RANGE")


def _range_model(spark, d, model_type: str, settings: dict) -> PipelineModel:
    """Of the company size rank alone."""

    def fit():
        stages = [RangeOrdinal(), AssembleFeatures(["id", "is_customer"])]
        return _fit(materialize(_range_rows(spark, d), "ranges"), stages, model_type, **settings)

    return _fitted(spark, d, f"range-{model_type}", fit)


def _by_rank(scored, column: str):
    return (
        RangeOrdinal()
        .transform(scored)
        .groupBy("employee_range_ordinal")
        .agg(F.count("*").alias("n"), F.max(column).alias(column))
    )


@query(
    "train_random_forest",
    sql(
        f"SELECT {RANGE_CASE} AS employee_range_ordinal, count(*) AS n, "
        "CASE WHEN avg(is_customer) > 0.5 THEN 1 ELSE 0 END AS prediction FROM companies GROUP BY 1",
        "companies",
    ),
)
def train_random_forest(spark, d):
    settings = _SATURATED["random_forest"] | {"class_weight": None}
    model = _range_model(spark, d, "random_forest", settings)
    return _by_rank(predict(model, _range_rows(spark, d)), "prediction")


# A boosted score starts at 2r - 1, r being the weighted rate of a leaf, and each further tree adds
# the learning rate times the leaf's mean residual of the log loss.
_RESIDUAL = "(r * 4 / (1 + exp(2 * {0})) - (1 - r) * 4 / (1 + exp(-2 * {0})))"
_BOOSTED = f"""leaves AS (SELECT {RANGE_CASE} AS employee_range_ordinal, count(*) AS n,
        CAST(sum(is_customer) AS DOUBLE) AS pos, CAST(sum(1 - is_customer) AS DOUBLE) AS neg
        FROM companies GROUP BY 1),
    types AS (SELECT 'xgboost' AS model_type, CAST(1.5 AS DOUBLE) AS w, CAST(0.3 AS DOUBLE) AS rate
        UNION ALL SELECT 'lightgbm', sum(neg) / sum(pos), 0.1 FROM leaves),
    round1 AS (SELECT *, 2 * r - 1 AS f1 FROM (SELECT *, w * pos / (w * pos + neg) AS r FROM leaves, types)),
    round2 AS (SELECT *, f1 + rate * {_RESIDUAL.format('f1')} AS f2 FROM round1),
    round3 AS (SELECT *, f2 + rate * {_RESIDUAL.format('f2')} AS f3 FROM round2)"""


@query(
    "train_boosted",
    sql(
        "SELECT model_type, employee_range_ordinal, n, round(1 / (1 + exp(-2 * f3)), 4) AS probability "
        "FROM round3",
        "companies",
        extra=_BOOSTED,
    ),
)
def train_boosted(spark, d):
    rates = None
    for model_type in ("xgboost", "lightgbm"):
        model = _range_model(spark, d, model_type, _SATURATED[model_type])
        rate = _by_rank(predict(model, _range_rows(spark, d)), "probability")
        rate = rate.withColumn("model_type", F.lit(model_type))
        rates = rate if rates is None else rates.unionByName(rate)
    return rounded(rates, 4)


# Trees of second order ---------------------------------------------------------------------------

_SECOND_ORDER = {
    "xgboost": {"trees": "second_order", "n_estimators": 2, "learning_rate": 0.3, "max_depth": 2, "scale_pos_weight": 1.5},
    "lightgbm": {"trees": "second_order", "n_estimators": 2, "learning_rate": 0.1, "num_leaves": 4, "min_child_samples": 5},
}
_INPUTS = ["employee_range_ordinal", *_FLAGS]


def _tree_sql(kind: str, number: int, steps: int, per_node: bool, l2: float, least: str, rate: float) -> str:
    """Tables of one tree: each step splits every leaf, or the one that gains most; `{kind}_{number}` has the scores."""
    name = f"{kind}_{number}"
    parts = [
        f"{name}_0 AS MATERIALIZED (SELECT *, '' AS node, w * pos * (p - 1) + neg * p AS g, "
        f"(w * pos + neg) * p * (1 - p) AS h FROM (SELECT *, 1 / (1 + exp(-f)) AS p FROM {kind}_{number - 1}))"
    ]
    for step in range(1, steps + 1):
        before = f"{name}_{step - 1}"
        sums = " UNION ALL ".join(
            f"SELECT node, {i} AS input, {c} AS x, sum(g) AS g, sum(h) AS h, sum(n) AS n FROM {before} GROUP BY node, {c}"
            for i, c in enumerate(_INPUTS)
        )
        upto = ", ".join(f"sum({c}) OVER (PARTITION BY node, input ORDER BY x) AS l{c}" for c in "ghn")
        whole = ", ".join(f"sum({c}) OVER (PARTITION BY node, input) AS t{c}" for c in "ghn")
        value = "CASE input " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(_INPUTS)) + " END"
        parts.append(
            f"{name}_{step}_splits AS MATERIALIZED (SELECT node AS split_node, input, x FROM (SELECT node, input, x, "
            f"lg * lg / (lh + {l2}) + (tg - lg) * (tg - lg) / (th - lh + {l2}) - tg * tg / (th + {l2}) AS gain "
            f"FROM (SELECT node, input, x, {upto}, {whole} FROM ({sums})) WHERE ln < tn AND {least}) WHERE gain > 1e-6 "
            f"QUALIFY row_number() OVER ({'PARTITION BY node ' if per_node else ''}ORDER BY gain DESC, node, input, x) = 1)"
        )
        parts.append(
            f"{name}_{step} AS MATERIALIZED (SELECT b.* REPLACE (CASE WHEN split_node IS NULL THEN node WHEN {value} <= x "
            f"THEN node || 'L' ELSE node || 'R' END AS node) FROM {before} b LEFT JOIN {name}_{step}_splits ON node = split_node)"
        )
    parts.append(
        f"{name} AS MATERIALIZED (SELECT {', '.join(_INPUTS)}, n, pos, neg, w, "
        f"f - {rate} * sum(g) OVER (PARTITION BY node) / (sum(h) OVER (PARTITION BY node) + {l2}) AS f FROM {name}_{steps})"
    )
    return ", ".join(parts)


_SECOND_ORDER_SQL = ", ".join(
    [
        f"""cells AS MATERIALIZED (SELECT {RANGE_CASE} AS employee_range_ordinal,
        CASE WHEN total_actions > 0 THEN 1 ELSE 0 END AS has_usage,
        CASE WHEN ALEXA_RANK < 500000 THEN 1 ELSE 0 END AS low_rank, CAST(count(*) AS DOUBLE) AS n,
        CAST(sum(is_customer) AS DOUBLE) AS pos, CAST(sum(1 - is_customer) AS DOUBLE) AS neg FROM prepared GROUP BY 1, 2, 3)""",
        "xgboost_0 AS MATERIALIZED (SELECT *, CAST(1.5 AS DOUBLE) AS w, CAST(0 AS DOUBLE) AS f FROM cells)",
        "lightgbm_0 AS MATERIALIZED (SELECT *, CAST(1 AS DOUBLE) AS w, ln(sum(pos) OVER () / sum(neg) OVER ()) AS f FROM cells)",
        *(_tree_sql("xgboost", k, 2, True, 1.0, "lh >= 1 AND th - lh >= 1", 0.3) for k in (1, 2)),
        *(
            _tree_sql("lightgbm", k, 3, False, 0.0, "ln >= 5 AND tn - ln >= 5 AND lh >= 1e-3 AND th - lh >= 1e-3", 0.1)
            for k in (1, 2)
        ),
    ]
)


@query(
    "train_boosted_second_order",
    sql(
        " UNION ALL ".join(
            f"SELECT '{kind}' AS model_type, {', '.join(_INPUTS)}, CAST(n AS BIGINT) AS n, "
            f"round(1 / (1 + exp(-f)), 5) AS probability FROM {kind}_2"
            for kind in _SECOND_ORDER
        ),
        "prepared",
        extra=_SECOND_ORDER_SQL,
    ),
)
def train_boosted_second_order(spark, d):
    """Depth-limited and leaf-limited trees of three inputs: the probability of every cell."""
    used = F.when(F.col("total_actions") > 0, 1).otherwise(0)
    low = F.when(F.col("ALEXA_RANK") < 500_000, 1).otherwise(0)
    chosen = prepared(spark, d).select("id", "is_customer", "EMPLOYEE_RANGE", used.alias(_FLAGS[0]), low.alias(_FLAGS[1]))
    rows = materialize(chosen, "boosted")
    cells = None
    for kind, settings in _SECOND_ORDER.items():

        def fit(kind=kind, settings=settings):
            stages = [RangeOrdinal(), AssembleFeatures(["id", "is_customer"])]
            return _fit(rows, stages, kind, **settings)

        scored = RangeOrdinal().transform(predict(_fitted(spark, d, f"second-order-{kind}", fit), rows))
        cell = scored.groupBy(*[F.col(c).cast("int").alias(c) for c in _INPUTS])
        cell = cell.agg(F.count("*").alias("n"), F.round(F.max("probability"), 5).alias("probability"))
        cell = cell.withColumn("model_type", F.lit(kind))
        cells = cell if cells is None else cells.unionByName(cell)
    return cells


# Trees of two flags have a leaf per cell; their root splits on the flag that explains more of the
# residuals, both its children on the other one.
_SPLITS = f"""flags AS (SELECT is_customer AS y, CASE WHEN total_actions > 0 THEN 1 ELSE 0 END AS has_usage,
        CASE WHEN ALEXA_RANK < 500000 THEN 1 ELSE 0 END AS low_rank FROM prepared),
    ratio AS (SELECT sum(1 - y) / CAST(sum(y) AS DOUBLE) AS w FROM flags),
    cells AS (SELECT has_usage, low_rank, sum(CASE WHEN y = 1 THEN w ELSE 1 END) AS t,
        sum(w * y) / sum(CASE WHEN y = 1 THEN w ELSE 1 END) AS r FROM flags, ratio GROUP BY ALL),
    round1 AS (SELECT *, 2 * r - 1 AS f1 FROM cells),
    round2 AS (SELECT *, {_RESIDUAL.format('f1')} AS m2, f1 + 0.1 * {_RESIDUAL.format('f1')} AS f2 FROM round1),
    residuals AS (SELECT 1 AS tree, has_usage, low_rank, t, f1 AS m FROM round1
        UNION ALL SELECT 2, has_usage, low_rank, t, m2 FROM round2
        UNION ALL SELECT 3, has_usage, low_rank, t, {_RESIDUAL.format('f2')} FROM round2),
    explained AS (SELECT tree, feature, sum(s * s / n) AS gain FROM (
        SELECT tree, 'has_usage' AS feature, sum(t * m) AS s, sum(t) AS n FROM residuals GROUP BY tree, has_usage
        UNION ALL SELECT tree, 'low_rank', sum(t * m), sum(t) FROM residuals GROUP BY tree, low_rank)
        GROUP BY tree, feature)"""


@query(
    "split_importance",
    sql(
        "SELECT feature, CAST(sum(place) AS DOUBLE) AS importance FROM (SELECT feature, "
        "row_number() OVER (PARTITION BY tree ORDER BY gain DESC, feature) AS place FROM explained) GROUP BY feature",
        "prepared",
        extra=_SPLITS,
    ),
)
def split_importance(spark, d):
    def fit():
        stages = [AssembleFeatures(["id", "is_customer"])]
        return _fit(materialize(_flag_rows(spark, d), "flags"), stages, "lightgbm", **_SATURATED["lightgbm"])

    return feature_importance(_fitted(spark, d, "flag-trees", fit), "split")


@query(
    "model_factory",
    sql(
        "SELECT model_type, grp AS industry, n, CASE WHEN w * pos > neg THEN 1 ELSE 0 END AS prediction FROM ("
        "SELECT COALESCE(INDUSTRY, 'Other') AS grp, count(*) AS n, sum(is_customer) AS pos, "
        "sum(1 - is_customer) AS neg FROM companies GROUP BY 1), types",
        "companies",
        extra="types AS (SELECT unnest(['logistic_regression', 'random_forest', 'lightgbm']) AS model_type, "
        "CAST(sum(1 - is_customer) AS DOUBLE) / sum(is_customer) AS w FROM companies "
        "UNION ALL SELECT 'xgboost', 1.5)",
    ),
)
def model_factory(spark, d):
    """Predicted class per industry, by every type of model."""
    rows = materialize(companies(spark, d).select("id", "is_customer", "INDUSTRY"), "industries")
    classes = None
    for model_type in MODEL_TYPES:

        def fit(model_type=model_type):
            stages = [OneHotFrequent(), AssembleFeatures(["id", "is_customer"])]
            return _fit(rows, stages, model_type, **_SATURATED[model_type])

        scored = predict(_fitted(spark, d, f"industry-{model_type}", fit), rows)
        found = scored.groupBy(F.coalesce("INDUSTRY", F.lit("Other")).alias("industry")).agg(
            F.count("*").alias("n"), F.max("prediction").alias("prediction")
        )
        found = found.withColumn("model_type", F.lit(model_type))
        classes = found if classes is None else classes.unionByName(found)
    return classes


# All inputs -----------------------------------------------------------------------------------

_STANDARD = {"C": 1.0, "class_weight": "balanced", "tol": 1e-12}


def _standard_rows(spark, d):
    """The inputs of the standard model, prepared and written once for all that reads them."""
    return materialize(split_inputs(spark, d), "inputs")


def _standard_model(spark, d, rows=None) -> PipelineModel:
    """The standard model over all stages and inputs, fitted on the train rows of `_standard_rows`."""

    def fit():
        train = (_standard_rows(spark, d) if rows is None else rows).where("split = 'train'")
        return _fit(train, feature_stages(train), "logistic_regression", **_STANDARD)

    return _fitted(spark, d, "standard", fit)


# Balanced classes have half of the weight each, so a moment is half of the customers' mean.
_MOMENTS = ", ".join(f"avg({value}) / 2 AS \"{name}\"" for name, value in STAGED_SQL.items())


@query(
    "train_logistic_all_stages",
    sql(
        "SELECT feature, round(moment, 6) AS moment, CAST(0 AS DOUBLE) AS slope FROM ("
        f"UNPIVOT (SELECT {_MOMENTS}, CAST(0.5 AS DOUBLE) AS intercept FROM filled, fitted "
        "WHERE split = 'train' AND is_customer = 1) ON COLUMNS(*) INTO NAME feature VALUE moment)",
        "prepared",
        extra=FEATURE_STAGES_EXTRA,
    ),
)
def train_logistic_all_stages(spark, d):
    """Per input the data's side of the model's equations, and how far the model is from solving it.

    SQL cannot minimise the loss, but it knows what holds at the minimum: every slope is zero.
    """
    rows = _standard_rows(spark, d)
    classifier = create_model("logistic_regression", _STANDARD)
    found = logistic_optimality(_standard_model(spark, d, rows), classifier, rows.where("split = 'train'"))
    slope = F.round("slope", 4) + F.lit(0.0)  # no minus sign on a zero
    return found.select("feature", F.round("moment", 6).alias("moment"), slope.alias("slope"))


@query("sink_splits", staged_sql("id, is_customer AS target, split"))
def sink_splits(spark, d):
    """The rows as the classifier saw them, written and read back."""
    path, rows = new_scratch_path(spark, "splits"), _standard_rows(spark, d)
    model = _standard_model(spark, d, rows)
    write_splits(processed_splits(model, rows), path)
    return rounded(with_onehot_columns(model, spark.read.parquet(path)))


@query(
    "fitted_parameters",
    sql(
        "SELECT feature, round(center, 6) AS center, round(spread, 6) AS spread FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS feature, c_{c} AS center, CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END AS spread FROM fitted"
            for c in STAGED_ALL
        )
        + ")",
        "prepared",
        extra=FEATURE_STAGES_EXTRA,
    ),
)
def fitted_parameters(spark, d):
    """What a stage learned, read from the parameters of the fitted, saved and reloaded model."""
    path = new_scratch_path(spark, "parameters")
    _standard_model(spark, d).write().save(path)
    scaler = next(s for s in PipelineModel.load(path).stages if isinstance(s, ScaleFeaturesModel))
    learned = {param.name: value for param, value in scaler.extractParamMap().items()}
    table = zip(learned["inputCols"], learned["centers"], learned["spreads"], strict=True)
    return rounded(spark.createDataFrame(list(table), "feature string, center double, spread double"))


class Logarithms(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A stage of a user's own: the logarithm of one more than the value."""

    def _transform(self, dataset):
        return dataset.withColumns({c: F.log1p(F.col(c).cast("double")) for c in self.getInputCols()})


_LOGGED = ["total_actions", "total_users", "days_active"]


@query(
    "custom_transformer",
    sql(
        "SELECT id, "
        + ", ".join(
            f"round((l_{c} - avg(l_{c}) OVER ()) / CASE WHEN stddev_pop(l_{c}) OVER () = 0 THEN 1 "
            f"ELSE stddev_pop(l_{c}) OVER () END, 6) AS {c}"
            for c in _LOGGED
        )
        + f" FROM (SELECT id, {', '.join(f'ln(1 + CAST({c} AS DOUBLE)) AS l_{c}' for c in _LOGGED)} FROM prepared)",
        "prepared",
    ),
)
def custom_transformer(spark, d):
    """A user's stage before one of the library's, fitted, saved and reloaded with it."""
    logarithms = Logarithms()
    logarithms.set(logarithms.inputCols, _LOGGED)
    rows = materialize(prepared(spark, d).select("id", *_LOGGED), "logged")
    path = new_scratch_path(spark, "custom-transformer")
    Pipeline(stages=[logarithms, ScaleFeatures("standard", _LOGGED)]).fit(rows).write().save(path)
    return rounded(PipelineModel.load(path).transform(rows))


# A model from outside Spark ------------------------------------------------------------------


def _outside_score(matrix, intercept):
    """A fixed logistic score of rank and label rank."""
    return 1.0 / (1.0 + np.exp(-intercept - matrix[:, 0] / 1e6 - 0.1 * matrix[:, 1]))


@query(
    "custom_model",
    sql(
        "SELECT id, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS prediction, round(p, 6) AS probability, "
        "round(greatest(p, 1 - p), 6) AS confidence FROM (SELECT id, "
        f"1 / (1 + exp(0.5 - COALESCE(ALEXA_RANK, 0) / CAST(1000000 AS DOUBLE) - 0.1 * {RANGE_CASE})) AS p "
        "FROM companies)",
        "companies",
    ),
)
def custom_model(spark, d):
    rank = F.coalesce("ALEXA_RANK", F.lit(0)).cast("double").alias("ALEXA_RANK")
    rows = companies(spark, d).select("id", rank, "EMPLOYEE_RANGE")
    stages = Pipeline(stages=[RangeOrdinal(), AssembleFeatures(["id"])]).fit(rows).stages
    path = new_scratch_path(spark, "custom-model")
    PipelineModel(stages=[*stages, FunctionModel(_outside_score, intercept=-0.5)]).write().save(path)
    return rounded(predict_with_ids(PipelineModel.load(path), rows))


# Evaluation -------------------------------------------------------------------------------------


def _scored(spark, d):
    return role(spark, d, "scored")


def _predicted(spark, d):
    return threshold_predictions(_scored(spark, d), 0.5)


@query(
    "confusion_matrix",
    sql(
        "SELECT 0 AS actual, tn AS predicted_0, fp AS predicted_1 FROM counts "
        "UNION ALL SELECT 1, fn, tp FROM counts",
        "counts",
    ),
)
def confusion_matrix_query(spark, d):
    return confusion_matrix(_predicted(spark, d))


_D = "CAST({0} AS DOUBLE)"
_ACCURACY = "CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn)"
_PRECISION = "COALESCE(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0)"
_RECALL = "COALESCE(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0)"
_F1 = "COALESCE(2 * CAST(tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0)"


@query(
    "classification_metrics",
    sql(
        f"SELECT round({_ACCURACY}, 6) AS accuracy, round({_PRECISION}, 6) AS precision, "
        f"round({_RECALL}, 6) AS recall, round({_F1}, 6) AS f1 FROM counts",
        "counts",
    ),
)
def classification_metrics_query(spark, d):
    return rounded(classification_metrics(_predicted(spark, d)))


_REPORT_EXTRA = f"""classes AS (
    SELECT 1 AS class, 'Customer' AS name, {_PRECISION} AS p, {_RECALL} AS r, {_F1} AS f, fn + tp AS n FROM counts
    UNION ALL
    SELECT 0, 'Non-Customer', COALESCE(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0),
        COALESCE(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0),
        COALESCE(2 * CAST(tn AS DOUBLE) / nullif(2 * tn + fn + fp, 0), 0), tn + fp FROM counts)"""


@query(
    "classification_report",
    sql(
        "SELECT name AS row, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, "
        "n AS support FROM classes "
        f"UNION ALL SELECT 'accuracy', NULL, NULL, round({_ACCURACY}, 6), tp + tn + fp + fn FROM counts "
        "UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), "
        "CAST(sum(n) AS BIGINT) FROM classes "
        "UNION ALL SELECT 'weighted avg', round(sum(p * n) / sum(n), 6), round(sum(r * n) / sum(n), 6), "
        "round(sum(f * n) / sum(n), 6), CAST(sum(n) AS BIGINT) FROM classes",
        "counts",
        extra=_REPORT_EXTRA,
    ),
)
def classification_report_query(spark, d):
    return rounded(classification_report(_predicted(spark, d)))


@query("roc_auc", sql("SELECT round(roc_auc, 6) AS roc_auc FROM areas", "steps", extra=AREAS_SQL))
def roc_auc_query(spark, d):
    return rounded(roc_auc(_scored(spark, d)))


@query(
    "average_precision",
    sql(
        "SELECT round(average_precision, 6) AS average_precision FROM areas", "steps", extra=AREAS_SQL
    ),
)
def average_precision_query(spark, d):
    return rounded(average_precision(_scored(spark, d)))


@query(
    "roc_curve",
    sql(
        "SELECT round(score, 6) AS threshold, round(CAST(fp AS DOUBLE) / (SELECT sum(neg) FROM steps), 6) AS fpr, "
        "round(CAST(tp AS DOUBLE) / (SELECT sum(pos) FROM steps), 6) AS tpr FROM steps "
        "UNION ALL SELECT CAST('infinity' AS DOUBLE), 0, 0",
        "steps",
    ),
)
def roc_curve_query(spark, d):
    return rounded(roc_curve(_scored(spark, d)))


@query(
    "pr_curve",
    sql(
        "SELECT round(score, 6) AS threshold, round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision, "
        "round(CAST(tp AS DOUBLE) / (SELECT sum(pos) FROM steps), 6) AS recall FROM steps "
        "UNION ALL SELECT NULL, 1, 0",
        "steps",
    ),
)
def pr_curve_query(spark, d):
    return rounded(pr_curve(_scored(spark, d)))


_THRESHOLDS = f"""grid AS (
    SELECT CASE WHEN i = 99 THEN 1 ELSE i * (CAST(1 AS DOUBLE) / 99) END AS threshold
    FROM (SELECT unnest(generate_series(0, 99)) AS i)),
    tried AS (SELECT threshold, count(*) FILTER (WHERE y_true = 1 AND y_proba >= threshold) AS tp,
        count(*) FILTER (WHERE y_true = 0 AND y_proba >= threshold) AS fp,
        count(*) FILTER (WHERE y_true = 1 AND y_proba < threshold) AS fn FROM grid, scored GROUP BY threshold),
    judged AS (SELECT threshold, {_F1} AS f1, {_PRECISION} AS precision, {_RECALL} AS recall FROM tried)"""


def _best_sql(metric: str) -> str:
    return (
        f"(SELECT '{metric}' AS metric, round(threshold, 6) AS threshold, round({metric}, 6) AS value "
        f"FROM judged WHERE {metric} > 0 ORDER BY {metric} DESC, threshold LIMIT 1)"
    )


@query(
    "optimal_threshold",
    sql(
        " UNION ALL ".join(_best_sql(m) for m in ("f1", "precision", "recall")),
        "scored",
        extra=_THRESHOLDS,
    ),
)
def optimal_threshold_query(spark, d):
    return rounded(optimal_thresholds(_scored(spark, d)))


@query(
    "business_metrics",
    sql(
        "SELECT tp + fp AS total_contacts, tp AS successful_conversions, fn AS missed_conversions, "
        "CAST(tp * 500 AS DOUBLE) AS revenue, CAST((tp + fp) * 5 AS DOUBLE) AS cost, "
        "CAST(tp * 500 - (tp + fp) * 5 AS DOUBLE) AS profit, "
        "round(COALESCE((tp * 500 - (tp + fp) * 5) / nullif(CAST((tp + fp) * 5 AS DOUBLE), 0) * 100, 0), 6) "
        f"AS roi_percent, round({_PRECISION}, 6) AS precision, round({_RECALL}, 6) AS recall FROM counts",
        "counts",
    ),
)
def business_metrics_query(spark, d):
    return rounded(
        business_metrics(_predicted(spark, d), conversion_value=500.0, contact_cost=5.0)
    )


_HISTOGRAM = """ends AS (SELECT y_true AS actual, min(y_proba) AS low, max(y_proba) AS high FROM scored GROUP BY 1),
    edges AS (SELECT actual, bin, CASE WHEN bin = 50 THEN high ELSE low + bin * ((high - low) / CAST(50 AS DOUBLE)) END AS edge
        FROM ends, (SELECT unnest(generate_series(0, 50)) AS bin)),
    bins AS (SELECT a.actual, CAST(a.bin AS INT) AS bin, a.edge AS lower, b.edge AS upper FROM edges a
        JOIN edges b ON a.actual = b.actual AND b.bin = a.bin + 1)"""


@query(
    "score_histogram",
    sql(
        "SELECT actual, bin, round(lower, 6) AS lower, round(upper, 6) AS upper, count(y_proba) AS n FROM bins "
        "LEFT JOIN scored ON y_true = actual AND y_proba >= lower AND (y_proba < upper OR bin = 49) "
        "GROUP BY actual, bin, lower, upper",
        "scored",
        extra=_HISTOGRAM,
    ),
)
def score_histogram_query(spark, d):
    return rounded(score_histogram(_scored(spark, d)))


@query(
    "run_comparison",
    sql(
        f"SELECT run_id, run_time, {', '.join(f'round({c}, 6) AS {c}' for c in RUN_COLUMNS)}, "
        "run_id = (SELECT run_id FROM runs ORDER BY f1 DESC, run_time LIMIT 1) AS is_best FROM runs",
        "steps",
        extra=RUNS_SQL,
    ),
)
def run_comparison_query(spark, d):
    metrics = metrics_of_runs(spark, d)
    best = best_run(metrics, "f1").select("run_id").scalar()
    return rounded(run_comparison(metrics).withColumn("is_best", F.col("run_id") == best))
