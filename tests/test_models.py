import re

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

import prospectra.ml.models as models
import prospectra.ml.newton as newton_steps
from prospectra.ml.evaluation import cross_validate
from prospectra.ml.foreign import FunctionModel
from prospectra.ml.models import MODEL_TYPES, ConversionClassifier, create_model, importances, logistic_optimality
from prospectra.operators.metrics import classification_metrics
from prospectra.plans.scoring import (
    answer_requests,
    explain_rows,
    predict,
    predict_batch,
    predict_with_ids,
    score_prospects,
    score_requests,
)
from prospectra.plans.training import TrainingConfig, load_model, save_artifacts, train
from prospectra.sources import REQUESTS, materialize, scratch, scratch_run
from prospectra.streaming import read_request_stream, score_stream


def requests_frame(spark, n=400):
    """Requests with a label that depends on them."""
    i = F.col("id")
    noise = (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("noise")
    rows = spark.range(n).select("id", noise).select(
        "id",
        (i % 97 + 1).cast("double").alias("ALEXA_RANK"),
        F.when(i % 5 == 0, "1").when(i % 5 == 1, "26 to 50").otherwise("10,001 or more").alias("EMPLOYEE_RANGE"),
        F.when(i % 3 == 0, "a").when(i % 3 == 1, "b").otherwise("c").alias("INDUSTRY"),
        (i % 11).cast("double").alias("total_actions"),
        (i % 4).cast("double").alias("total_users"),
        (i % 7).cast("double").alias("days_active"),
        (i % 13 / 4.0).alias("activity_frequency"),
        "noise",
    )
    converts = F.col("total_actions") / 11 + F.col("noise") + F.when(F.col("INDUSTRY") == "a", 0.4).otherwise(0.0)
    return rows.withColumn("is_customer", (converts > 1.0).cast("int")).drop("noise")


@pytest.fixture(scope="module")
def result(spark):
    return train(requests_frame(spark), TrainingConfig(folds=0))


def newton(x, y, weights, c):
    """Minimiser of c * weighted log loss + |b|^2 / 2, the intercept unpenalised."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([1.0] * (x.shape[1] - 1) + [0.0])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        gradient = c * x.T @ (weights * (p - y)) + ridge @ beta
        hessian = c * (x * (weights * p * (1 - p))[:, None]).T @ x + ridge
        beta -= np.linalg.solve(hessian, gradient)
    return beta


@pytest.mark.parametrize(("c", "balanced"), [(1.0, True), (0.1, False)])
def test_logistic_matches_newton(spark, c, balanced):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 3)) * [1.0, 2.0, 0.5]
    y = (x @ [1.0, -0.5, 2.0] + rng.normal(size=300) > 1.0).astype(int)
    weights = np.where(y == 1, 300 / (2 * y.sum()), 300 / (2 * (1 - y).sum())) if balanced else np.ones(300)
    expected = newton(x, y, weights, c)
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], "a double, b double, c double, is_customer int")
    rows = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    settings = {"C": c, "tol": 1e-9, "class_weight": "balanced" if balanced else None}
    model = create_model("logistic_regression", settings).fit(rows)
    assert model.coefficients.toArray() == pytest.approx(expected[:3], abs=1e-4)
    assert model.intercept == pytest.approx(expected[3], abs=1e-4)


def test_model_factory_translates_settings(spark):
    with pytest.raises(ValueError, match="Available: logistic_regression, random_forest, xgboost, lightgbm"):
        create_model("svm")
    with pytest.raises(ValueError, match="Unknown hyperparameters of xgboost: depth"):
        create_model("xgboost", {"depth": 3})
    forest = create_model("random_forest", {"max_depth": None, "min_samples_split": 5, "n_jobs": -1})
    spark_forest = forest._classifier(forest.settings(), 1.0)
    assert (spark_forest.getMaxDepth(), spark_forest.getMinInstancesPerNode()) == (30, 3)
    assert spark_forest.getNumTrees() == 100
    deep = create_model("random_forest", {"max_depth": 45})
    with pytest.raises(ValueError, match="down to depth 30"):
        deep._classifier(deep.settings(), 1.0)
    boosted = create_model("lightgbm", {"num_leaves": 31})
    assert boosted._classifier(boosted.settings(), 1.0).getMaxDepth() == 5
    settings = {"colsample_bytree": 0.5, "min_child_samples": 7, "min_split_gain": 0.25, "subsample": 0.5}
    drawn = create_model("lightgbm", settings)
    drawn = drawn._classifier(drawn.settings(), 1.0)
    assert (drawn.getFeatureSubsetStrategy(), drawn.getMinInstancesPerNode()) == ("0.5", 7)
    assert (drawn.getMinInfoGain(), drawn.getSubsamplingRate()) == (0.25, 0.5)
    with pytest.raises(ValueError, match="colsample_bytree"):
        bad = create_model("xgboost", {"colsample_bytree": 2})
        bad._classifier(bad.settings(), 1.0)
    sampled = create_model("random_forest", {"max_samples": 0.3, "min_impurity_decrease": 0.1})
    sampled = sampled._classifier(sampled.settings(), 1.0)
    assert (sampled.getSubsamplingRate(), sampled.getMinInfoGain()) == (0.3, 0.1)
    logistic = create_model("logistic_regression", {"C": 2.0, "penalty": "l1", "solver": "saga"})
    spark_logistic = logistic._classifier(logistic.settings(), 100.0)
    assert (spark_logistic.getRegParam(), spark_logistic.getElasticNetParam()) == (0.005, 1.0)


@pytest.mark.parametrize(("intercept", "balanced", "scale"), [(True, True, 1.0), (False, False, 1.0), (True, False, 1e5)])
def test_logistic_of_many_rows_needs_few_passes(spark, monkeypatch, intercept, balanced, scale):
    """Inputs that depend on each other: the same model as of Spark's solver, by a handful of jobs."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(1200, 3)) * [1.0, 2.0, scale]
    x = np.column_stack([x, x[:, 0] + x[:, 1], (x[:, 2] > 0).astype(float), (x[:, 2] <= 0).astype(float)])
    y = (x[:, 0] + x[:, 2] / scale + rng.normal(size=1200) > 0.7).astype(int)
    names = [f"x{i}" for i in range(6)]
    df = spark.createDataFrame([(*map(float, r), int(t)) for r, t in zip(x, y)], ", ".join(f"{n} double" for n in names) + ", is_customer int")
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(df)
    settings = {"C": 1.0, "tol": 1e-14, "fit_intercept": intercept, "class_weight": "balanced" if balanced else None}
    classifier = create_model("logistic_regression", settings)
    expected = classifier.fit(rows)
    passes = []
    counted = newton_steps._sums
    monkeypatch.setattr(newton_steps, "_sums", lambda *given: passes.append(1) or counted(*given))
    monkeypatch.setattr(models, "TASK_ROWS", 500)
    found = classifier.fit(rows)
    assert 0 < len(passes) <= 12
    ours, theirs = ([r["probability"][1] for r in m.transform(rows).select("probability").collect()] for m in (found, expected))
    assert ours == pytest.approx(theirs, abs=1e-4)
    assert (found.getRegParam(), found.getLabelCol(), found.numFeatures) == (expected.getRegParam(), "is_customer", 6)
    slopes = logistic_optimality(PipelineModel(stages=[VectorAssembler(inputCols=names, outputCol="features"), found]), classifier, df)
    assert max(abs(r["slope"]) for r in slopes.collect()) < 1e-7 * scale


def test_logistic_of_many_rows_is_saved_and_refuses_bad_labels(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(models, "TASK_ROWS", 50)
    df = spark.range(200).select((F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3 == 0).cast("int").alias("is_customer"))
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = create_model("logistic_regression").fit(rows)
    model.write().save(f"{tmp_path}/model")
    again = LogisticRegressionModel.load(f"{tmp_path}/model")
    assert again.coefficients == model.coefficients and again.intercept == model.intercept
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        create_model("logistic_regression").fit(rows.withColumn("is_customer", F.expr("CASE WHEN x < 6 THEN is_customer ELSE 2 END")))


@pytest.mark.parametrize("model_type", MODEL_TYPES)
def test_a_fit_takes_few_rows_per_task(spark, model_type, monkeypatch):
    """One file is one partition, however many rows it holds; the fit deals them out and learns the same."""
    rows = spark.range(0, 2000, 1, 1).select((F.col("id") % 4).cast("double").alias("x"), (F.col("id") % 4 > 1).cast("int").alias("is_customer"))
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    taken = []
    builder = ConversionClassifier._classifier

    def watched(self, *given):
        classifier = builder(self, *given)
        fit = classifier.fit

        def fitted(train):
            taken.append([len(part) for part in train.select("is_customer").rdd.glom().collect()])
            return fit(train)

        classifier.fit = fitted
        return classifier

    monkeypatch.setattr(ConversionClassifier, "_classifier", watched)
    settings = {} if model_type == "logistic_regression" else {"n_estimators": 2}
    whole = create_model(model_type, settings).fit(rows)
    monkeypatch.setattr(models, "TASK_ROWS", 300)
    dealt = create_model(model_type, settings).fit(rows)
    assert taken[0] == [2000]
    if model_type == "logistic_regression":
        dealt = create_model(model_type, {"penalty": None, "max_iter": 20}).fit(rows)
    assert sum(taken[1]) == 2000 and max(taken[1]) <= 300
    classes = [[r["prediction"] for r in m.transform(rows).orderBy("x").collect()] for m in (whole, dealt)]
    assert classes[0] == classes[1] == [0.0] * 1000 + [1.0] * 1000


@pytest.mark.parametrize("model_type", MODEL_TYPES)
def test_every_type_learns(spark, model_type):
    small = {} if model_type == "logistic_regression" else {"n_estimators": 5, "max_depth": 3}
    result = train(requests_frame(spark), TrainingConfig(model_type, small, folds=0))
    assert result.evaluation.metrics.first()["roc_auc"] > 0.7
    importance = {r["feature"]: r["importance"] for r in result.importance.collect()}
    assert max(importance, key=importance.get) in ("total_actions", "industry_a")
    assert "is_customer" not in importance and "id" not in importance


def test_function_models_are_saved_by_name(spark, tmp_path):
    df = spark.createDataFrame([(1, 0.25), (2, 0.75)], "id int, a double")
    assemble = VectorAssembler(inputCols=["a"], outputCol="features")
    PipelineModel(stages=[assemble, FunctionModel(np.mean, axis=1)]).write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    scored = predict_with_ids(loaded, df).orderBy("id").collect()
    assert [r["probability"] for r in scored] == [0.25, 0.75]
    unnamed = FunctionModel(lambda matrix: matrix[:, 0] / 2)
    scored = predict_with_ids(PipelineModel(stages=[assemble, unnamed]), df).orderBy("id").collect()
    assert [r["probability"] for r in scored] == [0.125, 0.375]
    with pytest.raises(ValueError, match="cannot be imported again"):
        unnamed.write()


def test_cross_validation(spark, result):
    rows = result.model.transform(result.rows.where("split = 'train'")).select("id", "is_customer", "features")
    folds = cross_validate(create_model("logistic_regression"), rows.cache(), 3).collect()
    scores = [r["roc_auc"] for r in folds]
    assert [r["fold"] for r in folds] == [0, 1, 2] and all(s > 0.6 for s in scores)
    assert folds[0]["cv_mean"] == pytest.approx(np.mean(scores))
    assert folds[0]["cv_std"] == pytest.approx(np.std(scores))


def test_predictions(spark, result):
    rows = requests_frame(spark).drop("is_customer")
    scored = predict(result.model, rows).collect()
    assert list(scored[0].asDict()) == [*rows.columns, "prediction", "probability", "confidence"]
    assert all(r["prediction"] == int(r["probability"] > 0.5) for r in scored)
    assert all(r["confidence"] == max(r["probability"], 1 - r["probability"]) for r in scored)
    assert scored[0]["INDUSTRY"] == "a"  # inputs come back as they were
    short = predict_with_ids(result.model, rows, return_proba=False)
    assert short.columns == ["id", "prediction"] and short.count() == 400
    assert predict_batch(result.model, rows).exceptAll(predict(result.model, rows)).count() == 0
    with pytest.raises(ValueError, match="no column 'ID'"):
        predict_with_ids(result.model, rows, "ID")
    best = max(scored, key=lambda r: (r["probability"], -r["id"]))
    assert score_prospects(result.model, rows, 5).first()["id"] == best["id"]


def test_predict_replaces_older_predictions(spark, result):
    once = predict(result.model, requests_frame(spark))
    twice = predict(result.model, once)
    assert sorted(twice.columns) == sorted({*once.columns})
    accuracy = classification_metrics(twice, "is_customer", "prediction").first()["accuracy"]
    assert accuracy > 0.6


def test_explanations(spark, result):
    rows = requests_frame(spark, 20)
    explained = explain_rows(result.model, rows, n=3).collect()
    top = sorted(importances(result.model), key=lambda p: -p[1])[:3]
    assert [tuple(f) for f in explained[0]["top_features"]] == top
    for row in explained:
        sizes = [abs(c["contribution"]) for c in row["contributions"]]
        assert len(sizes) == 3 and sizes == sorted(sizes, reverse=True)
    # All contributions and the intercept make up the score.
    every = explain_rows(result.model, rows, n=100).first()
    total = sum(c["contribution"] for c in every["contributions"]) + result.model.stages[-1].intercept
    assert 1 / (1 + np.exp(-total)) == pytest.approx(every["probability"])


def test_evaluation_tables_agree(result):
    tables, n = result.evaluation, result.predictions.count()
    report = {r["row"]: r for r in tables.report.collect()}
    assert report["accuracy"]["support"] == n == tables.histogram.agg(F.sum("n")).first()[0]
    assert report["accuracy"]["f1"] == pytest.approx(tables.metrics.first()["accuracy"])
    assert sum(r["predicted_0"] + r["predicted_1"] for r in tables.confusion.collect()) == n
    assert tables.best_threshold.first()["value"] >= tables.metrics.first()["f1"]
    assert tables.roc.count() == tables.precision_recall.count()
    contacts = sum(r["predicted_1"] for r in tables.confusion.collect())
    assert tables.business.first()["total_contacts"] == contacts


def test_artifacts(spark, result, tmp_path):
    path = str(tmp_path / "run")
    save_artifacts(result, path, "run_1", "2024-01-01 00:00:00")
    loaded = load_model(path)
    assert isinstance(loaded, PipelineModel)
    rows = requests_frame(spark)
    assert predict(loaded, rows).exceptAll(predict(result.model, rows)).count() == 0
    splits = spark.read.parquet(f"{path}/splits")
    # Features as the classifier saw them, not the raw columns.
    assert splits.count() == 400 and {"id", "target", "split", "industry_onehot"} <= {*splits.columns}
    assert not {"INDUSTRY", "EMPLOYEE_RANGE"} & {*splits.columns}
    mean = splits.where("split = 'train'").agg(F.avg("ALEXA_RANK")).first()[0]
    assert mean == pytest.approx(0.0, abs=1e-9)
    metrics = {r["metric"]: r["value"] for r in spark.read.parquet(f"{path}/metrics").collect()}
    assert metrics["roc_auc"] == pytest.approx(result.evaluation.metrics.first()["roc_auc"])


def test_a_run_leaves_no_scratch(spark, tmp_path, monkeypatch):
    root = tmp_path / "scratch"
    monkeypatch.setattr(scratch, "scratch_root", lambda spark: str(root))
    with scratch_run(spark):
        found = train(requests_frame(spark), TrainingConfig(folds=2))
        save_artifacts(found, str(tmp_path / "model"), "run_1", "2024-01-01 00:00:00")
        assert list(root.rglob("*.parquet"))
    assert not list(root.iterdir())
    with pytest.raises(RuntimeError), scratch_run(spark):
        materialize(spark.range(3), "x")
        raise RuntimeError
    assert not list(root.iterdir())
    folds = spark.read.parquet(str(tmp_path / "model/cross_validation"))
    assert sorted(r["fold"] for r in folds.collect()) == [0, 1]
    assert predict(load_model(str(tmp_path / "model")), requests_frame(spark)).count() == 400


def test_requests_batch_and_stream_agree(spark, result, tmp_path):
    good = requests_frame(spark, 60).select(REQUESTS.fieldNames())
    bad = good.limit(5).withColumn("ALEXA_RANK", F.lit(0.0)).withColumn("id", F.col("id") + 1000)
    good.unionByName(bad).repartition(4).write.parquet(str(tmp_path / "in"))
    batch = score_requests(result.model, spark.read.parquet(str(tmp_path / "in")))
    assert batch.columns == ["company_id", "conversion_probability", "prediction", "confidence"]
    assert batch.count() == 60

    def run():
        stream = read_request_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
        query = score_stream(result.model, stream, str(tmp_path / "out"), str(tmp_path / "progress"), once=True)
        query.awaitTermination()
        return spark.read.parquet(str(tmp_path / "out/status=answered")).drop("failed_rules")

    assert run().exceptAll(batch).count() == 0 and run().count() == 60
    refused = spark.read.parquet(str(tmp_path / "out/status=refused")).collect()
    assert len(refused) == 5 and all(r["failed_rules"] == ["rank_positive"] for r in refused)
    assert all(r["company_id"] >= 1000 and r["prediction"] is None for r in refused)
    # After a restart only the new requests are answered.
    good.withColumn("id", F.col("id") + 5000).write.mode("append").parquet(str(tmp_path / "in"))
    assert run().count() == 120


def test_stream_reads_its_source_once(spark, result, tmp_path):
    requests_frame(spark, 3).select(REQUESTS.fieldNames()).write.parquet(str(tmp_path / "in"))
    stream = read_request_stream(spark, str(tmp_path / "in"))
    plan = answer_requests(result.model, stream)._jdf.queryExecution().analyzed().toString()
    assert plan.count("StreamingRelation") == 1


def test_refused_requests_never_reach_the_model(spark, result):
    """Not even with values that the assembler rejects; every rule is named, in any mixture."""
    rows = [
        (1, 5.0, "1", "a", 1.0, 1.0, 1.0, 0.5),
        (None, None, None, None, None, None, None, None),
        (3, float("nan"), "1", "a", -1.0, 1.0, 1.0, 0.5),
        (4, 5.0, "many", "never seen", 1.0, 1.0, 1.0, 0.5),
        (5, 5.0, "1", "never seen", 1.0, 1.0, 1.0, 0.5),
    ]
    requests = spark.createDataFrame(rows, REQUESTS)
    answers = {r["company_id"]: r for r in answer_requests(result.model, requests).collect()}
    assert len(answers[None]["failed_rules"]) == 8 and answers[4]["failed_rules"] == ["range_known"]
    assert answers[3]["failed_rules"] == ["total_actions_nonneg"]
    for key, row in answers.items():
        refused = key in (None, 3, 4)
        assert row["status"] == ("refused" if refused else "answered")
        assert (row["conversion_probability"] is None) == (row["prediction"] is None) == (row["confidence"] is None) == refused
    kept = score_requests(result.model, requests).collect()
    assert {r["company_id"]: r["conversion_probability"] for r in kept} == {
        key: row["conversion_probability"] for key, row in answers.items() if row["status"] == "answered"
    }


def test_a_half_written_batch_is_answered_once(spark, result, tmp_path):
    requests_frame(spark, 60).select(REQUESTS.fieldNames()).repartition(3).write.parquet(str(tmp_path / "in"))

    def run():
        stream = read_request_stream(spark, str(tmp_path / "in"), max_files_per_trigger=1)
        out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
        score_stream(result.model, stream, out, progress, once=True).awaitTermination()
        return spark.read.parquet(out)

    before = sorted(r["company_id"] for r in run().collect())
    # As after a crash: files of the last batch are there, neither sink nor checkpoint know of them.
    for log in (tmp_path / "out/_spark_metadata/2", tmp_path / "progress/commits/2"):
        log.unlink()
        (log.parent / f".{log.name}.crc").unlink(missing_ok=True)
    assert run().count() == 60 and sorted(r["company_id"] for r in run().collect()) == before


@pytest.mark.parametrize("model_type", ["random_forest", "xgboost", "lightgbm"])
def test_split_importance_counts_nodes(spark, model_type):
    settings = {"n_estimators": 4, "max_depth": 3}
    found = train(requests_frame(spark), TrainingConfig(model_type, settings, folds=0))
    counted = importances(found.model, "split")
    nodes = re.findall(r"If \(feature (\d+) ", found.model.stages[-1].toDebugString)
    assert [n for _, n in counted] == [nodes.count(str(i)) for i in range(len(counted))]
    assert sum(n for _, n in counted) > 4 and any(n == 0 for _, n in counted)
    reported = {r["feature"]: r["importance"] for r in found.importance.collect()}
    assert reported == dict(counted if model_type == "lightgbm" else importances(found.model))
    explained = explain_rows(found.model, requests_frame(spark, 2), 3, importance="split").first()
    assert explained["top_features"][0]["importance"] == max(n for _, n in counted)
    with pytest.raises(ValueError, match="Unknown importance"):
        importances(found.model, "cover")


@pytest.mark.parametrize("penalty", ["l2", "l1", "elasticnet", None])
def test_optimality_of_a_logistic_model(spark, result, penalty):
    rows = materialize(result.rows.where("split = 'train'"), "train")
    stages = list(result.model.stages[:-1])
    settings = {"penalty": penalty, "C": 0.05, "class_weight": "balanced", "tol": 1e-12, "max_iter": 5000}
    classifier = create_model("logistic_regression", settings)
    model = PipelineModel(stages=[*stages, classifier.fit(PipelineModel(stages=stages).transform(rows))])
    table = {r["feature"]: r for r in logistic_optimality(model, classifier, rows).collect()}
    assert list(table) == [name for name, _ in importances(model)] + ["intercept"]
    assert table["intercept"]["moment"] == pytest.approx(0.5)
    assert max(abs(r["slope"]) for r in table.values()) < 1e-5
    # The moments are of the data alone; a model stopped early is told from the best.
    early = create_model("logistic_regression", settings | {"max_iter": 1})
    stopped = PipelineModel(stages=[*stages, early.fit(PipelineModel(stages=stages).transform(rows))])
    worse = {r["feature"]: r for r in logistic_optimality(stopped, early, rows).collect()}
    assert max(abs(r["slope"]) for r in worse.values()) > 1e-3
    assert {k: r["moment"] for k, r in worse.items()} == pytest.approx({k: r["moment"] for k, r in table.items()})
