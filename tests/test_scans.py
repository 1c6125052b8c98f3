"""Running totals, quantiles, curves and splits against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

import prospectra.operators.quantiles as quantiles
from prospectra.operators.curves import area_metrics, pr_curve, roc_auc, roc_curve
from prospectra.operators.metrics import (
    business_metrics,
    classification_metrics,
    classification_report,
    confusion_matrix,
    optimal_threshold,
    score_histogram,
    threshold_predictions,
    threshold_scores,
)
from prospectra.operators.prefix import dense_number, running_totals
from prospectra.operators.quantiles import column_modes, column_quantiles
from prospectra.operators.runs import all_metrics, best_run, metrics_table, run_comparison
from prospectra.operators.split import split_by_hash, split_stratified, with_folds
from prospectra.plans.evaluation import evaluate

FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
SCORED = "y_true int, y_proba double"


def scored_rows(n, seed, distinct=40):
    rng = random.Random(seed)
    return [(int(rng.random() < 0.4), rng.randrange(distinct) / (distinct - 1)) for _ in range(n)]


@FEW
@given(seed=st.integers(0, 10**6), descending=st.booleans())
def test_running_totals(spark, seed, descending):
    rng = random.Random(seed)
    keys = sorted({(rng.choice("ab"), rng.randrange(1000)) for _ in range(200)})
    data = pd.DataFrame([(g, k, rng.randrange(10)) for g, k in keys], columns=["g", "k", "n"])
    ordered = data.sort_values("k", ascending=not descending)
    expected = ordered.assign(cum_n=ordered.groupby("g")["n"].cumsum())
    found = running_totals(spark.createDataFrame(data), ["k"], ["n"], ["g"], descending).toPandas()
    key = ["g", "k"]
    pd.testing.assert_frame_equal(
        found.sort_values(key).reset_index(drop=True),
        expected.sort_values(key).reset_index(drop=True),
        check_dtype=False,
    )


def test_dense_number_of_text_keys(spark):
    words = [f"w{i:03d}" for i in range(300)]
    df = spark.createDataFrame([(w,) for w in random.Random(1).sample(words, 300)], "w string")
    found = {r["w"]: r["i"] for r in dense_number(df, ["w"], "i").collect()}
    assert found == {w: i for i, w in enumerate(words)}


def quantile_frame():
    rng = np.random.default_rng(3)
    frame = pd.DataFrame(
        {
            "normal": rng.normal(size=5000),
            "third": np.where(rng.random(5000) < 0.4, 7.0, rng.integers(0, 50, 5000)),
            "constant": 3.0,
            "gaps": np.where(rng.random(5000) < 0.5, np.nan, rng.random(5000)),
        }
    )
    return frame


def check_quantiles(spark, frame, probabilities):
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in frame.to_numpy()]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in frame.columns))
    found = {r["column"]: r["quantiles"] for r in column_quantiles(df, frame.columns, probabilities).collect()}
    for name in frame.columns:
        expected = frame[name].quantile(probabilities).tolist()
        assert found[name] == pytest.approx(expected, abs=1e-12), name


def test_quantiles_match_pandas(spark):
    check_quantiles(spark, quantile_frame(), [0.0, 0.25, 0.5, 0.75, 0.99, 1.0])


def test_quantiles_of_few_rows(spark):
    check_quantiles(spark, pd.DataFrame({"x": [1.0, 2.0, 3.0, 10.0]}), [0.25, 0.5, 0.75])
    check_quantiles(spark, pd.DataFrame({"x": [4.0]}), [0.5])


@pytest.mark.parametrize("fetched", [1, 50])
def test_quantiles_by_many_passes(spark, monkeypatch, fetched):
    """Cells are narrowed down to single values where none may be fetched."""
    monkeypatch.setattr(quantiles, "_FETCHED", fetched)
    check_quantiles(spark, quantile_frame(), [0.0, 0.25, 0.5, 0.999, 1.0])


def test_quantiles_of_batches_that_overlap(spark):
    """Of one cell, a batch that begins later may end earlier; what lies between must not get lost."""
    step = F.when(F.col("id") < 10_000, F.col("id")).otherwise(5_000)
    df = spark.range(0, 20_000, 1, 1).select((1 + step / 1e6).alias("x"))
    values = pd.Series([1 + (i if i < 10_000 else 5_000) / 1e6 for i in range(20_000)])
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    found = column_quantiles(df, ["x"], probabilities).first()["quantiles"]
    assert found == pytest.approx(values.quantile(probabilities).tolist(), abs=1e-12)


def test_quantiles_of_any_double(spark):
    values = [-0.0, 0.0, 5e-324, -5e-324, 1e308, -1e308, float("inf"), float("-inf"), 1.0, -1.0, float("nan"), None]
    df = spark.createDataFrame([(v, 1, "x") for v in values], "`my col` double, n int, s string")
    found = column_quantiles(df, ["n", "my col"], [i / 9 for i in range(10)]).collect()
    ordered = sorted(v + 0.0 for v in values if v is not None and v == v)
    assert {r["column"]: r["quantiles"] for r in found} == {"n": [1.0] * 10, "my col": ordered}
    whole = spark.range(-(2**53), -(2**53) + 2001).union(spark.range(2000))
    assert column_quantiles(whole, ["id"], [0.25, 0.75]).first()["quantiles"] == [-(2.0**53) + 1000, 999.0]


def test_quantiles_repeat_no_rows(spark):
    """The values are read by column: no row per column, no shuffle of values."""
    df = spark.range(10).select(F.col("id").alias("a"), F.col("id").alias("b"))
    cells = [quantiles._Cell(c, -(2**63), 2**63 - 1, 0, 52) for c in (0, 1)]
    assert quantiles._pass(df, cells).num_rows < 20
    plan = column_quantiles(df, ["a", "b"], [0.5])._jdf.queryExecution().toString()
    assert "Generate" not in plan and "Sort" not in plan


def test_quantiles_skip_empty_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], "empty double, x double")
    assert [r["column"] for r in column_quantiles(df, ["empty", "x"], [0.5]).collect()] == ["x"]
    assert column_quantiles(df, ["empty"], [0.5]).count() == 0


def test_sketched_quantiles(spark):
    df = spark.range(1001).select(F.col("id").cast("double").alias("x"))
    assert column_quantiles(df, ["x"], [0.5], accuracy=1000).first()["quantiles"][0] == pytest.approx(500, abs=2)


def test_modes(spark):
    df = spark.createDataFrame([(2.0, "b"), (1.0, "a"), (2.0, "a"), (1.0, None)], "x double, s string")
    assert column_modes(df, ["x"], "double").first()["mode"] == 1.0
    assert column_modes(df, ["s"], "string").first()["mode"] == "a"


def brute_areas(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, last = 0.0, 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(p >= t for p in pos)
        recall = tp / len(pos)
        ap += (recall - last) * tp / (tp + sum(n >= t for n in neg))
        last = recall
    return auc, ap


@FEW
@given(seed=st.integers(0, 10**6), distinct=st.sampled_from([2, 7, 300]))
def test_areas_match_brute_force(spark, seed, distinct):
    rows = [(1, 0.5), (0, 0.5), *scored_rows(150, seed, distinct)]
    found = area_metrics(spark.createDataFrame(rows, SCORED)).first()
    assert tuple(found) == pytest.approx(brute_areas(rows))


def test_auc_matches_spark_evaluator(spark):
    df = spark.createDataFrame(scored_rows(500, 5), SCORED)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="y_proba", labelCol="y_true", numBins=0)
    assert area_metrics(df).first()["roc_auc"] == pytest.approx(evaluator.evaluate(df))


def test_areas_of_one_class(spark):
    ones = spark.createDataFrame([(1, 0.2), (1, 0.7)], SCORED)
    zeros = spark.createDataFrame([(0, 0.2), (0, 0.7)], SCORED)
    assert tuple(area_metrics(ones).first()) == (None, 1.0)
    assert tuple(area_metrics(zeros).first()) == (None, 0.0)


def test_curves(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)], SCORED)
    roc = {(r["threshold"], r["fpr"], r["tpr"]) for r in roc_curve(df).collect()}
    assert roc == {(float("inf"), 0.0, 0.0), (0.9, 0.0, 0.5), (0.8, 0.5, 1.0), (0.1, 1.0, 1.0)}
    pr = {(r["threshold"], r["precision"], r["recall"]) for r in pr_curve(df).collect()}
    assert pr == {(None, 1.0, 0.0), (0.9, 1.0, 0.5), (0.8, 2 / 3, 1.0), (0.1, 0.5, 1.0)}


def test_metrics_without_positive_prediction(spark):
    df = threshold_predictions(spark.createDataFrame([(1, 0.1), (0, 0.2)], SCORED), 0.5)
    assert tuple(classification_metrics(df).first()) == (0.5, 0.0, 0.0, 0.0)
    assert [tuple(r) for r in confusion_matrix(df).collect()] == [(0, 1, 0), (1, 1, 0)]
    business = business_metrics(df).first()
    assert business["cost"] == 0.0 and business["roi_percent"] == 0.0 and business["missed_conversions"] == 1


def test_report_and_business_metrics(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4, "y_true int, y_pred int")
    report = {r["row"]: r for r in classification_report(df).collect()}
    assert report["Customer"]["precision"] == pytest.approx(0.6)
    assert report["Customer"]["recall"] == pytest.approx(0.75)
    assert report["Non-Customer"]["precision"] == pytest.approx(0.8)
    assert report["accuracy"]["f1"] == pytest.approx(0.7) and report["accuracy"]["support"] == 10
    assert report["weighted avg"]["recall"] == pytest.approx(0.7)
    business = business_metrics(df, conversion_value=10.0, contact_cost=2.0).first()
    assert (business["revenue"], business["cost"], business["profit"]) == (30.0, 10.0, 20.0)
    assert business["roi_percent"] == pytest.approx(200.0)


def brute_threshold(rows, metric):
    y = np.array([r[0] for r in rows])
    p = np.array([r[1] for r in rows])
    best = (0.5, 0.0)
    for t in np.linspace(0, 1, 100):
        tp, fp = int(((p >= t) & (y == 1)).sum()), int(((p >= t) & (y == 0)).sum())
        fn = int(((p < t) & (y == 1)).sum())
        value = {
            "f1": 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0,
            "precision": tp / (tp + fp) if tp + fp else 0.0,
            "recall": tp / (tp + fn) if tp + fn else 0.0,
        }[metric]
        if value > best[1]:
            best = (float(t), value)
    return best


@pytest.mark.parametrize("metric", ["f1", "precision", "recall"])
def test_optimal_threshold(spark, metric):
    # Scores on the thresholds themselves are the hard case.
    exact = [(i % 2, float(t)) for i, t in enumerate(np.linspace(0, 1, 100))]
    for rows in (exact, scored_rows(300, 9, 1000)):
        found = optimal_threshold(spark.createDataFrame(rows, SCORED), metric).first()
        assert tuple(found) == pytest.approx(brute_threshold(rows, metric))


def test_optimal_threshold_defaults(spark):
    df = spark.createDataFrame([(0, 0.3), (0, 0.6)], SCORED)
    assert tuple(optimal_threshold(df).first()) == (0.5, 0.0)
    assert threshold_scores(df).count() == 100
    with pytest.raises(ValueError, match="Unsupported metric"):
        optimal_threshold(df, "accuracy")


def test_score_histogram_matches_numpy(spark):
    rows = scored_rows(400, 11, 51) + [(1, 0.123456), (0, 0.98)]
    found = score_histogram(spark.createDataFrame(rows, SCORED)).toPandas()
    for label in (0, 1):
        counts, edges = np.histogram([p for y, p in rows if y == label], bins=50)
        mine = found[found["actual"] == label].sort_values("bin")
        assert mine["n"].tolist() == counts.tolist()
        assert mine["lower"].tolist() == pytest.approx(edges[:-1].tolist())


def test_score_histogram_of_one_score(spark):
    found = score_histogram(spark.createDataFrame([(1, 0.4)] * 3, SCORED)).where("n > 0").collect()
    assert [(r["bin"], r["n"]) for r in found] == [(25, 3)]


def test_runs(spark):
    df = spark.createDataFrame(scored_rows(200, 2), SCORED)
    tables = [
        metrics_table(all_metrics(df, t), f"r{i}", f"2024-01-0{i + 1} 00:00:00")
        for i, t in enumerate((0.9, 0.2, 0.2))
    ]
    metrics = tables[0].unionByName(tables[1]).unionByName(tables[2])
    assert [r["run_id"] for r in run_comparison(metrics).collect()] == ["r0", "r1", "r2"]
    assert best_run(metrics, "recall").first()["run_id"] == "r1"


def split_table(spark, n=5000):
    return spark.range(n).select("id", (F.col("id") % 4 == 0).cast("int").alias("is_customer"))


def test_split_is_disjoint_complete_and_exact(spark):
    split = split_stratified(split_table(spark), 0.2)
    counts = {(r["is_customer"], r["split"]): r["count"] for r in split.groupBy("is_customer", "split").count().collect()}
    assert counts == {(0, "test"): 750, (0, "train"): 3000, (1, "test"): 250, (1, "train"): 1000}
    again = split_stratified(split_table(spark).repartition(7), 0.2)
    assert split.exceptAll(again).count() == 0


def test_split_with_a_missing_class(spark):
    one = spark.range(10).select("id", F.lit(1).alias("is_customer"))
    assert split_stratified(one, 0.2).where("split = 'test'").count() == 2
    assert split_stratified(one, 0.0).where("split = 'test'").count() == 0


def test_hash_split_and_folds(spark):
    table = split_table(spark)
    share = split_by_hash(table, 0.2).where("split = 'test'").count() / 5000
    assert share == pytest.approx(0.2, abs=0.03)
    folds = {r["fold"]: r["count"] for r in with_folds(table).groupBy("fold").count().collect()}
    assert sorted(folds) == [0, 1, 2, 3, 4] and min(folds.values()) > 850


def test_running_totals_shuffle_once(spark, tmp_path):
    rows = [(i % 3, i, 1, None if i % 5 == 0 else 2) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, x int, one int, two int").repartition(7)
    out = running_totals(df, ["x"], ["one", "two"], ["g"]).collect()
    totals = {}
    for g, x, one, two in sorted(rows):
        a, b = totals.get(g, (0, 0))
        totals[g] = (a + one, b + (two or 0))
        assert [(r.cum_one, r.cum_two) for r in out if r.g == g and r.x == x] == [totals[g]]


def test_scores_without_a_place(spark):
    rows = [(1, 0.9), (0, 0.1), (0, float("nan")), (1, None), (0, 0.95)]
    scored = spark.createDataFrame(rows, "target int, probability double")
    assert roc_auc(scored, "target", "probability").first()[0] == 0.5


def test_null_keys_have_their_place_in_a_split(spark):
    rows = spark.createDataFrame([(None if i % 4 == 0 else i, i % 2) for i in range(400)], "id int, target int")
    out = split_by_hash(rows, 1.0)
    assert out.where("split = 'test'").count() == 400
    assert split_by_hash(rows, 0.5).where("id IS NULL").select("split").distinct().count() == 1


def test_quota_of_null_and_repeated_keys(spark):
    rows = [(None if i < 30 else i % 3, i, 1 if i < 90 else 0) for i in range(100)]
    table = spark.createDataFrame(rows, "id int, line int, is_customer int")
    exact = split_stratified(table, 0.2, key=["id", "line"])
    assert exact.where("split = 'test'").groupBy("is_customer").count().orderBy("is_customer").collect() == [(0, 2), (1, 18)]
    together = split_stratified(table, 0.2)
    sides = together.groupBy("is_customer", "id").agg(F.count_distinct("split").alias("n"))
    assert sides.where("n > 1").isEmpty()
    assert together.where("split = 'test' AND is_customer = 1").count() >= 18
    assert split_stratified(table, 1.0).where("split = 'test'").count() == 100


def test_folds_hold_even_parts_of_each_class(spark):
    rows = [(i, 1 if i % 25 == 0 else (None if i == 7 else 0)) for i in range(203)]
    folded = with_folds(spark.createDataFrame(rows, "id int, y int"), 5, label="y")
    counts = {(r["y"], r["fold"]): r["count"] for r in folded.groupBy("y", "fold").count().collect()}
    for y, size in ((1, 9), (0, 193)):
        assert sorted(counts[y, fold] for fold in range(5)) == sorted(size // 5 + (i < size % 5) for i in range(5))
    assert sum(counts.values()) == 203


@pytest.mark.parametrize("case", ["ties", "distinct", "one class", "empty"])
def test_evaluation_from_steps_equals_each_metric_from_rows(spark, case):
    rows = {
        "ties": [(i % 3 % 2, round((i * 37 % 101) / 100, 1)) for i in range(300)] + [(None, 0.5), (1, None), (0, 1.0)],
        "distinct": [(int(i * 7919 % 97 > 40), (i * 31 % 199) / 199) for i in range(199)],
        "one class": [(1, 0.2), (1, 0.7), (1, 0.7)],
        "empty": [],
    }[case]
    df = spark.createDataFrame(rows, "is_customer int, probability double").repartition(3)
    found, names = evaluate(df, 0.4), ("is_customer", "probability")
    df = df.where("probability IS NOT NULL")  # the row without a score is left out of every table
    predicted = threshold_predictions(df, 0.4, "probability")
    expected = {
        "metrics": all_metrics(df, 0.4, *names),
        "confusion": confusion_matrix(predicted, "is_customer"),
        "report": classification_report(predicted, "is_customer"),
        "business": business_metrics(predicted, "is_customer"),
        "best_threshold": optimal_threshold(df, "f1", *names),
        "roc": roc_curve(df, *names),
        "precision_recall": pr_curve(df, *names),
        "histogram": score_histogram(df, *names),
    }
    for name, table in expected.items():
        other = getattr(found, name)
        assert other.columns == table.columns, name
        left, right = (sorted(map(tuple, t.collect()), key=repr) for t in (other, table))
        assert len(left) == len(right), name
        for a, b in zip(left, right):
            assert a == pytest.approx(b), name


def test_evaluation_reads_the_predictions_once(spark):
    """Every pass over the predictions calls the function once per row."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def score(i):
        seen.add(1)
        return i / 50.0

    df = spark.range(50).select((F.col("id") % 2).cast("int").alias("is_customer"), score("id").alias("probability"))
    found = evaluate(df)
    for table in vars(found).values():
        table.collect()
    assert seen.value == 50
