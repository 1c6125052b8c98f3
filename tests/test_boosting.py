"""Boosted trees of second order against trees grown one leaf at a time in numpy."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from prospectra.ml import boosting
from prospectra.ml.models import create_model, importances

NAMES = ["few", "many", "flat", "flag"]


def table(n=700, seed=5):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.normal(size=n).round(3), np.full(n, 3.0), rng.integers(0, 2, n)]).astype(float)
    score = np.sin(x[:, 0]) + x[:, 1] * (x[:, 3] - 0.4)
    y = (rng.random(n) < 1 / (1 + np.exp(-2 * score))).astype(float)
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(*map(float, r), int(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "few double, many double, flat double, flag double, is_customer int").repartition(parts)


def borders(column, max_bins):
    values = np.unique(column)
    if len(values) <= max_bins:
        return (values[:-1] + values[1:]) / 2
    return np.unique(np.quantile(column, [k / max_bins for k in range(1, max_bins)]))


def brute(x, y, w, *, trees, rate, depth, leaves, l1, l2, gain, hessian, rows, bins, base):
    """Probabilities and number of splits per input; a leaf at a time, best gain first."""
    margin, counts = np.full(len(y), np.log(base / (1 - base))), [0] * x.shape[1]

    def pull(g):
        return np.sign(g) * max(abs(g) - l1, 0)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)

        def best(part, level):
            found = (max(gain, 1e-6), None)
            if level == depth:
                return found
            whole = pull(g[part].sum()) ** 2 / (h[part].sum() + l2)
            for f in range(x.shape[1]):
                for c in borders(x[:, f], bins):
                    low, high = part[x[part, f] <= c], part[x[part, f] > c]
                    if min(len(low), len(high)) < rows or min(h[low].sum(), h[high].sum()) < hessian:
                        continue
                    got = sum(pull(g[s].sum()) ** 2 / (h[s].sum() + l2) for s in (low, high)) - whole
                    if got > found[0] + 1e-9:
                        found = (got, (f, low, high))
            return found

        start = np.arange(len(y))
        open_leaves = [(start, 0, best(start, 0))]
        while leaves == 0 or len(open_leaves) < leaves:
            able = [leaf for leaf in open_leaves if leaf[2][1]]
            if not able:
                break
            pick = max(able, key=lambda leaf: leaf[2][0])
            open_leaves = [leaf for leaf in open_leaves if leaf is not pick]
            feature, *sides = pick[2][1]
            counts[feature] += 1
            open_leaves += [(side, pick[1] + 1, best(side, pick[1] + 1)) for side in sides]
        for part, _, _ in open_leaves:
            margin[part] -= rate * pull(g[part].sum()) / (h[part].sum() + l2)
    return 1 / (1 + np.exp(-margin)), counts


def fitted(spark, df, kind, settings):
    stages = [VectorAssembler(inputCols=NAMES, outputCol="features"), create_model(kind, {"trees": "second_order", **settings})]
    return Pipeline(stages=stages).fit(df)


def probabilities(model, df):
    scored = model.transform(df).select(*NAMES, vector_to_array("probability")[1].alias("p"))
    return {tuple(r[:4]): r["p"] for r in scored.collect()}


@pytest.mark.parametrize(
    ("kind", "settings", "grown"),
    [
        ("xgboost", {"max_depth": 3, "gamma": 0.5, "scale_pos_weight": 1.5}, {"depth": 3, "gain": 0.5}),
        ("xgboost", {"max_depth": 2, "reg_alpha": 2.0}, {"depth": 2, "l1": 2.0}),
        ("lightgbm", {"num_leaves": 6, "min_child_samples": 20}, {"leaves": 6, "rows": 20, "l2": 0.0, "hessian": 1e-3, "base": None}),
        ("lightgbm", {"num_leaves": 9, "max_depth": 4, "reg_lambda": 2.0}, {"leaves": 9, "depth": 4, "rows": 20, "l2": 2.0, "hessian": 1e-3, "base": None}),
    ],
)
def test_against_one_leaf_at_a_time(spark, monkeypatch, kind, settings, grown):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    monkeypatch.setattr(boosting, "MAX_CELLS", 60)
    x, y = table()
    w = np.where(y == 1, settings.get("scale_pos_weight", 1.0), 1.0)
    given = {"depth": 0, "leaves": 0, "l1": 0.0, "l2": 1.0, "gain": 0.0, "hessian": 1.0, "rows": 1, "base": 0.5} | grown
    given["depth"] = given["depth"] or -1
    given["base"] = given["base"] or float(np.average(y, weights=w))
    expected, splits = brute(x, y, w, trees=5, rate=0.3, bins=16, **given)
    df = frame(spark, x, y)
    model = fitted(spark, df, kind, {"n_estimators": 5, "learning_rate": 0.3, "max_bins": 16, **settings})
    got = probabilities(model, df)
    assert [got[tuple(r)] for r in x] == pytest.approx(expected, abs=1e-6)
    assert [n for _, n in importances(model, "split")] == splits
    gains = dict(importances(model, "gain"))
    assert sum(gains.values()) == pytest.approx(1.0) and gains["flat"] == 0.0


def test_partitions_do_not_matter_and_models_save(spark, tmp_path):
    x, y = table(300, 8)
    settings = {"n_estimators": 4, "subsample": 0.7, "colsample_bytree": 0.5, "num_leaves": 5}
    df = frame(spark, x, y, 1)
    model = fitted(spark, df, "lightgbm", settings)
    model.write().save(f"{tmp_path}/model")
    again = PipelineModel.load(f"{tmp_path}/model")
    assert probabilities(again, df) == probabilities(model, df)
    assert len(set(probabilities(model, df).values())) > 4
    whole = settings | {"subsample": 1.0}
    one, many = (fitted(spark, frame(spark, x, y, n), "lightgbm", whole) for n in (1, 5))
    assert probabilities(one, df) == probabilities(many, df)


def test_edges(spark):
    x, y = table(40, 2)
    with pytest.raises(ValueError, match="no rows"):
        fitted(spark, frame(spark, x, y).where("few > 99"), "xgboost", {})
    flat = np.full_like(x, 2.0)
    constant = probabilities(fitted(spark, frame(spark, flat, y), "lightgbm", {"n_estimators": 2}), frame(spark, flat, y))
    assert list(constant.values()) == pytest.approx([y.mean()])
    ones = fitted(spark, frame(spark, x, np.ones(40)), "xgboost", {"n_estimators": 2})
    assert min(probabilities(ones, frame(spark, x, y)).values()) > 0.5
    with pytest.raises(ValueError, match="Only trees of second order have reg_lambda"):
        create_model("xgboost", {"reg_lambda": 2.0})
    with pytest.raises(ValueError, match="Unknown trees"):
        create_model("xgboost", {"trees": "third_order"})
    with pytest.raises(ValueError, match="max_bins"):
        fitted(spark, frame(spark, x, y), "xgboost", {"max_bins": 300})
