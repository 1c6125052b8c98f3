import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from prospectra.ml import stages
from prospectra.ml.stages import (
    AssembleFeatures,
    EncodeCategorical,
    ImputeMissing,
    OneHotFrequent,
    OneHotVectorModel,
    RangeOrdinal,
    ScaleFeatures,
)
from prospectra.plans.training import TrainingConfig, feature_stages
from prospectra.sources.scratch import materialize, scratch_run

INDUSTRY = "id bigint, INDUSTRY string"


def column(df, name, order="id"):
    return [row[name] for row in df.orderBy(order).collect()]


def test_range_ordinal_replaces_the_label(spark):
    df = spark.createDataFrame([(1, " 2 to 5\t"), (2, None)], "id bigint, EMPLOYEE_RANGE string")
    out = RangeOrdinal().transform(df)
    assert out.columns == ["id", "employee_range_ordinal"]
    assert column(out, "employee_range_ordinal") == [2, -1]
    bare = df.drop("EMPLOYEE_RANGE")
    assert RangeOrdinal().transform(bare).columns == ["id"]


def test_onehot(spark):
    train = spark.createDataFrame(
        [(i, "a") for i in range(5)] + [(i, "b") for i in range(5, 9)] + [(9, "Other"), (10, None)], INDUSTRY
    )
    model = OneHotFrequent(minFrequency=5).fit(train)
    out = model.transform(train)
    assert out.columns == ["id", "industry_Other", "industry_a"]
    assert column(out, "industry_a") == [1] * 5 + [0] * 6
    assert column(out, "industry_Other") == [0] * 5 + [1] * 6
    unseen = model.transform(spark.createDataFrame([(1, "zzz")], INDUSTRY))
    assert unseen.first() == (1, 1, 0)


def test_onehot_merges_a_frequent_other(spark):
    train = spark.createDataFrame([(i, "Other") for i in range(3)] + [(3, None), (4, "x")], INDUSTRY)
    out = OneHotFrequent(minFrequency=3).fit(train).transform(train)
    assert out.columns == ["id", "industry_Other"]
    assert column(out, "industry_Other") == [1] * 5


def test_onehot_of_odd_names_and_absent_columns(spark):
    train = spark.createDataFrame([(1, "a.b, c"), (2, "a.b, c")], INDUSTRY)
    model = OneHotFrequent(minFrequency=1).fit(train)
    assert model.transform(train).columns == ["id", "industry_Other", "industry_a_b, c"]
    assert model.transform(train.drop("INDUSTRY")).columns == ["id"]
    clash = spark.createDataFrame([(1, "a.b"), (2, "a_b")], INDUSTRY)
    with pytest.raises(ValueError, match="share the column name"):
        OneHotFrequent(minFrequency=1).fit(clash).transform(clash)


def test_onehot_vector_of_many_categories(spark, tmp_path):
    many = spark.range(6000).selectExpr("id", "'c' || id % 2500 AS INDUSTRY")
    fitted = OneHotFrequent(minFrequency=1, output="vector").fit(many)
    fitted.write().save(str(tmp_path / "onehot"))
    model = OneHotVectorModel.load(str(tmp_path / "onehot"))
    names = model.slot_names()
    assert len(names) == 2501 and names[-1] == "industry_Other"
    seen = spark.createDataFrame([(1, "c7"), (2, None), (3, "zzz"), (4, "Other")], INDUSTRY)
    out = model.transform(seen)
    assert out.columns == ["id", "industry_onehot"]
    vectors = column(out, "industry_onehot")
    assert [[names[i] for i in v.indices] for v in vectors] == [["industry_c7"]] + [["industry_Other"]] * 3
    assert all(v.size == 2501 for v in vectors)
    assert model.transform(many).count() == 6000


def test_onehot_vector_edges(spark):
    train = spark.createDataFrame([(1, "Other"), (2, "a.b"), (3, "a_b")], INDUSTRY)
    model = OneHotFrequent(minFrequency=1, output="vector").fit(train)
    assert model.slot_names() == ["industry_a.b", "industry_a_b", "industry_Other"]
    assert [v.indices[0] for v in column(model.transform(train), "industry_onehot")] == [2, 0, 1]
    assert model.transform(train.drop("INDUSTRY")).columns == ["id"]
    rare = OneHotFrequent(minFrequency=9, output="vector").fit(train)
    assert [v.toArray().tolist() for v in column(rare.transform(train), "industry_onehot")] == [[1.0]] * 3
    with pytest.raises(ValueError, match="Unknown output"):
        OneHotFrequent(output="matrix")


def test_mode_of_large_whole_numbers(spark):
    big = 2**53
    df = spark.createDataFrame([(big + 1,), (big + 1,), (big,), (big,), (big + 1,), (None,)], "n bigint")
    filled = ImputeMissing("mode").fit(df).transform(df)
    assert sorted(r["n"] for r in filled.collect()) == [big] * 2 + [big + 1] * 4


GAPS = "id bigint, x double, n bigint, s string, empty double"


def gaps(spark):
    return spark.createDataFrame(
        [(1, 1.0, 1, "b", None), (2, 2.0, 2, "a", None), (3, 3.0, None, "a", None), (4, 10.0, 2, "b", None), (5, None, None, None, None)],
        GAPS,
    )


@pytest.mark.parametrize(
    ("strategy", "x", "n", "s"),
    [("auto", 2.5, 2, "a"), ("mode", 1.0, 2, "a"), ("zero", 0.0, 0, "0"), ("constant", -1.0, -1, "-1")],
)
def test_impute(spark, strategy, x, n, s):
    df = gaps(spark)
    last = ImputeMissing(strategy, excludeCols=["id"]).fit(df).transform(df).where("id = 5").first()
    assert (last["x"], last["n"], last["s"]) == (x, n, s)
    if strategy in ("auto", "mode"):
        assert last["empty"] is None


def test_impute_numeric_strategies(spark):
    df = gaps(spark).drop("s")
    fills = ImputeMissing("mean", excludeCols=["id"]).fit(df).fills()
    assert fills == pytest.approx({"x": 4.0, "n": 5 / 3})
    fills = ImputeMissing("median", excludeCols=["id"]).fit(df).fills()
    assert fills == pytest.approx({"x": 2.5, "n": 2.0})
    with pytest.raises(ValueError, match="numeric columns"):
        ImputeMissing("mean", excludeCols=["id"]).fit(gaps(spark))
    with pytest.raises(ValueError, match="Unknown strategy"):
        ImputeMissing("best").fit(df)


def test_impute_fills_gaps_that_training_lacked(spark):
    train = spark.createDataFrame([(1, 4), (2, 5)], "id bigint, n bigint")
    model = ImputeMissing("median", excludeCols=["id"]).fit(train)
    out = model.transform(spark.createDataFrame([(3, None), (4, 7)], "id bigint, n bigint"))
    # The median lies between two whole numbers.
    assert column(out, "n") == [4.5, 7.0]


def test_impute_treats_nan_as_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0)], "id bigint, x double")
    assert column(ImputeMissing("mean", excludeCols=["id"]).fit(df).transform(df), "x") == [3.0, 3.0]


def test_impute_text_without_any_value(spark):
    df = spark.createDataFrame([(1, None)], "id bigint, s string")
    assert column(ImputeMissing("auto", excludeCols=["id"]).fit(df).transform(df), "s") == ["Unknown"]


def test_encode_categorical(spark, tmp_path):
    """Before and after saving."""
    schema = "id bigint, a string, b string"
    train = spark.createDataFrame([(1, "y", "k"), (2, "x", "k"), (3, None, "l"), (4, "x", "m")], schema)
    model = EncodeCategorical(excludeCols=["id"]).fit(train)
    test = spark.createDataFrame([(1, "x", "m"), (2, "y", "k"), (3, "z", None)], schema)
    expected = [(1, 0, 2), (2, 1, 0), (3, -1, -1)]
    assert sorted(map(tuple, model.transform(test).collect())) == expected
    PipelineModel(stages=[model]).write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    assert sorted(map(tuple, loaded.transform(test).collect())) == expected


def test_encode_without_text_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0)], "id bigint, x double")
    model = EncodeCategorical().fit(df)
    assert model.transform(df).collect() == df.collect()
    PipelineModel(stages=[model]).write().save(str(tmp_path / "m"))
    assert PipelineModel.load(str(tmp_path / "m")).transform(df).collect() == df.collect()


def numbers(spark):
    return spark.createDataFrame(
        [(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0), (4, 10.0, 5.0)], "id bigint, x double, c double"
    )


@pytest.mark.parametrize(
    ("method", "center", "spread"),
    [("standard", 4.0, np.std([1, 2, 3, 10])), ("minmax", 1.0, 9.0), ("robust", 2.5, 3.0)],
)
def test_scale(spark, method, center, spread):
    model = ScaleFeatures(method, ["x", "c"]).fit(numbers(spark))
    out = model.transform(numbers(spark))
    assert column(out, "x") == pytest.approx([(v - center) / spread for v in (1, 2, 3, 10)])
    assert column(out, "c") == [0.0] * 4
    # A constant of the training rows with another value later: its spread counts as 1.
    later = spark.createDataFrame([(1, 1.0, 7.5)], "id bigint, x double, c double")
    assert model.transform(later).first()["c"] == 2.5


def test_scale_leaves_columns_out(spark):
    df = numbers(spark)
    assert ScaleFeatures("none").fit(df).transform(df).collect() == df.collect()
    out = ScaleFeatures("standard", excludeCols=["id", "x"]).fit(df).transform(df)
    assert out.select("id", "x").collect() == df.select("id", "x").collect()
    with pytest.raises(ValueError, match="Unknown scaling method"):
        ScaleFeatures("log")


def companies(spark):
    rows = [
        (i, i % 2, float(i), ["1", "2 to 5", None][i % 3], ["a", "b", None][i % 3], "u" if i % 2 else "v", i * 2)
        for i in range(30)
    ]
    return spark.createDataFrame(
        rows,
        "id bigint, is_customer int, ALEXA_RANK double, EMPLOYEE_RANGE string, INDUSTRY string, region string, total bigint",
    )


def test_feature_stages_keep_their_columns(spark, tmp_path):
    df = companies(spark)
    config = TrainingConfig(exclude_columns=("total",), onehot="columns")
    fitted = Pipeline(stages=feature_stages(df, config)).fit(df)
    names = fitted.stages[-1].getInputCols()
    assert names == ["ALEXA_RANK", "region", "employee_range_ordinal", "industry_Other", "industry_a", "industry_b"]
    out = fitted.transform(df)
    # One-hot columns stay 0/1, encoded text is not scaled.
    assert {r["industry_a"] for r in out.collect()} == {0, 1}
    assert {r["region"] for r in out.collect()} == {0, 1}
    assert np.mean(column(out, "employee_range_ordinal")) == pytest.approx(0.0, abs=1e-9)
    # A table without some categories gives the same vector layout.
    few = fitted.transform(df.where("INDUSTRY = 'b'"))
    assert few.first()["features"].size == len(names)
    fitted.write().save(str(tmp_path / "features"))
    again = PipelineModel.load(str(tmp_path / "features")).transform(df)
    assert column(again, "features") == column(out, "features")


def test_assemble_reads_by_name(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "id bigint, b double, a double")
    model = AssembleFeatures(["id"]).fit(df)
    assert model.transform(df.select("a", "id", "b")).first()["features"].toArray().tolist() == [2.0, 3.0]


def encode_frame(spark):
    rows = [("b", "x y", None, "hot"), ("a", "", None, "hot"), (None, "x y", None, "hot"), ("b", "ü", None, None)]
    return spark.createDataFrame(rows, "`my col` string, `a.b` string, nothing string, h string").repartition(3)


@pytest.mark.parametrize("held", [0, stages.HELD_BYTES])
def test_categories_held_or_joined(spark, monkeypatch, tmp_path, held):
    monkeypatch.setattr(stages, "HELD_BYTES", held)
    df = encode_frame(spark)
    model = EncodeCategorical().fit(df)
    assert (model.labels is None) == (held == 0)
    other = spark.createDataFrame([("a", "ü", "z", "hot"), ("c", None, None, "cold")], df.schema)
    for data, expected in (
        (df, [(-1, 1, -1, 0), (0, 0, -1, 0), (1, 1, -1, 0), (1, 2, -1, -1)]),
        (other, [(-1, -1, -1, -1), (0, 2, -1, 0)]),
    ):
        encoded = model.transform(data)
        assert encoded.dtypes == [(c, "bigint") for c in df.columns]
        assert sorted(map(tuple, encoded.collect())) == expected
    model.write().overwrite().save(f"{tmp_path}/model")
    again = stages.EncodeCategoricalModel.load(f"{tmp_path}/model")
    assert sorted(map(tuple, again.transform(other).collect())) == [(-1, -1, -1, -1), (0, 2, -1, 0)]


@pytest.mark.parametrize("n", [2, 20])
def test_held_categories_move_no_rows_and_outlive_their_table(spark, tmp_path, n):
    df = spark.range(200).select(*[F.concat(F.lit("v"), F.col("id") % (i + 2)).alias(f"c{i}") for i in range(n)])
    scratch = materialize(df, "texts")
    with scratch_run(spark):
        model = EncodeCategorical().fit(scratch)
    encoded = model.transform(scratch)  # what the fit wrote is gone
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("FileScan") == 1
    assert encoded.agg(F.max("c0")).first()[0] == 1 and encoded.count() == 200
