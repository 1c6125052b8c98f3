import datetime
import glob

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from prospectra.operators import profile
from prospectra.operators.profile import (
    profile_duplicate_rows,
    profile_missing,
    profile_numeric,
    profile_shape,
)
from prospectra.operators.quality import (
    action_rules,
    action_user_rules,
    check_rules,
    empty_columns,
    missing_features,
    orphan_violations,
    require_valid,
    schema_issues,
    share_within,
    timestamp_rules,
    top_rank_rules,
    unique_violations,
    validate,
)
from prospectra.plans.dataset import prepare_dataset, read_raw_tables
from prospectra.schemas import ACTION_COLUMNS, USER_COLUMNS
from prospectra.sources import (
    append_metrics,
    new_scratch_path,
    read_customers,
    read_usage,
    write_predictions,
    write_quarantine,
)


@pytest.fixture
def customers_csv(tmp_path):
    path = tmp_path / "customers.csv"
    path.write_text(
        "CLOSEDATE,MRR,EXTRA,EMPLOYEE_RANGE,INDUSTRY,id\n"
        '2019-06-20,290,x,201 to 1000,"Legal, Tax",1\n'
        '2019-03-22,392.54,y,"10,001 or more","",2\n'
        '2020-01-08,-61.15,"say ""hi""",,HIGHER_EDUCATION,3\n'
    )
    return str(path)


def test_csv_is_read_by_name(spark, customers_csv):
    rows = read_customers(spark, customers_csv, order_column="_seq").orderBy("id").collect()
    assert rows[0]["INDUSTRY"] == "Legal, Tax" and rows[0]["MRR"] == 290.0
    assert rows[0]["CLOSEDATE"] == datetime.date(2019, 6, 20)
    assert rows[1]["INDUSTRY"] is None and rows[1]["EMPLOYEE_RANGE"] == "10,001 or more"
    assert rows[2]["EXTRA"] == 'say "hi"' and rows[2]["EMPLOYEE_RANGE"] is None
    assert [r["id"] for r in sorted(rows, key=lambda r: r["_seq"])] == [1, 2, 3]
    assert "ALEXA_RANK" not in rows[0].asDict()


def test_csv_fails_early(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_usage(spark, str(tmp_path / "nothing.csv"))
    bad = tmp_path / "bad.csv"
    bad.write_text("id,MRR\n1,many\n")
    with pytest.raises(Exception, match="not a number: many"):
        read_customers(spark, str(bad)).collect()
    bad.write_text("id,MRR\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        read_customers(spark, str(bad)).collect()


def test_csv_markers_of_missing_values(spark, tmp_path):
    path = tmp_path / "gaps.csv"
    path.write_text("id,ALEXA_RANK,INDUSTRY\n1,309343.0,NA\n2,NaN,n/a\n3,,Nautics\n")
    rows = sorted(map(tuple, read_customers(spark, str(path)).collect()))
    assert rows == [(1, 309343, None), (2, None, None), (3, None, "Nautics")]


@pytest.mark.parametrize("format", ["csv", "json", "parquet"])
def test_predictions_round_trip(spark, tmp_path, format):
    df = spark.createDataFrame([(1, 1, 0.75), (2, 0, 0.25)], "id bigint, prediction int, probability double")
    write_predictions(df, str(tmp_path / "p"), format)
    back = spark.read.schema(df.schema).option("header", True).format(format).load(str(tmp_path / "p"))
    assert sorted(back.collect()) == sorted(df.collect())
    with pytest.raises(ValueError, match="Unsupported format: xml"):
        write_predictions(df, str(tmp_path / "q"), "xml")


def test_quarantine_is_sorted_over_its_files(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 10).alias("key"), F.col("id").alias("_seq"))
    write_quarantine(df.repartition(5), str(tmp_path / "q"), ["key"], "_seq", "csv")
    lines = []
    for name in sorted(glob.glob(str(tmp_path / "q" / "part-*"))):
        with open(name) as part:
            lines += [tuple(map(int, line.split(","))) for line in part.read().splitlines()[1:]]
    assert len(lines) == 1000 and lines == sorted(lines)


def test_metrics_of_a_run_are_replaced(spark, tmp_path):
    def run(name, value):
        return spark.createDataFrame([(name, "f1", value)], "run_id string, metric string, value double")

    path = str(tmp_path / "m")
    for name, value in (("a", 0.1), ("b", 0.2), ("a", 0.3)):
        append_metrics(run(name, value), path)
    found = {r["run_id"]: r["value"] for r in spark.read.parquet(path).collect()}
    assert found == {"a": 0.3, "b": 0.2}


def test_from_csv_files_to_features(spark, tmp_path, customers_csv):
    (tmp_path / "prospects.csv").write_text(
        "id,INDUSTRY,ALEXA_RANK,EMPLOYEE_RANGE\n8,,7,1\n8,Legal,7,1\n9,,NaN,2 to 5\n"
    )
    measures = ",".join(ACTION_COLUMNS + USER_COLUMNS)
    (tmp_path / "usage.csv").write_text(
        f"id,WHEN_TIMESTAMP,{measures}\n"
        "8,2024-01-01 23:00:00,3,0,0,1,1,0,0,1\n"
        "8,2024-01-03 01:00:00,5,0,0,0,1,0,0,0\n"
    )
    paths = [customers_csv, str(tmp_path / "prospects.csv"), str(tmp_path / "usage.csv")]
    dataset = prepare_dataset(read_raw_tables(spark, *paths), check=True)
    found = {r["id"]: r for r in dataset.collect()}
    # Customer 3 pays nothing; of the two rows of prospect 8 the fuller one stays.
    assert sorted(found) == [1, 2, 8, 9]
    assert found[8]["INDUSTRY"] == "Legal" and found[8]["total_actions"] == 9
    assert found[8]["actions_per_user"] == 3.0 and found[8]["days_active"] == 1
    assert found[9]["total_actions"] == 0 and found[9]["ALEXA_RANK"] is None
    assert found[1]["is_customer"] == 1 and found[1]["EXTRA"] == "x"


def test_scratch_uses_the_shared_folder(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    path = new_scratch_path(spark, "x")
    if before:
        assert path.startswith(before)
    assert path != new_scratch_path(spark, "x")


# Quality ----------------------------------------------------------------------------------------


def report(df):
    return {(r["rule"], r["column"]): (r["severity"], r["n_violations"], r["pct"]) for r in df.collect()}


def test_validate_customers(spark):
    df = spark.createDataFrame(
        [(1, 0.0, -5, "300", None, "z"), (1, None, None, None, None, "z"), (2, 5.0, 7, "1", None, None), (3, 1.0, 9, "1", None, "z")],
        "id bigint, MRR double, ALEXA_RANK bigint, EMPLOYEE_RANGE string, INDUSTRY string, NOTE string",
    )
    assert report(validate(df, "customers")) == {
        ("missing_column", "CLOSEDATE"): ("error", 0, 0.0),
        ("unexpected_column", "NOTE"): ("warning", 0, 0.0),
        ("unique", "id"): ("error", 1, 25.0),
        ("mrr_positive", "MRR"): ("warning", 1, 25.0),
        ("rank_positive", "ALEXA_RANK"): ("warning", 1, 25.0),
        ("range_domain", "EMPLOYEE_RANGE"): ("warning", 1, pytest.approx(100 / 3)),
        ("empty_column", "INDUSTRY"): ("warning", 4, 100.0),
    }
    with pytest.raises(ValueError, match="customers validation failed"):
        require_valid(df, "customers")
    with pytest.raises(ValueError, match="Unknown schema: leads"):
        validate(df, "leads")


def test_soft_keys_only_warn(spark):
    twice = spark.createDataFrame([(1,), (1,)], "id bigint")
    assert report(require_valid(twice, "noncustomers")) == {("unique", "id"): ("warning", 1, 50.0)}
    usage = spark.createDataFrame([("1", "2024-01-01")], "id string, WHEN_TIMESTAMP string")
    assert schema_issues(usage, "usage_actions") == [("type_mismatch", "warning", "id")]


def test_null_keys_count_as_equal(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "id bigint")
    assert report(unique_violations(df, ["id"], "error")) == {("unique", "id"): ("error", 1, pytest.approx(100 / 3))}


def test_usage_rules(spark):
    df = spark.createDataFrame(
        [(-1, 0, "2024-01-01"), (2, 3, "soon"), (None, 3, None), (3, 3, "2024-01-01 10:00:00")],
        "ACTIONS_EMAIL bigint, USERS_EMAIL bigint, WHEN_TIMESTAMP string",
    )
    assert report(check_rules(df, action_rules(df)))[("actions_nonneg", "ACTIONS_EMAIL")][1] == 1
    assert report(check_rules(df, action_user_rules(df)))[("actions_ge_users", "EMAIL")][1] == 2
    bad = check_rules(df, timestamp_rules(df))
    assert report(bad)[("ts_parseable", "WHEN_TIMESTAMP")][1:] == (2, 50.0)
    assert [r["passed"] for r in share_within(bad, 0.1).collect()] == [False]


def test_top_ranks_and_orphans(spark):
    df = spark.createDataFrame([(99,), (100,), (None,), (5000,)], "ALEXA_RANK bigint")
    assert report(check_rules(df, top_rank_rules(df)))[("top_rank_share", "ALEXA_RANK")][2] == pytest.approx(100 / 3)
    usage = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id bigint")
    companies = spark.createDataFrame([(1,), (1,), (None,)], "id bigint")
    assert report(orphan_violations(usage, companies)) == {("orphan_usage", "id"): ("error", 1, 50.0)}


def test_reports_of_an_empty_table(spark):
    df = spark.createDataFrame([], "ALEXA_RANK bigint")
    assert report(check_rules(df, top_rank_rules(df))) == {("top_rank_share", "ALEXA_RANK"): ("warning", 0, 0.0)}
    assert tuple(profile_duplicate_rows(df).first()) == (0, 0.0)
    assert empty_columns(df).count() == 0


def test_missing_features(spark):
    df = spark.createDataFrame([(1,)], "total_actions bigint")
    assert "total_users" in missing_features(df) and "total_actions" not in missing_features(df)


def test_profile(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "a"), (1, 1.0, "a"), (2, float("nan"), None), (3, 4.0, "b")], "n bigint, x double, s string"
    )
    assert [tuple(r) for r in profile_shape(df).orderBy("position").collect()] == [
        (4, 3, 0, "n", "bigint"),
        (4, 3, 1, "x", "double"),
        (4, 3, 2, "s", "string"),
    ]
    assert tuple(profile_duplicate_rows(df).first()) == (1, 25.0)
    assert {tuple(r) for r in profile_missing(df).collect()} == {("x", 1, 25.0), ("s", 1, 25.0)}
    summary = {r["column"]: r for r in profile_numeric(df).collect()}
    pdf = df.toPandas()[["n", "x"]].describe()
    for name in ("n", "x"):
        row = summary[name]
        found = [row[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        assert found == pytest.approx(pdf[name].tolist())
    rough = profile_numeric(df, accuracy=100).where("column = 'n'").first()
    assert rough["p50"] in (1.0, 2.0)


def test_duplicate_rows_tell_nulls_and_equal_fingerprints_apart(spark, monkeypatch):
    rows = [(None, 5, "x"), (5, None, "x"), (None, 5, "x"), (None, None, None), (None, None, None), (0, 5, ""), (0, 5, None)]
    df = spark.createDataFrame(rows, "a int, `my col` int, s string").repartition(3)
    assert tuple(profile_duplicate_rows(df).first()) == (2, pytest.approx(200 / 7))
    # rows whose fingerprints are equal by chance are compared as a whole
    monkeypatch.setattr(profile, "row_fingerprint", lambda df: [F.lit(1).cast("bigint"), F.lit(2).cast("bigint")])
    assert tuple(profile_duplicate_rows(df).first()) == (2, pytest.approx(200 / 7))
    assert tuple(profile_duplicate_rows(df.distinct()).first()) == (0, 0.0)
    wide = spark.range(3).select(*[F.when(F.col("id") != i % 3, 1).alias(f"c{i}") for i in range(70)])
    assert profile_duplicate_rows(wide.union(wide.limit(1))).first()["n_duplicate_rows"] == 1
    doubles = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),)], "x double")
    assert profile_duplicate_rows(doubles).first()["n_duplicate_rows"] == 2
