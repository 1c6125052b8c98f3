from datetime import datetime

import pytest
from pyspark.sql import functions as F

from prospectra.operators.cleaning import (
    add_target,
    category_frequency,
    filter_valid_mrr,
    removed_by_mrr,
    select_features,
    target_distribution,
    union_companies,
)
from prospectra.operators.dedup import deduplicate, distinct_key_count, dup_groups
from prospectra.operators.quantiles import mode_value
from prospectra.operators.ranking import join_predictions, top_features, top_prospects
from prospectra.operators.requests import check_requests, rejected_requests, valid_requests
from prospectra.operators.usage import (
    USAGE_FEATURES,
    id_difference,
    join_usage,
    lookback_filter,
    orphan_usage_ids,
    usage_features,
)
from prospectra.plans.dataset import RawTables, prepare_dataset
from prospectra.schemas import ACTION_COLUMNS, REQUESTS, USER_COLUMNS

USAGE = "id bigint, WHEN_TIMESTAMP timestamp_ntz, " + ", ".join(
    f"{c} bigint" for c in ACTION_COLUMNS + USER_COLUMNS
)


def usage_row(id_, when, actions=None, users=None):
    return (id_, when, actions, None, None, None, users, None, None, None)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_mrr_rule_keeps_null(spark):
    df = spark.createDataFrame([(1, -1.0), (2, 0.0), (3, 0.01), (4, None)], "id bigint, MRR double")
    assert rows(filter_valid_mrr(df).select("id")) == [(3,), (4,)]
    assert rows(removed_by_mrr(df).select("id")) == [(1,), (2,)]


def test_union_fills_missing_columns(spark):
    a = add_target(spark.createDataFrame([(1, 5.0)], "id bigint, MRR double"), 1)
    b = add_target(spark.createDataFrame([("x", 2)], "INDUSTRY string, id bigint"), 0)
    both = union_companies(a, b)
    assert both.columns == ["id", "MRR", "is_customer", "INDUSTRY"]
    assert rows(both) == [(1, 5.0, 1, None), (2, None, 0, "x")]
    assert select_features(both, ["nothing"]).columns == ["INDUSTRY"]


def test_target_distribution(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (0,)], "is_customer int")
    assert rows(target_distribution(df)) == [(0, 1, 0.75), (1, 3, 0.75)]


def test_category_frequency_at_the_minimum(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 4 + [(None,)] * 9, "c string")
    assert rows(category_frequency(df, "c", 5)) == [("a", 5)]


def test_usage_features(spark):
    t = datetime(2024, 1, 1, 23)
    events = spark.createDataFrame(
        [
            usage_row(1, t, 4, 2),
            usage_row(1, datetime(2024, 1, 4, 1), 2, 0),
            usage_row(2, t, 5, 0),
            usage_row(3, None),
            usage_row(None, t, 9, 9),
        ],
        USAGE,
    )
    found = {r["id"]: r for r in usage_features(events).collect()}
    assert set(found) == {1, 2, 3}
    assert len(USAGE_FEATURES) == 33
    one = found[1]
    assert one["ACTIONS_CRM_CONTACTS_sum"] == 6 and one["ACTIONS_CRM_CONTACTS_mean"] == 3.0
    assert one["ACTIONS_CRM_CONTACTS_std"] == pytest.approx(2**0.5)
    assert one["actions_per_user"] == 3.0 and one["days_active"] == 2
    assert one["activity_frequency"] == pytest.approx(2 / 3)
    # One event has no deviation, no user gives no ratio.
    assert found[2]["ACTIONS_CRM_CONTACTS_std"] == 0.0 and found[2]["actions_per_user"] == 0.0
    assert found[2]["days_active"] == 0 and found[2]["activity_frequency"] == 1.0
    # Nothing but gaps: all features are 0.
    assert all(found[3][c] == 0 for c in USAGE_FEATURES)


def test_lookback_counts_from_the_newest_event(spark):
    events = spark.createDataFrame(
        [usage_row(i, datetime(2024, 1, i)) for i in (1, 8, 9, 15)], USAGE
    )
    assert rows(lookback_filter(events, 7).select("id")) == [(15,), (8,), (9,)]
    assert usage_features(events, lookback_days=7).count() == 3


def test_joins(spark):
    companies = spark.createDataFrame([(1,), (2,), (None,)], "id bigint")
    features = spark.createDataFrame([(1, 7), (3, 8)], "id bigint, total bigint")
    assert rows(join_usage(companies, features)) == [(1, 7), (2, 0), (None, 0)]
    events = spark.createDataFrame([(1,), (3,), (3,), (None,)], "id bigint")
    assert rows(orphan_usage_ids(events, companies)) == [(3,)]
    assert rows(id_difference(events, companies)) == [(3,)]
    predictions = spark.createDataFrame([(1, 0.5)], "id bigint, probability double")
    assert rows(join_predictions(companies, predictions)) == [(1, 0.5)]


SNAPSHOTS = "id bigint, a string, b bigint, _seq bigint"


def test_deduplicate(spark):
    df = spark.createDataFrame(
        [
            (1, "", 0, 0),  # neither empty text nor 0 counts
            (1, "x", None, 1),
            (2, "p", 1, 2),  # tie: the earlier row stays
            (2, "q", 2, 3),
            (None, None, 1, 4),  # NULL keys are one key
            (None, "r", 1, 5),
            (3, None, None, 6),
        ],
        SNAPSHOTS,
    )
    kept = lambda strategy: sorted(r["_seq"] for r in deduplicate(df, "id", strategy).collect())
    assert kept("most_complete") == [1, 2, 5, 6]
    assert kept("first") == [0, 2, 4, 6]
    assert kept("last") == [1, 3, 5, 6]
    assert deduplicate(df).columns == df.columns
    with pytest.raises(ValueError, match="Unknown strategy"):
        deduplicate(df, "id", "best")


def test_deduplicate_by_two_keys(spark):
    df = spark.createDataFrame([(1, "a", 1, 0), (1, "a", 2, 1), (1, "b", 3, 2)], SNAPSHOTS)
    assert sorted(r["_seq"] for r in deduplicate(df, ["id", "a"], "first").collect()) == [0, 2]


def test_dup_groups_number_keys_in_order(spark):
    df = spark.createDataFrame(
        [(5, "x", 1, 0), (3, "x", 1, 1), (5, "y", 1, 2), (3, "y", 1, 3), (9, "z", 1, 4), (None, "n", 1, 5), (None, "n", 1, 6)],
        SNAPSHOTS,
    )
    groups = dup_groups(df, ["id"])
    assert groups.columns[0] == "_duplicate_group"
    found = {r["_seq"]: r["_duplicate_group"] for r in groups.collect()}
    assert found == {1: 0, 3: 0, 0: 1, 2: 1, 5: None, 6: None}
    assert distinct_key_count(df, ["id"]).first()[0] == 2


def test_one_key_with_a_third_of_the_rows(spark):
    """Results stay whole when one key dominates."""
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("id"),
        F.lit("x").alias("a"),
        (F.col("id") % 5).alias("b"),
        F.col("id").alias("_seq"),
    )
    assert deduplicate(df).count() == 6001
    assert deduplicate(df, "id", "last").where("id = 0").first()["_seq"] == 8997
    assert dup_groups(df, ["id"]).count() == 3000


def test_mode_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert mode_value(df, "c").first()[0] == "a"
    assert mode_value(df.where("c IS NULL"), "c").first()[0] == "Unknown"


def test_top_prospects_breaks_ties_by_id(spark):
    df = spark.createDataFrame([(4, 0.5), (2, 0.5), (1, 0.9), (3, 0.5)], "id bigint, probability double")
    assert [r["id"] for r in top_prospects(df, 3).collect()] == [1, 2, 3]
    features = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 3.0)], "feature string, importance double")
    assert [r["feature"] for r in top_features(features, 2).collect()] == ["c", "a"]


def test_requests(spark):
    good = (1, 5.0, "26 to 50", "X", 0.0, 0.0, 0.0, 0.0)
    bad = (None, 0.0, "300", None, -1.0, None, 0.0, 0.0)
    df = spark.createDataFrame([good, bad], REQUESTS)
    assert [r["id"] for r in valid_requests(df).collect()] == [1]
    assert rejected_requests(df).first()["failed_rules"] == [
        "id_present",
        "rank_positive",
        "range_known",
        "industry_present",
        "total_actions_nonneg",
        "total_users_nonneg",
    ]
    assert check_requests(df).count() == 2


def raw_tables(spark, customers):
    return RawTables(
        customers=spark.createDataFrame(
            customers, "id bigint, CLOSEDATE string, MRR double, INDUSTRY string, _seq bigint"
        ),
        noncustomers=spark.createDataFrame(
            [(8, None, 0), (8, "x", 1), (9, "y", 2)], "id bigint, INDUSTRY string, _seq bigint"
        ),
        usage=spark.createDataFrame([usage_row(8, datetime(2024, 1, 1), 3, 1)], USAGE),
    )


def test_prepare_dataset(spark):
    tables = raw_tables(spark, [(1, "2020-01-01", 5.0, "a", 0), (2, "2020-01-01", 0.0, "b", 1)])
    found = {r["id"]: r for r in prepare_dataset(tables, check=True).collect()}
    assert set(found) == {1, 8, 9}
    assert found[1]["is_customer"] == 1 and found[1]["total_actions"] == 0
    assert found[8]["INDUSTRY"] == "x" and found[8]["total_actions"] == 3
    assert prepare_dataset(tables, strategy=None).count() == 4


def test_reports_of_the_preparation(spark, tmp_path):
    rows = [(1, "2020-01-01", 5.0, "a", 0), (2, "2020-01-01", 0.0, "b", 1), (1, None, 6.0, "a", 2)]
    tables, path = raw_tables(spark, rows), str(tmp_path / "reports")
    with pytest.raises(ValueError, match="unique id: 1"):
        prepare_dataset(tables, check=True, reports=path)
    read = lambda name: spark.read.parquet(f"{path}/{name}").collect()
    assert sorted((r["id"], r["MRR"]) for r in read("customers/duplicates")) == [(1, 5.0), (1, 6.0)]
    assert [r["id"] for r in read("customers/removed")] == [2]
    assert [(r["column"], r["n_missing"]) for r in read("customers/profile_missing")] == [("CLOSEDATE", 1)]
    assert {r["column"]: r["p50"] for r in read("customers/profile_numeric")}["MRR"] == 5.0
    assert {r["n_rows"] for r in read("noncustomers/profile_shape")} == {3}
    assert [r["_duplicate_group"] for r in read("noncustomers/duplicates")] == [0, 0]


def test_prepare_dataset_rejects_duplicate_customers(spark):
    tables = raw_tables(spark, [(1, "2020-01-01", 5.0, "a", 0), (1, "2020-01-01", 6.0, "b", 1)])
    with pytest.raises(ValueError, match="unique id: 1"):
        prepare_dataset(tables, check=True)
    assert prepare_dataset(tables).where("id = 1").count() == 1
