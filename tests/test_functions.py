from datetime import datetime

import pytest
from pyspark.sql import functions as F

from prospectra.functions import (
    activity_frequency,
    completeness,
    confidence_band,
    confidence_score,
    days_between,
    in_set,
    inf_to_zero,
    nan_to_null,
    parse_timestamp,
    prefix_columns,
    range_ordinal,
    round4,
    safe_ratio,
)
from prospectra.schemas import EMPLOYEE_RANGES


def values(df, column):
    return [row[0] for row in df.select(column).collect()]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(5.0, 0.0), (0.0, 0.0), (6.0, 3.0), (None, 2.0)], "a double, b double")
    assert values(df, safe_ratio(F.col("a"), F.col("b"))) == [0.0, 0.0, 2.0, 0.0]


def test_days_between_counts_whole_periods(spark):
    df = spark.createDataFrame(
        [
            (datetime(2024, 1, 1, 23), datetime(2024, 1, 2, 1)),
            (datetime(2024, 1, 1, 12), datetime(2024, 1, 2, 12)),
            (datetime(2024, 1, 1, 12), datetime(2024, 1, 2, 11, 59, 59)),
        ],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert values(df, days_between(F.col("a"), F.col("b"))) == [0, 1, 0]


def test_activity_frequency_without_timestamp_is_zero(spark):
    df = spark.createDataFrame([(6, 2), (3, 0), (0, None)], "n bigint, days bigint")
    assert values(df, activity_frequency(F.col("n"), F.col("days"))) == [2.0, 3.0, 0.0]


def test_range_ordinal(spark):
    labels = [*EMPLOYEE_RANGES, "\t 26 to 50 \n", " 1", "300", "", None]
    df = spark.createDataFrame([(label,) for label in labels], "label string")
    assert values(df, range_ordinal(F.col("label"))) == [*range(1, 10), 5, 1, -1, -1, -1]


def test_confidence_band_borders(spark):
    df = spark.createDataFrame([(p,) for p in (0.29, 0.3, 0.39, 0.4, 0.5, 0.6, 0.61, 0.7, 0.71)], "p double")
    expected = ["high", "medium", "medium", "low", "low", "low", "medium", "medium", "high"]
    assert values(df, confidence_band(F.col("p"))) == expected
    assert values(df, confidence_score(F.col("p")))[:2] == pytest.approx([0.71, 0.7])


def test_round4_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0.03125,), (0.09375,), (0.75434,)], "p double")
    assert values(df, round4(F.col("p"))) == [0.0312, 0.0938, 0.7543]


def test_parse_timestamp(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), (None,), ("soon",)], "t string")
    good = datetime(2024, 1, 2, 3, 4, 5)
    assert values(df, parse_timestamp(F.col("t"), strict=False)) == [good, None, None]
    assert values(df.where("t IS NULL OR t <> 'soon'"), parse_timestamp(F.col("t"))) == [good, None]
    with pytest.raises(Exception, match="not a timestamp: soon"):
        values(df, parse_timestamp(F.col("t")))


def test_strict_parsing_does_not_need_ansi(spark):
    df = spark.createDataFrame([("soon",)], "t string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a timestamp"):
            values(df, parse_timestamp(F.col("t")))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_infinite_and_missing_numbers(spark):
    inf, nan = float("inf"), float("nan")
    df = spark.createDataFrame([(inf,), (-inf,), (1.5,)], "x double")
    assert values(df, inf_to_zero(F.col("x"))) == [0.0, 0.0, 1.5]
    df = spark.createDataFrame([(nan,), (None,), (2.0,)], "x double")
    assert values(df, nan_to_null(F.col("x"))) == [None, None, 2.0]


def test_in_set_leaves_null_out(spark):
    df = spark.createDataFrame([("1",), ("300",), (None,)], "label string")
    assert values(df, in_set(F.col("label"), EMPLOYEE_RANGES)) == [True, False, None]


def test_completeness_counts_filled_values(spark):
    df = spark.createDataFrame(
        [(1, "a", 2.0, True), (1, "", 0.0, False), (0, None, float("nan"), None)],
        "id bigint, s string, d double, b boolean",
    )
    assert values(df, completeness(df)) == [4, 1, 0]


def test_prefix_columns_are_numeric(spark):
    df = spark.createDataFrame([(1, "x", 2.0, 3)], "ACTIONS_A int, ACTIONS_B string, ACTIONS_C double, X int")
    assert prefix_columns(df, "ACTIONS_") == ["ACTIONS_A", "ACTIONS_C"]
