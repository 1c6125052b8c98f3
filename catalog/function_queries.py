"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, rounded
from catalog.roles import role, sql, table
from prospectra.functions import (
    activity_frequency,
    confidence_band,
    confidence_score,
    days_between,
    in_set,
    inf_to_zero,
    null_to_zero,
    parse_timestamp,
    prefix_columns,
    range_ordinal,
    round4,
    safe_ratio,
)
from prospectra.operators.usage import usage_window
from prospectra.schemas import EMPLOYEE_RANGES


@query("parse_ts_strict", "SELECT event_id, CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts FROM events")
def parse_ts_strict(spark, d):
    events = table(spark, d, "events").select("event_id", F.col("ts").cast("string").alias("text"))
    return events.select("event_id", parse_timestamp(F.col("text")).alias("ts"))


_MIXED_TS = "CASE WHEN event_type = 'error' THEN 'n/a ' || event_id ELSE CAST(ts AS {text}) END"


@query(
    "parse_ts_lenient",
    f"SELECT event_id, TRY_CAST({_MIXED_TS.format(text='VARCHAR')} AS TIMESTAMP) AS ts FROM events",
)
def parse_ts_lenient(spark, d):
    text = F.expr(_MIXED_TS.format(text="STRING"))
    return table(spark, d, "events").select(
        "event_id", parse_timestamp(text, strict=False).alias("ts")
    )


@query("days_between", sql("SELECT id, datesub('day', first_ts, last_ts) AS days FROM stats", "stats"))
def days_between_query(spark, d):
    window = usage_window(role(spark, d, "usage"))
    days = days_between(F.col("WHEN_TIMESTAMP_min"), F.col("WHEN_TIMESTAMP_max"))
    return window.select("id", days.alias("days"))


@query(
    "safe_ratio",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "COALESCE(l_quantity / nullif(l_discount, 0), 0) AS ratio FROM lineitem",
)
def safe_ratio_query(spark, d):
    ratio = safe_ratio(F.col("l_quantity"), F.col("l_discount"))
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ratio.alias("ratio")
    )


@query(
    "activity_frequency",
    sql(
        "SELECT id, round(COALESCE(CAST(n AS DOUBLE) / (datesub('day', first_ts, last_ts) + 1), 0), 6) "
        "AS activity_frequency FROM stats",
        "stats",
    ),
)
def activity_frequency_query(spark, d):
    window = usage_window(role(spark, d, "usage"))
    days = days_between(F.col("WHEN_TIMESTAMP_min"), F.col("WHEN_TIMESTAMP_max"))
    frequency = activity_frequency(F.col("WHEN_TIMESTAMP_count"), days)
    return rounded(window.select("id", frequency.alias("activity_frequency")))


@query(
    "null_to_zero",
    sql("SELECT id, WHEN_TIMESTAMP, COALESCE(ACTIONS_EMAIL, 0) AS actions FROM usage", "usage"),
)
def null_to_zero_query(spark, d):
    return role(spark, d, "usage").select(
        "id", "WHEN_TIMESTAMP", null_to_zero(F.col("ACTIONS_EMAIL")).alias("actions")
    )


_INFINITE = (
    "CASE WHEN l_discount = 0 THEN CAST('infinity' AS DOUBLE) "
    "WHEN l_tax = 0 THEN CAST('-infinity' AS DOUBLE) ELSE l_quantity END"
)


@query(
    "inf_to_zero",
    "SELECT l_orderkey, l_partkey, l_suppkey, "
    "CASE WHEN l_discount = 0 OR l_tax = 0 THEN 0 ELSE l_quantity END AS value FROM lineitem",
)
def inf_to_zero_query(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", inf_to_zero(F.expr(_INFINITE)).alias("value")
    )


RANGE_CASE = (
    "CASE trim(EMPLOYEE_RANGE) "
    + " ".join(f"WHEN '{name}' THEN {rank}" for rank, name in enumerate(EMPLOYEE_RANGES, 1))
    + " ELSE -1 END"
)


@query("range_ordinal", sql(f"SELECT id, {RANGE_CASE} AS ordinal FROM customers", "customers"))
def range_ordinal_query(spark, d):
    padded = F.concat(F.lit(" \t"), F.col("EMPLOYEE_RANGE"), F.lit("\n "))
    return role(spark, d, "customers").select("id", range_ordinal(padded).alias("ordinal"))


_IN_SET = ", ".join(f"'{name}'" for name in EMPLOYEE_RANGES)


@query("in_set", sql(f"SELECT id, EMPLOYEE_RANGE IN ({_IN_SET}) AS known FROM customers", "customers"))
def in_set_query(spark, d):
    known = in_set(F.col("EMPLOYEE_RANGE"), EMPLOYEE_RANGES)
    return role(spark, d, "customers").select("id", known.alias("known"))


@query(
    "prefix_columns",
    sql(
        "SELECT ACTIONS_CRM_CONTACTS, ACTIONS_CRM_COMPANIES, ACTIONS_CRM_DEALS, ACTIONS_EMAIL FROM usage",
        "usage",
    ),
)
def prefix_columns_query(spark, d):
    # The text column below shares the prefix but is not numeric.
    usage = role(spark, d, "usage").withColumn("ACTIONS_NOTE", F.lit("none"))
    return usage.select(*prefix_columns(usage, "ACTIONS_"))


@query(
    "confidence_band",
    sql(
        "SELECT id, CASE WHEN probability < 0.3 OR probability > 0.7 THEN 'high' "
        "WHEN probability < 0.4 OR probability > 0.6 THEN 'medium' ELSE 'low' END AS confidence "
        "FROM prospects",
        "prospects",
    ),
)
def confidence_band_query(spark, d):
    return role(spark, d, "prospects").select(
        "id", confidence_band(F.col("probability")).alias("confidence")
    )


@query(
    "confidence_score",
    sql("SELECT id, greatest(probability, 1 - probability) AS confidence FROM prospects", "prospects"),
)
def confidence_score_query(spark, d):
    return role(spark, d, "prospects").select(
        "id", confidence_score(F.col("probability")).alias("confidence")
    )


# Thirty-seconds have up to five decimals and are exact in binary, so many of them are true ties.
@query(
    "round4",
    "SELECT o_orderkey, round_even(CAST(o_orderkey AS DOUBLE) / 32, 4) AS value FROM orders",
)
def round4_query(spark, d):
    value = F.col("o_orderkey").cast("double") / F.lit(32.0)
    return table(spark, d, "orders").select("o_orderkey", round4(value).alias("value"))
