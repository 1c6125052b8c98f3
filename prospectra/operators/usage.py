"""Usage events to one row of features per company."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prospectra.functions import activity_frequency, days_between, null_to_zero, safe_ratio
from prospectra.schemas import ACTION_COLUMNS, USER_COLUMNS

# Aggregates per kind of measure; names follow <column>_<statistic>.
_STATISTICS = {"sum": F.sum, "mean": F.avg, "max": F.max, "std": F.stddev_samp}
_PLAN = [(name, stat) for name in ACTION_COLUMNS for stat in ("sum", "mean", "max", "std")] + [
    (name, stat) for name in USER_COLUMNS for stat in ("sum", "mean", "max")
]

STAT_FEATURES = [f"{name}_{stat}" for name, stat in _PLAN]
DERIVED_FEATURES = [
    "total_actions",
    "total_users",
    "actions_per_user",
    "days_active",
    "activity_frequency",
]
USAGE_FEATURES = STAT_FEATURES + DERIVED_FEATURES


def lookback_filter(usage: DataFrame, days: int) -> DataFrame:
    """Events within `days` days of the newest one.

    The cut is a scalar subquery over the timestamp column alone, so it reaches the Parquet scan as
    a pushed filter.
    """
    newest = F.max("WHEN_TIMESTAMP")
    cut = usage.agg((newest - F.make_dt_interval(F.lit(days))).alias("cut"))
    return usage.where(F.col("WHEN_TIMESTAMP") >= cut.scalar())


def _stat_columns() -> list[Column]:
    # A group without a single value, and the deviation of a single value, count as 0.
    return [
        null_to_zero(_STATISTICS[stat](name)).alias(f"{name}_{stat}") for name, stat in _PLAN
    ]


def _window_columns() -> list[Column]:
    ts = "WHEN_TIMESTAMP"
    return [
        F.count(ts).alias(f"{ts}_count"),
        F.min(ts).alias(f"{ts}_min"),
        F.max(ts).alias(f"{ts}_max"),
    ]


def _per_company(usage: DataFrame, columns: list[Column]) -> DataFrame:
    # Events without an id belong to no company. All aggregates have small partial states, so a
    # company with very many events is reduced on the map side before the shuffle.
    return usage.where(F.col("id").isNotNull()).groupBy("id").agg(*columns)


def usage_stats(usage: DataFrame) -> DataFrame:
    """Sum, mean, max and sample deviation of the actions, sum, mean and max of the users."""
    return _per_company(usage, _stat_columns())


def usage_window(usage: DataFrame) -> DataFrame:
    """Number of timestamps, first and last one."""
    return _per_company(usage, _window_columns())


def usage_features(usage: DataFrame, lookback_days: int | None = None) -> DataFrame:
    """All 33 usage features per company, from one pass and one shuffle.

    `lookback_days` limits the events to the newest ones; by default all count.
    """
    events = usage if lookback_days is None else lookback_filter(usage, lookback_days)
    first, last = F.col("WHEN_TIMESTAMP_min"), F.col("WHEN_TIMESTAMP_max")
    totals = _per_company(events, _stat_columns() + _window_columns()).withColumns(
        {
            "total_actions": reduce(add, [F.col(f"{c}_sum") for c in ACTION_COLUMNS]),
            "total_users": reduce(add, [F.col(f"{c}_sum") for c in USER_COLUMNS]),
            "_days": days_between(first, last),
        }
    )
    return totals.select(
        "id",
        *STAT_FEATURES,
        "total_actions",
        "total_users",
        safe_ratio(F.col("total_actions"), F.col("total_users")).alias("actions_per_user"),
        null_to_zero(F.col("_days")).alias("days_active"),
        activity_frequency(F.col("WHEN_TIMESTAMP_count"), F.col("_days")).alias("activity_frequency"),
    )


def join_usage(companies: DataFrame, features: DataFrame) -> DataFrame:
    """Companies with their usage; those without any get 0.

    `features` has one row per id, already aggregated, so the join moves no raw events.
    """
    joined = companies.join(features, "id", "left")
    return joined.fillna(0, [name for name in features.columns if name != "id"])


def orphan_usage_ids(usage: DataFrame, companies: DataFrame) -> DataFrame:
    """Ids with events but without a company."""
    ids = usage.select("id").where(F.col("id").isNotNull()).distinct()
    return ids.join(companies.select("id"), "id", "left_anti")


def id_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct ids of `left` that `right` lacks."""
    return left.select("id").subtract(right.select("id"))
