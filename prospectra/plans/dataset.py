"""From three raw tables to one row of features and a label per company."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from prospectra.functions import parse_timestamp
from prospectra.operators.cleaning import (
    add_target,
    filter_valid_mrr,
    removed_by_mrr,
    union_companies,
)
from prospectra.operators.dedup import deduplicate, dup_groups
from prospectra.operators.profile import profile_missing, profile_numeric, profile_shape
from prospectra.operators.quality import require_valid
from prospectra.operators.usage import join_usage, usage_features
from prospectra.sources import (
    read_customers,
    read_noncustomers,
    read_usage,
    scratch_run,
    write_quarantine,
    write_removed_rows,
)


@dataclass(frozen=True)
class RawTables:
    """Inputs of a training run. `order_column` is the input order of the company tables."""

    customers: DataFrame
    noncustomers: DataFrame
    usage: DataFrame
    order_column: str = "_seq"


def read_raw_tables(
    spark: SparkSession,
    customers_path: str,
    noncustomers_path: str,
    usage_path: str,
    strict_timestamps: bool = True,
) -> RawTables:
    """The three CSV inputs; a usage timestamp that is none fails the job, or is NULL if not strict."""
    usage = read_usage(spark, usage_path)
    parsed = parse_timestamp(usage["WHEN_TIMESTAMP"], strict_timestamps)
    return RawTables(
        customers=read_customers(spark, customers_path, order_column="_seq"),
        noncustomers=read_noncustomers(spark, noncustomers_path, order_column="_seq"),
        usage=usage.withColumn("WHEN_TIMESTAMP", parsed),
    )


def prepare_dataset(
    tables: RawTables,
    strategy: str | None = "most_complete",
    lookback_days: int | None = None,
    check: bool = False,
    reports: str | None = None,
) -> DataFrame:
    """Deduplicate, clean, label and unite the companies, then add their usage features.

    Everything is one lazy plan. With `check`, the raw tables are validated first, which runs jobs
    and raises on a violated hard rule. With `reports`, `write_reports` fills that folder before the
    validation, so that what stopped a run can be read there. `strategy=None` skips the deduplication.
    """
    if reports is not None:
        write_reports(tables, reports, strategy)
    if check:
        order = tables.order_column
        require_valid(tables.customers.drop(order), "customers")
        require_valid(tables.noncustomers.drop(order), "noncustomers")
        require_valid(tables.usage, "usage_actions")

    customers = add_target(filter_valid_mrr(_unique(tables.customers, tables, strategy)), 1)
    noncustomers = add_target(_unique(tables.noncustomers, tables, strategy), 0)
    companies = union_companies(customers, noncustomers)
    return join_usage(companies, usage_features(tables.usage, lookback_days))


def write_reports(tables: RawTables, path: str, strategy: str | None = "most_complete") -> None:
    """What the preparation finds in the company tables, one folder per table below `path`.

    `profile_shape`, `profile_missing` and `profile_numeric` describe the raw table, `duplicates` has
    all rows of duplicated ids, `removed` (customers only) the unique rows that the MRR rule drops.
    """
    for name in ("customers", "noncustomers"):
        companies: DataFrame = getattr(tables, name)
        raw = companies.drop(tables.order_column)
        with scratch_run(companies.sparkSession):
            for profile in (profile_shape, profile_missing, profile_numeric):
                profile(raw).write.mode("overwrite").parquet(f"{path}/{name}/{profile.__name__}")
            write_quarantine(
                dup_groups(companies, ["id"]), f"{path}/{name}/duplicates", ["id"], tables.order_column, "parquet"
            )
    removed = removed_by_mrr(_unique(tables.customers, tables, strategy))
    write_removed_rows(removed, f"{path}/customers/removed", "parquet")


def _unique(companies: DataFrame, tables: RawTables, strategy: str | None) -> DataFrame:
    if strategy is None:
        return companies.drop(tables.order_column)
    return deduplicate(companies, "id", strategy, tables.order_column).drop(tables.order_column)
