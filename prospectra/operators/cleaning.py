"""Row filters, labels and column selection for company tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prospectra.functions import named

LABEL = "is_customer"
NON_FEATURES = ("id", LABEL, "CLOSEDATE", "MRR")


def _breaks_mrr_rule() -> Column:
    return F.coalesce(F.col("MRR") <= 0, F.lit(False))


def filter_valid_mrr(customers: DataFrame) -> DataFrame:
    """Customers that pay; an unknown (NULL) amount is kept."""
    return customers.where(~_breaks_mrr_rule())


def removed_by_mrr(customers: DataFrame) -> DataFrame:
    """The rows `filter_valid_mrr` drops."""
    return customers.where(_breaks_mrr_rule())


def invalid_sample(customers: DataFrame, n: int = 5) -> DataFrame:
    """The first `n` rows that break the MRR rule, by id, for inspection."""
    return removed_by_mrr(customers).select("id", "MRR").orderBy("id", "MRR").limit(n)


def add_target(companies: DataFrame, label: int) -> DataFrame:
    return companies.withColumn(LABEL, F.lit(label))


def union_companies(customers: DataFrame, noncustomers: DataFrame) -> DataFrame:
    """Both tables below each other, by column name; a column one of them lacks is NULL there."""
    return customers.unionByName(noncustomers, allowMissingColumns=True)


def select_features(companies: DataFrame, drop_columns: Sequence[str] = ()) -> DataFrame:
    """Only the model inputs: key, label and the columns known after conversion are dropped."""
    return companies.drop(*NON_FEATURES, *drop_columns)


def target_distribution(companies: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per label and the positive share of all rows."""
    counts = companies.groupBy(named(label).alias(label)).agg(F.count("*").alias("n"))
    share = counts.agg((F.sum(named(label) * F.col("n")) / F.sum("n")).alias("share"))
    return counts.withColumn("positive_share", share.scalar())


def category_frequency(df: DataFrame, column: str, min_frequency: int = 5) -> DataFrame:
    """Categories with at least `min_frequency` rows; NULL is not a category."""
    value = named(column)
    return (
        df.where(value.isNotNull())
        .groupBy(value.alias("category"))
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_frequency)
    )
