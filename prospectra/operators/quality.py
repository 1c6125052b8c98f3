"""Data-quality rules.

Row rules are declared as `Rule` objects and all rules of a table run in a single aggregation; only
uniqueness and key references need a shuffle of their own. Every report has the columns
(rule, severity, column, n_violations, pct).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prospectra.functions import in_set, named, numeric_columns, parse_timestamp, prefix_columns
from prospectra.schemas import (
    ACTION_COLUMNS,
    EMPLOYEE_RANGES,
    TABLE_SPECS,
    USAGE_OBJECTS,
    TableSpec,
)

REPORT = "rule string, severity string, column string, n_violations bigint, pct double"


@dataclass(frozen=True)
class Rule:
    """Rows where `broken` is TRUE violate the rule; `base` says which rows the percent is of."""

    name: str
    column: str
    broken: Column
    base: Column | None = None
    severity: str = "warning"


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Violations of all rules, counted in one pass."""
    counts: list[Column] = []
    for i, rule in enumerate(rules):
        base = F.count("*") if rule.base is None else F.count_if(rule.base)
        counts += [F.count_if(rule.broken).alias(f"n_{i}"), base.alias(f"base_{i}")]
    rows = F.array(
        *[
            F.struct(
                F.lit(rule.name).alias("rule"),
                F.lit(rule.severity).alias("severity"),
                F.lit(rule.column).alias("column"),
                F.col(f"n_{i}").alias("n_violations"),
                F.coalesce(
                    F.try_divide(F.col(f"n_{i}") * 100.0, F.col(f"base_{i}")), F.lit(0.0)
                ).alias("pct"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return df.agg(*counts).select(F.inline(rows))


def mrr_rules(df: DataFrame) -> list[Rule]:
    return [Rule("mrr_positive", "MRR", F.col("MRR") <= 0)] if "MRR" in df.columns else []


def rank_rules(df: DataFrame) -> list[Rule]:
    if "ALEXA_RANK" not in df.columns:
        return []
    return [Rule("rank_positive", "ALEXA_RANK", F.col("ALEXA_RANK") <= 0)]


def top_rank_rules(df: DataFrame, below: int = 100) -> list[Rule]:
    """Ranks under `below`, percent of the ranked rows; `share_within` turns it into a verdict."""
    rank = F.col("ALEXA_RANK")
    return [Rule("top_rank_share", "ALEXA_RANK", rank < below, rank.isNotNull())]


def range_rules(df: DataFrame) -> list[Rule]:
    if "EMPLOYEE_RANGE" not in df.columns:
        return []
    label = F.col("EMPLOYEE_RANGE")
    return [Rule("range_domain", "EMPLOYEE_RANGE", ~in_set(label, EMPLOYEE_RANGES), label.isNotNull())]


def action_rules(df: DataFrame) -> list[Rule]:
    return [Rule("actions_nonneg", c, named(c) < 0) for c in prefix_columns(df, "ACTIONS_")]


def action_user_rules(df: DataFrame) -> list[Rule]:
    """Every user acts at least once, so actions below users contradict each other."""
    numeric = set(numeric_columns(df))
    return [
        Rule("actions_ge_users", kind, named(f"ACTIONS_{kind}") < named(f"USERS_{kind}"))
        for kind in USAGE_OBJECTS
        if {f"ACTIONS_{kind}", f"USERS_{kind}"} <= numeric
    ]


def timestamp_rules(df: DataFrame, column: str = "WHEN_TIMESTAMP") -> list[Rule]:
    parsed = parse_timestamp(named(column).cast("string"), strict=False)
    return [Rule("ts_parseable", column, parsed.isNull())]


def empty_rules(df: DataFrame) -> list[Rule]:
    """Missing values per column; a column is empty where they make up all rows."""
    return [Rule("empty_column", c, named(c).isNull()) for c in df.columns]


def empty_columns(df: DataFrame) -> DataFrame:
    """Columns without a single value, from one pass."""
    return check_rules(df, empty_rules(df)).where(F.col("pct") == 100)


def unique_violations(df: DataFrame, keys: Sequence[str], severity: str) -> DataFrame:
    """Surplus rows of a key, NULL keys included; counted per key before any row is moved."""
    per_key = df.groupBy(*[named(k) for k in keys]).agg(F.count("*").alias("_n"))
    surplus = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))
    return per_key.agg(
        F.lit("unique").alias("rule"),
        F.lit(severity).alias("severity"),
        F.lit(",".join(keys)).alias("column"),
        surplus.alias("n_violations"),
        F.coalesce(F.try_divide(surplus * 100.0, F.sum("_n")), F.lit(0.0)).alias("pct"),
    )


def orphan_violations(usage: DataFrame, companies: DataFrame) -> DataFrame:
    """Usage ids that no company has, percent of the usage ids."""
    ids = usage.select("id").where(F.col("id").isNotNull()).distinct()
    known = companies.select("id").distinct().withColumn("known", F.lit(True))
    orphans = Rule("orphan_usage", "id", F.col("known").isNull(), severity="error")
    return check_rules(ids.join(known, "id", "left"), [orphans])


def share_within(report: DataFrame, limit_pct: float) -> DataFrame:
    """Add `passed`: the violating share is below the limit."""
    return report.withColumn("passed", F.col("pct") < limit_pct)


def schema_issues(df: DataFrame, table: str) -> list[tuple[str, str, str]]:
    """(rule, severity, column) from the schema alone; no job runs."""
    spec = _spec(table)
    types = {field.name: field.dataType.simpleString() for field in df.schema}
    issues = [("missing_column", "error", c) for c in spec.required if c not in types]
    known = {*spec.required, *spec.optional}
    issues += [("unexpected_column", "warning", c) for c in df.columns if c not in known]
    issues += [
        ("type_mismatch", "warning", c)
        for c, accepted in spec.types
        if c in types and types[c] not in accepted
    ]
    return issues


def missing_features(df: DataFrame) -> list[str]:
    """Names a prepared dataset must have and `df` lacks."""
    wanted = [f"{c}_{stat}" for c in ACTION_COLUMNS for stat in ("sum", "mean", "max")]
    wanted += ["total_actions", "total_users", "days_active"]
    wanted += ["ALEXA_RANK", "EMPLOYEE_RANGE", "INDUSTRY"]
    return [name for name in wanted if name not in df.columns]


def validate(df: DataFrame, table: str) -> DataFrame:
    """Full report of a table: schema, uniqueness, empty columns and value rules."""
    spec = _spec(table)
    report = df.sparkSession.createDataFrame(
        [(*issue, 0, 0.0) for issue in schema_issues(df, table)], REPORT
    )
    hard = [(keys, "error") for keys in spec.hard_keys]
    soft = [(keys, "warning") for keys in spec.soft_keys]
    for keys, severity in hard + soft:
        if set(keys) <= set(df.columns):
            report = report.unionByName(unique_violations(df, keys, severity))
    rules: list[Rule] = []
    if table == "customers":
        rules += mrr_rules(df)
    if table in ("customers", "noncustomers"):
        rules += rank_rules(df) + range_rules(df)
    if table == "usage_actions":
        rules += action_rules(df)
    report = report.unionByName(check_rules(df, rules + empty_rules(df)))
    from_schema = F.col("rule").isin("missing_column", "unexpected_column", "type_mismatch")
    empty = F.col("rule") == "empty_column"
    return report.where(
        from_schema | (empty & (F.col("pct") == 100)) | (~empty & (F.col("n_violations") > 0))
    )


def require_valid(df: DataFrame, table: str) -> DataFrame:
    """The report of `validate`; a violated hard rule raises."""
    report = validate(df, table)
    # At most one row per rule and column.
    errors = [r for r in report.collect() if r["severity"] == "error"]
    if errors:
        found = "; ".join(f"{r['rule']} {r['column']}: {r['n_violations']}" for r in errors)
        raise ValueError(f"{table} validation failed: {found}")
    return report


def _spec(table: str) -> TableSpec:
    if table not in TABLE_SPECS:
        raise ValueError(f"Unknown schema: {table}; use one of {', '.join(TABLE_SPECS)}")
    return TABLE_SPECS[table]
