"""Data-quality rules and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.data_queries import companies, prepared
from catalog.registry import query, rounded
from catalog.roles import role, sql, table
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
    mrr_rules,
    orphan_violations,
    range_rules,
    rank_rules,
    share_within,
    timestamp_rules,
    top_rank_rules,
    unique_violations,
    validate,
)
from prospectra.schemas import EMPLOYEE_RANGES, USAGE_OBJECTS

_RANGES = ", ".join(f"'{name}'" for name in EMPLOYEE_RANGES)


def _rule_sql(source: str, rule: str, column: str, broken: str, base: str = "TRUE", severity: str = "warning") -> str:
    return (
        f"SELECT '{rule}' AS rule, '{severity}' AS severity, '{column}' AS \"column\", "
        f"count(*) FILTER (WHERE {broken}) AS n_violations, "
        f"round(COALESCE(count(*) FILTER (WHERE {broken}) * CAST(100 AS DOUBLE) / "
        f"nullif(count(*) FILTER (WHERE {base}), 0), 0), 6) AS pct FROM {source}"
    )


_MRR_SQL = _rule_sql("customers", "mrr_positive", "MRR", "MRR <= 0")
_RANK_SQL = _rule_sql("{0}", "rank_positive", "ALEXA_RANK", "ALEXA_RANK <= 0")
_RANGE_SQL = _rule_sql(
    "{0}",
    "range_domain",
    "EMPLOYEE_RANGE",
    f"EMPLOYEE_RANGE NOT IN ({_RANGES})",
    "EMPLOYEE_RANGE IS NOT NULL",
)


def _unique_sql(source: str, keys: str, severity: str) -> str:
    return (
        f"SELECT 'unique' AS rule, '{severity}' AS severity, '{keys}' AS \"column\", "
        "COALESCE(CAST(sum(n - 1) AS BIGINT), 0) AS n_violations, "
        "round(COALESCE(sum(n - 1) * CAST(100 AS DOUBLE) / nullif(sum(n), 0), 0), 6) AS pct "
        f"FROM (SELECT count(*) AS n FROM {source} GROUP BY {keys})"
    )


@query(
    "dq_schema",
    sql(
        "SELECT * FROM (SELECT 'unexpected_column' AS rule, 'warning' AS severity, 'SOURCE' AS \"column\", "
        "CAST(0 AS BIGINT) AS n_violations, CAST(0 AS DOUBLE) AS pct "
        "UNION ALL SELECT 'type_mismatch', 'warning', 'id', 0, 0 "
        f"UNION ALL {_unique_sql('customers', 'id', 'error')} UNION ALL {_MRR_SQL} "
        f"UNION ALL {_RANK_SQL.format('customers')} UNION ALL {_RANGE_SQL.format('customers')} "
        "UNION ALL SELECT 'empty_column', 'warning', 'SOURCE', count(*), 100 FROM customers) "
        "WHERE rule IN ('unexpected_column', 'type_mismatch') OR n_violations > 0",
        "customers",
    ),
)
def dq_schema(spark, d):
    customers = role(spark, d, "customers")
    odd = customers.withColumn("id", F.col("id").cast("string")).withColumn(
        "SOURCE", F.lit(None).cast("string")
    )
    return rounded(validate(odd, "customers"))


@query("dq_unique_hard", sql(_unique_sql("snapshots", "id", "error"), "snapshots"))
def dq_unique_hard(spark, d):
    return rounded(unique_violations(role(spark, d, "snapshots"), ["id"], "error"))


@query("dq_unique_soft", sql(_unique_sql("usage", "id,WHEN_TIMESTAMP", "warning"), "usage"))
def dq_unique_soft(spark, d):
    return rounded(unique_violations(role(spark, d, "usage"), ["id", "WHEN_TIMESTAMP"], "warning"))


@query(
    "dq_empty_columns",
    sql(
        "SELECT 'empty_column' AS rule, 'warning' AS severity, 'FAX' AS \"column\", "
        "count(*) AS n_violations, CAST(100 AS DOUBLE) AS pct FROM customers",
        "customers",
    ),
)
def dq_empty_columns(spark, d):
    no_fax = F.when(F.col("id") < 0, F.col("EMPLOYEE_RANGE"))
    return empty_columns(role(spark, d, "customers").withColumn("FAX", no_fax))


@query("dq_mrr_positive", sql(_MRR_SQL, "customers"))
def dq_mrr_positive(spark, d):
    customers = role(spark, d, "customers")
    return rounded(check_rules(customers, mrr_rules(customers)))


@query("dq_rank_positive", sql(_RANK_SQL.format("companies"), "companies"))
def dq_rank_positive(spark, d):
    rows = companies(spark, d)
    return rounded(check_rules(rows, rank_rules(rows)))


@query("dq_range_domain", sql(_RANGE_SQL.format("companies"), "companies"))
def dq_range_domain(spark, d):
    rows = companies(spark, d)
    return rounded(check_rules(rows, range_rules(rows)))


_BALANCES = "balances AS (SELECT c_acctbal AS ACTIONS_A, c_custkey AS ACTIONS_B FROM customer)"


@query(
    "dq_actions_nonneg",
    f"WITH {_BALANCES} "
    + " UNION ALL ".join(
        _rule_sql("balances", "actions_nonneg", c, f"{c} < 0") for c in ("ACTIONS_A", "ACTIONS_B")
    ),
)
def dq_actions_nonneg(spark, d):
    measures = table(spark, d, "customer").select(
        F.col("c_acctbal").alias("ACTIONS_A"), F.col("c_custkey").alias("ACTIONS_B")
    )
    return rounded(check_rules(measures, action_rules(measures)))


@query(
    "dq_top_rank_share",
    sql(
        "SELECT *, pct < 5 AS passed FROM ("
        + _rule_sql("companies", "top_rank_share", "ALEXA_RANK", "ALEXA_RANK < 100", "ALEXA_RANK IS NOT NULL")
        + ")",
        "companies",
    ),
)
def dq_top_rank_share(spark, d):
    rows = companies(spark, d)
    return rounded(share_within(check_rules(rows, top_rank_rules(rows)), 5.0))


@query(
    "dq_actions_ge_users",
    sql(
        " UNION ALL ".join(
            _rule_sql("usage", "actions_ge_users", c, f"ACTIONS_{c} < USERS_{c}") for c in USAGE_OBJECTS
        ),
        "usage",
    ),
)
def dq_actions_ge_users(spark, d):
    usage = role(spark, d, "usage")
    return rounded(check_rules(usage, action_user_rules(usage)))


@query(
    "dq_orphan_usage",
    sql(
        "SELECT 'orphan_usage' AS rule, 'error' AS severity, 'id' AS \"column\", "
        "count(*) FILTER (WHERE orphan) AS n_violations, "
        "round(count(*) FILTER (WHERE orphan) * CAST(100 AS DOUBLE) / count(*), 6) AS pct FROM "
        "(SELECT DISTINCT id, id NOT IN (SELECT id FROM companies) AS orphan FROM usage)",
        "usage",
        "companies",
    ),
)
def dq_orphan_usage(spark, d):
    return rounded(orphan_violations(role(spark, d, "usage"), companies(spark, d)))


_TEXT_TS = "CASE WHEN user_id = 1 THEN 'soon' ELSE CAST(ts AS {text}) END AS WHEN_TIMESTAMP"


@query(
    "dq_ts_parseable",
    f"WITH texts AS (SELECT {_TEXT_TS.format(text='VARCHAR')} FROM events) "
    "SELECT *, pct < 0.1 AS passed FROM ("
    + _rule_sql("texts", "ts_parseable", "WHEN_TIMESTAMP", "TRY_CAST(WHEN_TIMESTAMP AS TIMESTAMP) IS NULL")
    + ")",
)
def dq_ts_parseable(spark, d):
    texts = table(spark, d, "events").selectExpr(_TEXT_TS.format(text="STRING"))
    return rounded(share_within(check_rules(texts, timestamp_rules(texts)), 0.1))


@query("dq_no_dup_after", sql(_unique_sql("prepared", "id", "error"), "prepared"))
def dq_no_dup_after(spark, d):
    return rounded(unique_violations(prepared(spark, d), ["id"], "error"))


@query(
    "dq_features_present",
    sql("SELECT count(*) AS n_rows, 0 AS n_missing_features FROM prepared", "prepared"),
)
def dq_features_present(spark, d):
    dataset = prepared(spark, d)
    missing = missing_features(dataset)
    return dataset.agg(
        F.count("*").alias("n_rows"), F.lit(len(missing)).alias("n_missing_features")
    )


# Profiles ---------------------------------------------------------------------------------------

_CUSTOMER_TYPES = {
    "id": "bigint",
    "CLOSEDATE": "date",
    "MRR": "double",
    "ALEXA_RANK": "bigint",
    "EMPLOYEE_RANGE": "string",
    "INDUSTRY": "string",
}


@query(
    "profile_shape",
    sql(
        " UNION ALL ".join(
            f"SELECT count(*) AS n_rows, {len(_CUSTOMER_TYPES)} AS n_columns, {i} AS position, "
            f"'{name}' AS \"column\", '{kind}' AS type FROM customers"
            for i, (name, kind) in enumerate(_CUSTOMER_TYPES.items())
        ),
        "customers",
    ),
)
def profile_shape_query(spark, d):
    return profile_shape(role(spark, d, "customers"))


_LINEITEM = """l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax
    l_returnflag l_linestatus l_shipdate""".split()


@query(
    "profile_duplicate_rows",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicate_rows, "
    "round(sum(n - 1) * CAST(100 AS DOUBLE) / sum(n), 6) AS pct_duplicate_rows "
    f"FROM (SELECT count(*) AS n FROM lineitem GROUP BY {', '.join(_LINEITEM)})",
)
def profile_duplicate_rows_query(spark, d):
    rows = table(spark, d, "lineitem").select(*_LINEITEM)
    return rounded(profile_duplicate_rows(rows))


@query(
    "profile_missing",
    sql(
        "SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
            f"round(count(*) FILTER (WHERE {c} IS NULL) * CAST(100 AS DOUBLE) / count(*), 6) AS pct_missing "
            "FROM companies"
            for c in ("id", "CLOSEDATE", "MRR", "ALEXA_RANK", "EMPLOYEE_RANGE", "INDUSTRY", "is_customer")
        )
        + ") WHERE n_missing > 0",
        "companies",
    ),
)
def profile_missing_query(spark, d):
    return rounded(profile_missing(companies(spark, d)))


_NUMERIC = _LINEITEM[:8]


@query(
    "profile_numeric",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min, "
        + ", ".join(
            f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75)
        )
        + f", round(CAST(max({c}) AS DOUBLE), 6) AS max FROM lineitem"
        for c in _NUMERIC
    ),
)
def profile_numeric_query(spark, d):
    return rounded(profile_numeric(table(spark, d, "lineitem").select(*_NUMERIC, "l_returnflag")))
