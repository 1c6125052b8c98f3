"""Sources, sinks, filters, joins, aggregates, deduplication, ranking and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, rounded
from catalog.roles import STATS_SQL, role, sql
from prospectra.operators.cleaning import (
    add_target,
    category_frequency,
    filter_valid_mrr,
    invalid_sample,
    removed_by_mrr,
    select_features,
    target_distribution,
    union_companies,
)
from prospectra.operators.dedup import deduplicate, distinct_key_count, dup_groups, dup_sample
from prospectra.operators.quantiles import mode_value
from prospectra.operators.ranking import join_predictions, top_prospects
from prospectra.operators.requests import check_requests
from prospectra.operators.runs import all_metrics, metrics_table
from prospectra.operators.usage import (
    STAT_FEATURES,
    USAGE_FEATURES,
    id_difference,
    join_usage,
    lookback_filter,
    orphan_usage_ids,
    usage_features,
    usage_stats,
    usage_window,
)
from prospectra.plans.dataset import RawTables, prepare_dataset
from prospectra.sources import (
    CUSTOMERS,
    append_metrics,
    new_scratch_path,
    read_customers,
    write_predictions,
    write_quarantine,
    write_removed_rows,
)

_COMPANY = "id, CLOSEDATE, MRR, ALEXA_RANK, EMPLOYEE_RANGE, INDUSTRY"


def _rounded_sql(names: list[str], doubles: list[str]) -> str:
    return ", ".join(f"round({n}, 6) AS {n}" if n in doubles else n for n in names)


_STAT_DOUBLES = [n for n in STAT_FEATURES if n.endswith(("_mean", "_std"))]
_FEATURE_DOUBLES = [*_STAT_DOUBLES, "actions_per_user", "activity_frequency"]
_FEATURES_ROUNDED = _rounded_sql(USAGE_FEATURES, _FEATURE_DOUBLES)


def prepared(spark, d):
    """The prepared dataset; the tables are unique by id, which the deduplication confirms."""
    tables = RawTables(
        customers=role(spark, d, "customers").withColumn("_seq", F.col("id")),
        noncustomers=role(spark, d, "noncustomers").withColumn("_seq", F.col("id")),
        usage=role(spark, d, "usage"),
    )
    return prepare_dataset(tables)


def companies(spark, d):
    """Cleaned and labelled companies of both sources."""
    return union_companies(
        add_target(filter_valid_mrr(role(spark, d, "customers")), 1),
        add_target(role(spark, d, "noncustomers"), 0),
    )


# Whole flow -------------------------------------------------------------------------------------


@query(
    "prepare_dataset",
    sql(f"SELECT {_COMPANY}, is_customer, {_FEATURES_ROUNDED} FROM prepared", "prepared"),
)
def prepare_dataset_query(spark, d):
    return rounded(prepared(spark, d))


# Sources and sinks ------------------------------------------------------------------------------


@query("src_csv", sql(f"SELECT {_COMPANY} FROM customers", "customers"))
def src_csv(spark, d):
    path = new_scratch_path(spark, "customers-csv")
    write_removed_rows(role(spark, d, "customers"), path, "csv")
    return read_customers(spark, path).select(*CUSTOMERS.fieldNames())


@query(
    "sink_predictions",
    sql(
        "SELECT format, id, probability FROM prospects, "
        "(VALUES ('csv'), ('json'), ('parquet')) AS formats(format)",
        "prospects",
    ),
)
def sink_predictions(spark, d):
    predictions = role(spark, d, "prospects")
    written = None
    for name in ("csv", "json", "parquet"):
        path = new_scratch_path(spark, f"predictions-{name}")
        write_predictions(predictions, path, name)
        reader = spark.read.schema(predictions.schema).option("header", True)
        back = reader.format(name).load(path).withColumn("format", F.lit(name))
        written = back if written is None else written.unionByName(back)
    return written


@query(
    "sink_dup_quarantine",
    sql(
        "SELECT _duplicate_group, count(*) AS n, min(id) AS id, sum(MRR)::DECIMAL(18, 2)::DOUBLE AS mrr FROM ("
        "SELECT *, dense_rank() OVER (ORDER BY id) - 1 AS _duplicate_group FROM ("
        "SELECT *, count(*) OVER (PARTITION BY id) AS k FROM snapshots) WHERE k > 1) GROUP BY 1",
        "snapshots",
    ),
)
def sink_dup_quarantine(spark, d):
    path = new_scratch_path(spark, "quarantine")
    write_quarantine(dup_groups(role(spark, d, "snapshots"), ["id"]), path, ["id"], "_seq", "parquet")
    return (
        spark.read.parquet(path)
        .groupBy("_duplicate_group")
        .agg(
            F.count("*").alias("n"),
            F.min("id").alias("id"),
            F.round(F.sum("MRR"), 2).alias("mrr"),
        )
    )


@query("sink_removed_rows", sql(f"SELECT {_COMPANY} FROM customers WHERE MRR <= 0", "customers"))
def sink_removed_rows(spark, d):
    path = new_scratch_path(spark, "removed")
    write_removed_rows(removed_by_mrr(role(spark, d, "customers")), path)
    return read_customers(spark, path).select(*CUSTOMERS.fieldNames())


RUNS = {"run_a": ("2024-01-01 08:00:00", 0.3), "run_b": ("2024-01-02 08:00:00", 0.5), "run_c": ("2024-01-03 08:00:00", 0.7)}


def metrics_of_runs(spark, d):
    """A metrics table with one run per threshold, written run by run."""
    path = new_scratch_path(spark, "metrics")
    for run_id, (run_time, threshold) in RUNS.items():
        metrics = all_metrics(role(spark, d, "scored"), threshold)
        append_metrics(metrics_table(metrics, run_id, run_time), path)
    schema = "run_time timestamp_ntz, metric string, value double, run_id string"
    return spark.read.schema(schema).parquet(path)


AREAS_SQL = """areas AS (
    SELECT sum(neg * (tp - pos / 2)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc,
        sum(pos * (CAST(tp AS DOUBLE) / (tp + fp))) / sum(pos) AS average_precision FROM steps)"""

_RUN_MATRIX = " UNION ALL ".join(
    f"SELECT '{run}' AS run_id, TIMESTAMP '{when}' AS run_time, "
    f"CAST(count(*) FILTER (WHERE y_true = 1 AND y_proba >= {cut}) AS DOUBLE) AS tp, "
    f"CAST(count(*) FILTER (WHERE y_true = 0 AND y_proba >= {cut}) AS DOUBLE) AS fp, "
    f"CAST(count(*) FILTER (WHERE y_true = 1 AND y_proba < {cut}) AS DOUBLE) AS fn, "
    f"CAST(count(*) FILTER (WHERE y_true = 0 AND y_proba < {cut}) AS DOUBLE) AS tn FROM scored"
    for run, (when, cut) in RUNS.items()
)
RUNS_SQL = (
    f"{AREAS_SQL}, run_counts AS ({_RUN_MATRIX}), runs AS ("
    "SELECT run_id, run_time, (tp + tn) / (tp + fp + fn + tn) AS accuracy, "
    "COALESCE(tp / nullif(tp + fp, 0), 0) AS precision, COALESCE(tp / nullif(tp + fn, 0), 0) AS recall, "
    "COALESCE(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, roc_auc, average_precision "
    "FROM run_counts, areas)"
)
RUN_COLUMNS = ["accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"]


@query(
    "sink_metrics",
    sql(
        " UNION ALL ".join(
            f"SELECT run_id, run_time, '{c}' AS metric, round({c}, 6) AS value FROM runs"
            for c in RUN_COLUMNS
        ),
        "steps",
        extra=RUNS_SQL,
    ),
)
def sink_metrics(spark, d):
    return rounded(metrics_of_runs(spark, d))


# Projections and filters ------------------------------------------------------------------------


@query(
    "filter_valid_mrr",
    sql(f"SELECT {_COMPANY} FROM customers WHERE MRR > 0 OR MRR IS NULL", "customers"),
)
def filter_valid_mrr_query(spark, d):
    return filter_valid_mrr(role(spark, d, "customers"))


@query(
    "add_target",
    sql(
        "SELECT id, 1 AS is_customer FROM customers UNION ALL SELECT id, 0 FROM noncustomers",
        "customers",
        "noncustomers",
    ),
)
def add_target_query(spark, d):
    paying = add_target(role(spark, d, "customers"), 1).select("id", "is_customer")
    return paying.union(add_target(role(spark, d, "noncustomers"), 0).select("id", "is_customer"))


@query(
    "select_features",
    sql(f"SELECT ALEXA_RANK, EMPLOYEE_RANGE, {_FEATURES_ROUNDED} FROM prepared", "prepared"),
)
def select_features_query(spark, d):
    return rounded(select_features(prepared(spark, d), ["INDUSTRY", "not_there"]))


@query(
    "flatten_agg_names",
    sql(
        f"SELECT {_rounded_sql(STAT_FEATURES, _STAT_DOUBLES)} FROM (SELECT {STATS_SQL} FROM usage GROUP BY id)",
        "usage",
    ),
)
def flatten_agg_names(spark, d):
    return rounded(usage_stats(role(spark, d, "usage")).drop("id"))


@query(
    "lookback_filter",
    sql(
        "SELECT id, WHEN_TIMESTAMP FROM usage WHERE WHEN_TIMESTAMP >= "
        "(SELECT max(WHEN_TIMESTAMP) - INTERVAL 7 DAY FROM usage)",
        "usage",
    ),
)
def lookback_filter_query(spark, d):
    return lookback_filter(role(spark, d, "usage"), 7).select("id", "WHEN_TIMESTAMP")


_REQUEST_RULES_SQL = {
    "id_present": "id IS NOT NULL",
    "rank_positive": "ALEXA_RANK > 0",
    "range_known": "EMPLOYEE_RANGE IN ('1', '2 to 5', '6 to 10', '11 to 25', '26 to 50', '51 to 200', "
    "'201 to 1000', '1001 to 10000', '10,001 or more')",
    "industry_present": "INDUSTRY IS NOT NULL",
    "total_actions_nonneg": "total_actions >= 0",
    "total_users_nonneg": "total_users >= 0",
    "days_active_nonneg": "days_active >= 0",
    "activity_frequency_nonneg": "activity_frequency >= 0",
}
VALID_REQUEST_SQL = " AND ".join(f"COALESCE({r}, FALSE)" for r in _REQUEST_RULES_SQL.values())


FAILED_RULES_SQL = "concat_ws(',', {})".format(
    ", ".join(
        f"CASE WHEN NOT COALESCE({rule}, FALSE) THEN '{name}' END"
        for name, rule in _REQUEST_RULES_SQL.items()
    )
)


@query(
    "request_validate",
    sql(f"SELECT id, {FAILED_RULES_SQL} AS failed, {VALID_REQUEST_SQL} AS valid FROM requests", "requests"),
)
def request_validate(spark, d):
    checked = check_requests(role(spark, d, "requests"))
    return checked.select(
        "id",
        F.array_join("failed_rules", ",").alias("failed"),
        (F.size("failed_rules") == 0).alias("valid"),
    )


# Joins ------------------------------------------------------------------------------------------


@query(
    "join_usage_left",
    sql(f"SELECT id, is_customer, {_FEATURES_ROUNDED} FROM prepared", "prepared"),
)
def join_usage_left(spark, d):
    joined = join_usage(companies(spark, d), usage_features(role(spark, d, "usage")))
    return rounded(joined.select("id", "is_customer", *USAGE_FEATURES))


_ORPHANS_SQL = sql(
    "SELECT DISTINCT id FROM usage WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM companies)",
    "usage",
    "companies",
)


@query("join_orphan_anti", _ORPHANS_SQL)
def join_orphan_anti(spark, d):
    return orphan_usage_ids(role(spark, d, "usage"), companies(spark, d))


@query(
    "join_predictions_back",
    sql(
        "SELECT r.id, r.INDUSTRY, p.probability FROM requests r JOIN prospects p ON r.id = p.id",
        "requests",
        "prospects",
    ),
)
def join_predictions_back(spark, d):
    rows = role(spark, d, "requests").select("id", "INDUSTRY")
    return join_predictions(rows, role(spark, d, "prospects"))


# Aggregations -----------------------------------------------------------------------------------


@query(
    "agg_usage_stats",
    sql(f"SELECT id, {_rounded_sql(STAT_FEATURES, _STAT_DOUBLES)} FROM stats", "stats"),
)
def agg_usage_stats(spark, d):
    return rounded(usage_stats(role(spark, d, "usage")))


@query("agg_usage_derived", sql(f"SELECT id, {_FEATURES_ROUNDED} FROM features", "features"))
def agg_usage_derived(spark, d):
    return rounded(usage_features(role(spark, d, "usage")))


@query(
    "agg_usage_window",
    sql(
        "SELECT id, n AS WHEN_TIMESTAMP_count, first_ts AS WHEN_TIMESTAMP_min, "
        "last_ts AS WHEN_TIMESTAMP_max FROM stats",
        "stats",
    ),
)
def agg_usage_window(spark, d):
    return usage_window(role(spark, d, "usage"))


@query(
    "target_distribution",
    sql(
        "SELECT is_customer, count(*) AS n, "
        "round((SELECT avg(is_customer) FROM companies), 6) AS positive_share FROM companies GROUP BY 1",
        "companies",
    ),
)
def target_distribution_query(spark, d):
    return rounded(target_distribution(companies(spark, d)))


@query(
    "category_frequency",
    sql(
        "SELECT INDUSTRY AS category, count(*) AS n FROM companies "
        "WHERE INDUSTRY IS NOT NULL GROUP BY 1 HAVING count(*) >= 300",
        "companies",
    ),
)
def category_frequency_query(spark, d):
    return category_frequency(companies(spark, d), "INDUSTRY", 300)


@query(
    "distinct_key_count",
    sql(
        "SELECT count(*) AS duplicated_keys FROM "
        "(SELECT id FROM snapshots WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1)",
        "snapshots",
    ),
)
def distinct_key_count_query(spark, d):
    return distinct_key_count(role(spark, d, "snapshots"), ["id"])


@query(
    "mode_value",
    sql(
        "SELECT EMPLOYEE_RANGE AS mode FROM companies WHERE EMPLOYEE_RANGE IS NOT NULL "
        "GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1",
        "companies",
    ),
)
def mode_value_query(spark, d):
    return mode_value(companies(spark, d), "EMPLOYEE_RANGE")


# Deduplication ----------------------------------------------------------------------------------

_SNAPSHOT = "id, MRR, ALEXA_RANK, EMPLOYEE_RANGE, INDUSTRY, _seq"
_FILLED = " + ".join(
    f"CASE WHEN {c} IS NOT NULL AND {c} <> {empty} THEN 1 ELSE 0 END"
    for c, empty in [
        ("id", "0"),
        ("MRR", "0"),
        ("ALEXA_RANK", "0"),
        ("EMPLOYEE_RANGE", "''"),
        ("INDUSTRY", "''"),
    ]
)


def _dedup_sql(order: str) -> str:
    return sql(
        f"SELECT {_SNAPSHOT} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY {order}) AS k "
        "FROM snapshots) WHERE k = 1",
        "snapshots",
    )


@query("dedup_most_complete", _dedup_sql(f"{_FILLED} DESC, _seq"))
def dedup_most_complete(spark, d):
    return deduplicate(role(spark, d, "snapshots"), "id", "most_complete")


@query("dedup_first", _dedup_sql("_seq"))
def dedup_first(spark, d):
    return deduplicate(role(spark, d, "snapshots"), "id", "first")


@query("dedup_last", _dedup_sql("_seq DESC"))
def dedup_last(spark, d):
    return deduplicate(role(spark, d, "snapshots"), "id", "last")


_DUP_SQL = (
    "SELECT dense_rank() OVER (ORDER BY id, INDUSTRY) - 1 AS _duplicate_group, {columns} FROM "
    "(SELECT *, count(*) OVER (PARTITION BY id, INDUSTRY) AS k FROM snapshots) "
    "WHERE k > 1 AND INDUSTRY IS NOT NULL"
)


@query(
    "dup_groups",
    sql(
        f"{_DUP_SQL.format(columns=_SNAPSHOT)} UNION ALL "
        f"SELECT NULL, {_SNAPSHOT} FROM (SELECT *, count(*) OVER (PARTITION BY id) AS k "
        "FROM snapshots WHERE INDUSTRY IS NULL) WHERE k > 1",
        "snapshots",
    ),
)
def dup_groups_query(spark, d):
    return dup_groups(role(spark, d, "snapshots"), ["id", "INDUSTRY"])


@query(
    "dup_sample",
    sql(
        "SELECT id, dense_rank() OVER (ORDER BY id) - 1 AS _duplicate_group FROM "
        "(SELECT *, count(*) OVER (PARTITION BY id) AS k FROM snapshots) WHERE k > 1 "
        "ORDER BY id, _seq LIMIT 10",
        "snapshots",
    ),
)
def dup_sample_query(spark, d):
    return dup_sample(dup_groups(role(spark, d, "snapshots"), ["id"]), ["id"], "_seq")


# Ranking ----------------------------------------------------------------------------------------


@query(
    "top_prospects",
    sql("SELECT id, probability FROM prospects ORDER BY probability DESC, id LIMIT 100", "prospects"),
)
def top_prospects_query(spark, d):
    return top_prospects(role(spark, d, "prospects"), 100)


@query(
    "invalid_sample",
    sql("SELECT id, MRR FROM customers WHERE MRR <= 0 ORDER BY id, MRR LIMIT 5", "customers"),
)
def invalid_sample_query(spark, d):
    return invalid_sample(role(spark, d, "customers"))


# Set operations ---------------------------------------------------------------------------------


@query("union_companies", sql(f"SELECT {_COMPANY}, is_customer FROM companies", "companies"))
def union_companies_query(spark, d):
    return companies(spark, d)


@query("diff_ids", _ORPHANS_SQL)
def diff_ids(spark, d):
    return id_difference(role(spark, d, "usage"), companies(spark, d))
