"""The test tables in the roles of company, usage, request and score tables.

A role is a list of expressions over one whole table, valid in Spark SQL and in ANSI SQL alike, so
that a query and its SQL start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prospectra.operators.usage import USAGE_FEATURES
from prospectra.schemas import EMPLOYEE_RANGES, USAGE_OBJECTS

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_EVENT_TYPES = dict(zip(USAGE_OBJECTS, ["view", "signup", "purchase", "click"]))


def _pick(index: str, values: list[str | None]) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {index} {cases} END"


_RANGES = [*EMPLOYEE_RANGES, "about 300", None]

_ROLES: dict[str, tuple[str, list[str]]] = {
    "customers": (
        "customer",
        [
            "c_custkey AS id",
            "DATE '2019-01-01' + CAST(c_custkey % 700 AS INT) AS CLOSEDATE",
            "CASE WHEN c_nationkey <> 7 THEN c_acctbal END AS MRR",
            "CASE WHEN c_nationkey <> 11 THEN c_custkey * 7919 % 1000000 - 2000 END AS ALEXA_RANK",
            f"{_pick('c_nationkey % 11', _RANGES)} AS EMPLOYEE_RANGE",
            "CASE WHEN c_nationkey <> 3 THEN c_mktsegment END AS INDUSTRY",
        ],
    ),
    "noncustomers": (
        "part",
        [
            "-1 - p_partkey AS id",
            "CASE WHEN p_size <> 11 THEN p_partkey * 104729 % 1000000 - 1000 END AS ALEXA_RANK",
            f"{_pick('p_size % 11', _RANGES)} AS EMPLOYEE_RANGE",
            f"{_pick('p_size % 7', [*SEGMENTS, 'Other', None])} AS INDUSTRY",
        ],
    ),
    # Even events belong to customers, odd ones to noncustomers; errors carry no measure.
    "usage": (
        "events",
        [
            "CASE WHEN event_id % 2 = 0 THEN user_id ELSE -1 - user_id END AS id",
            "ts AS WHEN_TIMESTAMP",
            *[
                f"CASE WHEN event_type = '{kind}' THEN CAST(floor(value) AS BIGINT) END AS ACTIONS_{name}"
                for name, kind in _EVENT_TYPES.items()
            ],
            *[
                f"CASE WHEN event_type = '{kind}' THEN 1 + event_id % 7 END AS USERS_{name}"
                for name, kind in _EVENT_TYPES.items()
            ],
        ],
    ),
    # About ten rows per id, filled to different degrees.
    "snapshots": (
        "orders",
        [
            "o_custkey AS id",
            "CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS MRR",
            "CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS ALEXA_RANK",
            "CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE o_orderpriority END AS EMPLOYEE_RANGE",
            "CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END AS INDUSTRY",
            "o_orderkey AS _seq",
        ],
    ),
    "scored": (
        "lineitem",
        [
            "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y_true",
            "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 10007 + "
            "CASE WHEN l_returnflag = 'R' THEN 2500 ELSE 0 END AS DOUBLE) / CAST(12506 AS DOUBLE) AS y_proba",
        ],
    ),
    "prospects": (
        "orders",
        [
            "o_orderkey AS id",
            "CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 9973 AS DOUBLE) / CAST(9972 AS DOUBLE) AS probability",
        ],
    ),
    "requests": (
        "orders",
        [
            "o_orderkey AS id",
            "o_totalprice - CAST(20000 AS DOUBLE) AS ALEXA_RANK",
            f"{_pick('o_custkey % 11', _RANGES)} AS EMPLOYEE_RANGE",
            f"{_pick('o_orderkey % 7', [*SEGMENTS, 'Other', None])} AS INDUSTRY",
            "CAST(o_custkey % 50 - 1 AS DOUBLE) AS total_actions",
            "CAST(o_custkey % 20 AS DOUBLE) AS total_users",
            "CAST(o_orderkey % 90 AS DOUBLE) AS days_active",
            "CAST(o_orderkey % 13 - 1 AS DOUBLE) / CAST(4 AS DOUBLE) AS activity_frequency",
        ],
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def role(
    spark: SparkSession, sf_dir: str, name: str, source: DataFrame | None = None
) -> DataFrame:
    """The role's rows, from its table or from a stream of the same columns."""
    origin, expressions = _ROLES[name]
    rows = table(spark, sf_dir, origin) if source is None else source
    return rows.selectExpr(*expressions)


def _role_sql(name: str) -> str:
    source, expressions = _ROLES[name]
    return f"{name} AS (SELECT {', '.join(expressions)} FROM {source})"


# SQL over the roles ------------------------------------------------------------------------------

_AGGREGATES = {
    "sum": "COALESCE(CAST(sum({0}) AS BIGINT), 0)",
    "mean": "COALESCE(avg({0}), 0)",
    "max": "COALESCE(max({0}), 0)",
    "std": "COALESCE(stddev_samp({0}), 0)",
}

STATS_SQL = ", ".join(
    f"{_AGGREGATES[stat].format(column)} AS {column}_{stat}"
    for kind, stats in (("ACTIONS", ("sum", "mean", "max", "std")), ("USERS", ("sum", "mean", "max")))
    for column in (f"{kind}_{name}" for name in USAGE_OBJECTS)
    for stat in stats
)

_TOTAL_ACTIONS = " + ".join(f"ACTIONS_{name}_sum" for name in USAGE_OBJECTS)
_TOTAL_USERS = " + ".join(f"USERS_{name}_sum" for name in USAGE_OBJECTS)

_DERIVED: dict[str, str] = {
    "companies": """companies AS (
        SELECT id, CLOSEDATE, MRR, ALEXA_RANK, EMPLOYEE_RANGE, INDUSTRY, 1 AS is_customer
        FROM customers WHERE NOT COALESCE(MRR <= 0, FALSE)
        UNION ALL
        SELECT id, NULL, NULL, ALEXA_RANK, EMPLOYEE_RANGE, INDUSTRY, 0 FROM noncustomers)""",
    "stats": f"""stats AS (
        SELECT id, {STATS_SQL}, count(WHEN_TIMESTAMP) AS n,
            min(WHEN_TIMESTAMP) AS first_ts, max(WHEN_TIMESTAMP) AS last_ts
        FROM usage WHERE id IS NOT NULL GROUP BY id)""",
    "features": f"""features AS (
        SELECT * EXCLUDE (n, first_ts, last_ts),
            {_TOTAL_ACTIONS} AS total_actions,
            {_TOTAL_USERS} AS total_users,
            COALESCE(CAST({_TOTAL_ACTIONS} AS DOUBLE) / nullif({_TOTAL_USERS}, 0), 0) AS actions_per_user,
            COALESCE(datesub('day', first_ts, last_ts), 0) AS days_active,
            COALESCE(CAST(n AS DOUBLE) / (datesub('day', first_ts, last_ts) + 1), 0) AS activity_frequency
        FROM stats)""",
    "prepared": f"""prepared AS (
        SELECT c.*, {', '.join(f'COALESCE(f.{name}, 0) AS {name}' for name in USAGE_FEATURES)}
        FROM companies c LEFT JOIN features f ON c.id = f.id)""",
    "matrix": """matrix AS (
        SELECT y_true, CASE WHEN y_proba >= 0.5 THEN 1 ELSE 0 END AS y_pred FROM scored)""",
    "counts": """counts AS (
        SELECT count(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS tn,
            count(*) FILTER (WHERE y_true = 0 AND y_pred = 1) AS fp,
            count(*) FILTER (WHERE y_true = 1 AND y_pred = 0) AS fn,
            count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp FROM matrix)""",
    "steps": """steps AS (
        SELECT y_proba AS score, sum(y_true) AS pos, sum(1 - y_true) AS neg,
            sum(sum(y_true)) OVER (ORDER BY y_proba DESC) AS tp,
            sum(sum(1 - y_true)) OVER (ORDER BY y_proba DESC) AS fp
        FROM scored GROUP BY y_proba)""",
}

_NEEDS: dict[str, tuple[str, ...]] = {
    "companies": ("customers", "noncustomers"),
    "stats": ("usage",),
    "features": ("stats",),
    "prepared": ("companies", "features"),
    "matrix": ("scored",),
    "counts": ("matrix",),
    "steps": ("scored",),
}


def sql(select: str, *names: str, extra: str = "") -> str:
    """`select` below a WITH clause that defines the named roles and what they are made from.

    `extra` holds further common table expressions that build on them.
    """
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS.get(name, ()):
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = [_DERIVED[name] if name in _DERIVED else _role_sql(name) for name in order]
    if extra:
        parts.append(extra)
    return f"WITH {', '.join(parts)} {select}"
