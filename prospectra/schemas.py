"""Table schemas and the fixed values that go with them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Company size labels, smallest first; their ordinals are 1..9.
EMPLOYEE_RANGES = [
    "1",
    "2 to 5",
    "6 to 10",
    "11 to 25",
    "26 to 50",
    "51 to 200",
    "201 to 1000",
    "1001 to 10000",
    "10,001 or more",
]

# The product objects that usage events count.
USAGE_OBJECTS = ["CRM_CONTACTS", "CRM_COMPANIES", "CRM_DEALS", "EMAIL"]

ACTION_COLUMNS = [f"ACTIONS_{name}" for name in USAGE_OBJECTS]
USER_COLUMNS = [f"USERS_{name}" for name in USAGE_OBJECTS]

CUSTOMERS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("CLOSEDATE", T.DateType()),
        T.StructField("MRR", T.DoubleType()),
        T.StructField("ALEXA_RANK", T.LongType()),
        T.StructField("EMPLOYEE_RANGE", T.StringType()),
        T.StructField("INDUSTRY", T.StringType()),
    ]
)

NONCUSTOMERS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ALEXA_RANK", T.LongType()),
        T.StructField("EMPLOYEE_RANGE", T.StringType()),
        T.StructField("INDUSTRY", T.StringType()),
    ]
)

# The timestamp is read as text: parsing it, strictly or leniently, is an operator of its own.
USAGE = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("WHEN_TIMESTAMP", T.StringType())]
    + [T.StructField(name, T.LongType()) for name in ACTION_COLUMNS + USER_COLUMNS]
)

REQUESTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("ALEXA_RANK", T.DoubleType()),
        T.StructField("EMPLOYEE_RANGE", T.StringType()),
        T.StructField("INDUSTRY", T.StringType()),
        T.StructField("total_actions", T.DoubleType()),
        T.StructField("total_users", T.DoubleType()),
        T.StructField("days_active", T.DoubleType()),
        T.StructField("activity_frequency", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """What a table must look like: columns, accepted types, unique keys."""

    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    types: tuple[tuple[str, tuple[str, ...]], ...] = ()
    hard_keys: tuple[tuple[str, ...], ...] = ()
    soft_keys: tuple[tuple[str, ...], ...] = ()


_COMPANY_OPTIONAL = ("ALEXA_RANK", "EMPLOYEE_RANGE", "INDUSTRY")
_ID_TYPES = ("id", ("int", "bigint"))

TABLE_SPECS = {
    "customers": TableSpec(
        required=("id", "CLOSEDATE", "MRR"),
        optional=_COMPANY_OPTIONAL,
        types=(
            _ID_TYPES,
            ("CLOSEDATE", ("string", "date", "timestamp", "timestamp_ntz")),
            ("MRR", ("double", "float", "bigint")),
        ),
        hard_keys=(("id",),),
    ),
    "noncustomers": TableSpec(
        required=("id",), optional=_COMPANY_OPTIONAL, types=(_ID_TYPES,), soft_keys=(("id",),)
    ),
    "usage_actions": TableSpec(
        required=("id", "WHEN_TIMESTAMP"),
        optional=tuple(ACTION_COLUMNS + USER_COLUMNS),
        types=(_ID_TYPES, ("WHEN_TIMESTAMP", ("string", "timestamp", "timestamp_ntz"))),
        soft_keys=(("id", "WHEN_TIMESTAMP"),),
    ),
}
