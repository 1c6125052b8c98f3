from prospectra.functions.scalars import (
    activity_frequency,
    completeness,
    confidence_band,
    confidence_score,
    days_between,
    in_set,
    inf_to_zero,
    named,
    nan_to_null,
    null_to_zero,
    numeric_columns,
    parse_timestamp,
    prefix_columns,
    range_ordinal,
    round4,
    safe_ratio,
    strict_cast,
)

__all__ = [
    "activity_frequency",
    "completeness",
    "confidence_band",
    "confidence_score",
    "days_between",
    "in_set",
    "inf_to_zero",
    "named",
    "nan_to_null",
    "null_to_zero",
    "numeric_columns",
    "parse_timestamp",
    "prefix_columns",
    "range_ordinal",
    "round4",
    "safe_ratio",
    "strict_cast",
]
