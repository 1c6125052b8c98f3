"""Column expressions. All of them are built from Spark functions, so they stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prospectra.schemas import EMPLOYEE_RANGES

# What Python's str.strip removes.
_WHITE_SPACE = "".join(char for char in map(chr, range(0x3001)) if char.isspace())


def named(name: str) -> Column:
    """The column with exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def strict_cast(text: Column, kind: str) -> Column:
    """Text to a type; text that is no such value fails the job, whatever the session's ANSI setting.

    Whole numbers may be written with a zero fraction, as tools do that hold gaps as floats.
    """
    digits = F.regexp_replace(text, r"\.0+$", "") if kind in ("int", "bigint") else text
    parsed = digits.try_cast(kind)
    names = {"timestamp_ntz": "timestamp", "bigint": "whole number", "double": "number"}
    problem = F.concat(F.lit(f"not a {names.get(kind, kind)}: "), text)
    failed = text.isNotNull() & parsed.isNull()
    return F.when(failed, F.raise_error(problem).cast(kind)).otherwise(parsed)


def parse_timestamp(text: Column, strict: bool = True) -> Column:
    """Text to timestamp without zone; text that is not one fails the job, or gives NULL if lenient."""
    return strict_cast(text, "timestamp_ntz") if strict else text.try_cast("timestamp_ntz")


def days_between(start: Column, end: Column) -> Column:
    """Whole 24-hour periods from start to a later end (23:00 to 01:00 next day is 0)."""
    return F.timestamp_diff("DAY", start, end)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives 0 where the quotient is undefined: x/0, 0/0 and NULL operands."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def activity_frequency(event_rows: Column, days_active: Column) -> Column:
    """Event rows per day of the active period, the first day included; 0 without a timestamp."""
    return F.coalesce(event_rows / (days_active + F.lit(1)), F.lit(0.0))


def null_to_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def inf_to_zero(value: Column) -> Column:
    return F.when(F.abs(value) == F.lit(float("inf")), F.lit(0.0)).otherwise(value)


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def range_ordinal(label: Column) -> Column:
    """Rank 1..9 of a company size label, surrounding white space ignored; -1 for anything else."""
    stripped = F.btrim(label, F.lit(_WHITE_SPACE))
    entries = [F.lit(item) for rank, name in enumerate(EMPLOYEE_RANGES, 1) for item in (name, rank)]
    return F.coalesce(F.try_element_at(F.create_map(*entries), stripped), F.lit(-1))


def in_set(value: Column, members: Iterable[str]) -> Column:
    """Membership as TRUE or FALSE; NULL stays NULL and is thus excluded by filters either way."""
    return value.isin(*members)


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Number of a row's values that are filled: not NULL or NaN, not empty text, not 0 or FALSE."""
    names = list(df.columns if columns is None else columns)
    return sum((_is_filled(df, name).cast("int") for name in names), F.lit(0))


def _is_filled(df: DataFrame, name: str) -> Column:
    value, kind = named(name), df.schema[name].dataType
    filled = value.isNotNull()
    if isinstance(kind, T.StringType):
        filled = filled & (value != F.lit(""))
    elif isinstance(kind, T.BooleanType):
        filled = filled & value
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        filled = filled & ~F.isnan(value) & (value != F.lit(0))
    elif isinstance(kind, T.NumericType):
        filled = filled & (value != F.lit(0))
    return filled


def numeric_columns(df: DataFrame) -> list[str]:
    return [field.name for field in df.schema if isinstance(field.dataType, T.NumericType)]


def prefix_columns(df: DataFrame, prefix: str) -> list[str]:
    """Numeric columns whose name starts with `prefix`."""
    return [name for name in numeric_columns(df) if name.startswith(prefix)]


def confidence_band(probability: Column) -> Column:
    """How far a probability is from even: below .3 or above .7 high, .4 and .6 medium, else low."""
    return (
        F.when((probability < 0.3) | (probability > 0.7), "high")
        .when((probability < 0.4) | (probability > 0.6), "medium")
        .otherwise("low")
    )


def confidence_score(probability: Column) -> Column:
    """Probability of the likelier class."""
    return F.greatest(probability, F.lit(1.0) - probability)


def round4(value: Column) -> Column:
    """Four places, half to even."""
    return F.bround(value, 4)
