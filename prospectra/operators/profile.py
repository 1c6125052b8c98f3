"""Data profile of a table: shape, duplicate rows, missing values, numeric summary."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prospectra.functions import named, numeric_columns
from prospectra.operators.quantiles import column_quantiles
from prospectra.sources.scratch import materialize

_QUARTILES = (0.25, 0.5, 0.75)


def profile_shape(df: DataFrame) -> DataFrame:
    """One row per column with its type, and the shape of the table beside it."""
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
            )
            for i, field in enumerate(df.schema)
        ]
    )
    rows = df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))
    return rows.select("n_rows", "n_columns", F.inline(columns))


def row_fingerprint(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a whole row that differ in what is hashed first; NULLs count by their place."""
    columns = [named(c) for c in df.columns]
    # hashing passes over a NULL, so which columns are NULL is hashed beside the values
    missing = [
        reduce(add, [F.when(c.isNull(), 1 << i).otherwise(0) for i, c in enumerate(columns[k : k + 30])])
        for k in range(0, len(columns), 30)
    ]
    return [F.xxhash64(*missing, *columns), F.xxhash64(*columns, *missing)]


def profile_duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column: count and percent.

    Rows are counted by a fingerprint of 16 bytes, and that is all that is shuffled of them. Only the rows whose
    fingerprint repeats are read again and compared as a whole.
    """
    prints = ["_print_0", "_print_1"]
    marked = dict(zip(prints, row_fingerprint(df), strict=True))
    counted = df.select(*[mark.alias(name) for name, mark in marked.items()]).groupBy(*prints).agg(F.count("*").alias("n"))
    found = counted.agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("repeated")).first()
    n_rows = F.lit(found.rows or 0).cast("bigint")
    if not found.repeated:
        surplus = df.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("_n"))
    else:
        repeated = materialize(counted.where("n > 1").select(*prints), "repeated-fingerprints")
        again = df.withColumns(marked).join(repeated, prints, "left_semi")
        exact = again.groupBy(*[named(c) for c in df.columns]).agg(F.count("*").alias("_n"))
        surplus = exact.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("_n"))
    return surplus.select(
        F.col("_n").alias("n_duplicate_rows"),
        F.coalesce(F.try_divide(F.col("_n") * 100.0, n_rows), F.lit(0.0)).alias("pct_duplicate_rows"),
    )


def _missing(df: DataFrame, name: str):
    value = named(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def profile_missing(df: DataFrame) -> DataFrame:
    """Columns with missing values: how many, and percent of the rows. One pass for all columns."""
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(_missing(df, c)).alias(f"_{i}") for i, c in enumerate(df.columns)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("n_missing"))
            for i, c in enumerate(df.columns)
        ]
    )
    return (
        counted.select("_rows", F.inline(rows))
        .where(F.col("n_missing") > 0)
        .select(
            "column", "n_missing", (F.col("n_missing") * 100.0 / F.col("_rows")).alias("pct_missing")
        )
    )


def profile_numeric(df: DataFrame, accuracy: int | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max of every numeric column, missing values left out.

    Quartiles are exact unless an `accuracy` asks for the one-pass sketch (see `column_quantiles`).
    """
    names = numeric_columns(df)
    values = [F.nanvl(named(c).cast("double"), F.lit(None).cast("double")) for c in names]
    statistics = {
        "count": F.count,
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    wide = df.agg(
        *[f(v).alias(f"{s}_{i}") for i, v in enumerate(values) for s, f in statistics.items()]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), *[F.col(f"{s}_{i}").alias(s) for s in statistics])
            for i, c in enumerate(names)
        ]
    )
    quartiles = column_quantiles(df, names, _QUARTILES, accuracy)
    summary = wide.select(F.inline(rows))
    # Both sides have one row per column of the table.
    return summary.join(F.broadcast(quartiles), "column", "left").select(
        "column",
        "count",
        "mean",
        "std",
        "min",
        *[F.col("quantiles")[i].alias(f"p{int(p * 100)}") for i, p in enumerate(_QUARTILES)],
        "max",
    )
