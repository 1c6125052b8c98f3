"""One row per key, and a report of the keys that had several.

The keepers are `min_by` / `max_by` aggregates over the whole row: each task first reduces its own
rows per key, so a key that holds a large part of the table is never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prospectra.functions import completeness, named
from prospectra.operators.prefix import dense_number
from prospectra.sources.scratch import materialize

STRATEGIES = ("most_complete", "first", "last")


def deduplicate(
    df: DataFrame,
    keys: str | Sequence[str] = "id",
    strategy: str = "most_complete",
    order_column: str = "_seq",
) -> DataFrame:
    """Keep one row per key: the most complete one (the earliest of equals), the first or the last.

    `order_column` stands for the input order and must be unique (see `scan_order`); it is not
    counted as a value. Rows with a NULL key form a key of their own.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown strategy: {strategy}; use one of {', '.join(STRATEGIES)}")
    key_names = [keys] if isinstance(keys, str) else list(keys)
    others = [c for c in df.columns if c not in key_names]
    row = F.struct(*[named(c) for c in others])
    order = named(order_column)
    if strategy == "first":
        kept = F.min_by(row, order)
    elif strategy == "last":
        kept = F.max_by(row, order)
    else:
        score = completeness(df, [c for c in df.columns if c != order_column])
        kept = F.min_by(row, F.struct((-score).alias("missing"), order.alias("order")))
    groups = [named(c) for c in key_names]
    best = df.groupBy(*groups).agg(kept.alias("_row"))
    fields = {c: F.col("_row").getField(c).alias(c) for c in others}
    return best.select(*[fields.get(c, named(c)) for c in df.columns])


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and their number of rows."""
    return (
        df.groupBy(*[named(k) for k in keys])
        .agg(F.count("*").alias("_n_rows"))
        .where(F.col("_n_rows") > 1)
    )


def distinct_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys are duplicated, by the first key column; NULL is not counted."""
    first = named(keys[0])
    return duplicated_keys(df, keys).agg(F.count_distinct(first).alias("duplicated_keys"))


def dup_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of a duplicated key, led by `_duplicate_group`: 0, 1, 2, ... in key order.

    A key with a NULL part is reported without a number. The numbered keys are written to scratch,
    so that Spark knows how many they are when it plans their join with the rows: few are broadcast,
    many are joined by shuffle, where adaptive execution splits a key that holds very many rows.
    """
    names = list(keys)
    numbered = dense_number(duplicated_keys(df, names).drop("_n_rows"), names, "_duplicate_group")
    as_key = {name: f"_key_{i}" for i, name in enumerate(names)}
    groups = materialize(numbered.withColumnsRenamed(as_key), "duplicated-keys")
    match = reduce(and_, [named(name).eqNullSafe(F.col(key)) for name, key in as_key.items()])
    return df.join(groups, match).select("_duplicate_group", *[named(c) for c in df.columns])


def dup_sample(groups: DataFrame, keys: Sequence[str], order_column: str, n: int = 10) -> DataFrame:
    """Keys and group numbers of the first `n` rows of `dup_groups`, for inspection."""
    return (
        groups.orderBy(*[named(k) for k in keys], named(order_column))
        .select(*[named(k) for k in keys], "_duplicate_group")
        .limit(n)
    )
