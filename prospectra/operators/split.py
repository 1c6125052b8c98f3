"""Train / test splits and folds from a hash of the key: no randomness, no shuffle of the rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from prospectra.functions import named
from prospectra.operators.cleaning import LABEL

_HASH, _STEP = 32, 4  # hex digits of a hash, and those that one histogram counts by: 65,536 cells


def split_hash(key: Column, seed: int) -> Column:
    """32 hex digits, evenly spread; the same key (NULL is one) and seed give the same digits everywhere."""
    return F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("\0null")), F.lit(f":{seed}")))


def _cut(share: float) -> str:
    """The first 8 hex digits below which a `share` of all hashes lies."""
    return f"{min(int(share * 16**8), 16**8 - 1):08x}"


def split_by_hash(
    df: DataFrame, test_share: float = 0.2, seed: int = 42, key: str = "id"
) -> DataFrame:
    """Add `split`: test if the key's hash is under the cut. Needs no pass over the data.

    Every class keeps its proportion up to chance, which is little in a large table; see
    `split_stratified` for exact quotas.
    """
    test = F.substring(split_hash(named(key), seed), 1, 8) < _cut(test_share)
    if test_share >= 1:
        test = F.lit(True)
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def split_stratified(
    df: DataFrame,
    test_share: float = 0.2,
    seed: int = 42,
    key: str | Sequence[str] = "id",
    label: str = LABEL,
) -> DataFrame:
    """Add `split` with exact quotas: of each class, the round(share * n) smallest hashes are test.

    The last hash of each quota is found first, by jobs that read the key and the label only; the
    rows themselves are not moved, each compares its hash with the one of its class. Rows of one key
    stay on one side, so a quota that ends within a repeated key takes all of its rows; several key
    columns that tell the rows apart make it exact. NULL is a key value like others.
    """
    digits = split_hash(_joined(key), seed)
    cuts = _cuts(df, digits, label, lambda n: [min(n, math.floor(n * test_share + 0.5))])
    test = F.coalesce(_by_class(label, {value: digits <= cut for value, [cut] in cuts.items()}), F.lit(False))
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def with_folds(
    df: DataFrame,
    folds: int = 5,
    seed: int = 42,
    key: str | Sequence[str] = "id",
    label: str | None = None,
) -> DataFrame:
    """Add `fold` 0..folds-1 by hash of the key.

    With a binary `label`, each class is cut into folds that differ by one row at most (rows of one
    key stay together), so every fold has both classes if they have `folds` keys or more. Without
    it, and for rows without a class, folds are even up to chance and need no pass over the data.
    """
    digits = split_hash(_joined(key), seed)
    fold = (F.conv(F.substring(digits, 25, 8), 16, 10).cast("bigint") % folds).cast("int")
    if label is not None:
        # the i-th cut is the rounded i-th part of the class
        cuts = _cuts(df, digits, label, lambda n: [(2 * n * i + folds) // (2 * folds) for i in range(1, folds)])
        fold = F.coalesce(
            _by_class(label, {value: _number_below(digits, ends) for value, ends in cuts.items()}), fold
        )
    return df.withColumn("fold", fold)


def _joined(key: str | Sequence[str]) -> Column:
    if isinstance(key, str):
        return named(key)
    parts = [F.coalesce(named(c).cast("string"), F.lit("\0null")) for c in key]
    return parts[0] if len(parts) == 1 else F.concat_ws("\x1f", *parts)


def _by_class(label: str, values: dict[int, Column]) -> Column:
    """The value of a row's class; NULL for a row without one."""
    chosen = F.lit(None)
    for value, column in values.items():
        chosen = F.when(named(label) == value, column).otherwise(chosen)
    return chosen


def _number_below(digits: Column, ends: Sequence[str]) -> Column:
    count = F.lit(0)
    for end in ends:
        count = count + (digits > end).cast("int")
    return count


def _cuts(
    df: DataFrame, digits: Column, label: str, quotas: Callable[[int], list[int]]
) -> dict[int, list[str]]:
    """Per class of the binary label, the largest hash within each of the class's quotas.

    A histogram over the next hash digits tells in which cell a quota ends. Cells that it ends in the
    middle of are counted by the digits that follow, until all quotas end with a cell.
    """
    spark = df.sparkSession
    hashed = df.where(named(label).isin(0, 1)).select(
        named(label).cast("int").alias("label"), digits.alias("hash")
    )
    sizes = {row["label"]: row["n"] for row in hashed.groupBy("label").agg(F.count("*").alias("n")).collect()}
    cuts = {value: [""] * len(quotas(n)) for value, n in sizes.items()}  # no hash is within "", the quota of 0
    open_ends = [(value, i, "", take) for value, n in sizes.items() for i, take in enumerate(quotas(n)) if take]
    for known in range(0, _HASH, _STEP):
        if not open_ends:
            break
        # a row per class and quota, and at most 65,536 cells for each
        ends = spark.createDataFrame(open_ends, "label int, end int, prefix string, take bigint")
        within = hashed.withColumn("prefix", F.substring("hash", 1, known)).join(
            F.broadcast(ends.select("label", "prefix").distinct()), ["label", "prefix"]
        )
        cells = within.groupBy("label", "prefix", F.substring("hash", 1, known + _STEP).alias("cell")).agg(
            F.count("*").alias("n")
        )
        upto = F.sum("n").over(Window.partitionBy("label", "prefix").orderBy("cell"))
        met = (
            cells.withColumn("upto", upto)
            .join(F.broadcast(ends), ["label", "prefix"])
            .where((F.col("upto") >= F.col("take")) & (F.col("upto") - F.col("n") < F.col("take")))
            .select("label", "end", "cell", "n", (F.col("take") - F.col("upto") + F.col("n")).alias("take"))
        )
        open_ends = []
        for row in met.collect():
            if row["take"] == row["n"] or known + _STEP == _HASH:
                cuts[row["label"]][row["end"]] = row["cell"].ljust(_HASH, "f")
            else:
                open_ends.append((row["label"], row["end"], row["cell"], row["take"]))
    return cuts
