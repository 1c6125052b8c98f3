"""Exact quantiles and modes of whole columns.

The built-in `percentile`, `median` and `mode` hold every distinct value of a column in the memory
of one task. Here quantiles are found by narrowing: the bits of a double, read as a whole number, ascend
with the double, so a pass counts the values per cell of equal leading bits, for all columns in the
same scan, and the next pass only looks into the cells in which a rank lies. A task sends a histogram
of bounded size, no row is moved or repeated per column, and no pass depends on a sketch. A mode
counts the values with a shuffle that keeps them spread over the executors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prospectra.functions import named

#: Leading bits of the first pass's cells, sign and exponent among them, and bits that each later pass adds.
_FIRST, _BITS = 17, 12
#: Values of a cell that are fetched as they are instead of being narrowed further.
_FETCHED = 16_384


def value_counts(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """(column, value, n) over the values of all named columns; NULL and NaN are not values."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), named(c).cast(kind).alias("value"))
            for c in columns
        ]
    )
    values = df.select(F.inline(pairs)).where(F.col("value").isNotNull())
    if kind == "double":
        values = values.where(~F.isnan("value"))
    return values.groupBy("column", "value").agg(F.count("*").alias("n"))


def column_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    accuracy: int | None = None,
) -> DataFrame:
    """(column, quantiles): linear interpolation between the neighbouring ranks, as pandas does.

    Exact by default; columns without a value are left out. With an `accuracy`, only the sketch is
    taken, in a single pass and with a rank error of at most 1 / accuracy.
    """
    if accuracy is not None:
        sketch = _sketch(df, columns, list(probabilities), accuracy)
        return sketch.where(F.col("total") > 0).select("column", "quantiles")
    found = _narrowed(df, list(columns), list(probabilities))
    return df.sparkSession.createDataFrame(
        list(found.items()), "column string, quantiles array<double>"
    )


def _number(name: str) -> Column:
    return F.nanvl(named(name).cast("double"), F.lit(None).cast("double"))


def _sketch(
    df: DataFrame, columns: Sequence[str], probabilities: list[float], accuracy: int
) -> DataFrame:
    """(column, total, quantiles) from one pass over all columns."""
    sketches = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(_number(c)).alias("total"),
            F.percentile_approx(_number(c), probabilities, accuracy).alias("quantiles"),
        )
        for c in columns
    ]
    return df.agg(F.array(*sketches).alias("rows")).select(F.inline("rows"))


def _codes(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles; both zeros are one."""
    bits = (values + 0.0).view(np.int64)
    return bits ^ (bits >> 63 & np.iinfo(np.int64).max)


def _value(code: int) -> float:
    return float(np.array([code ^ (code >> 63 & np.iinfo(np.int64).max)], np.int64).view(np.float64)[0])


@dataclass
class _Cell:
    """A stretch of codes of one column in which ranks lie: those from `low` to `high`, behind `before` others."""

    column: int
    low: int
    high: int
    before: int
    shift: int
    ranks: set[int] = field(default_factory=set)


def _histogram(codes: np.ndarray, counts: np.ndarray, lows: np.ndarray, highs: np.ndarray, shift: int):
    """Codes in ascending order, added up by cell: number, smallest and largest code."""
    cells = codes >> shift
    starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    # stretches overlap, so the last to begin need not be the one that ends last
    return cells[starts], np.add.reduceat(counts, starts), lows[starts], np.maximum.reduceat(highs, starts)


def _pass(df: DataFrame, cells: list[_Cell]) -> pa.Table:
    """(target, low, high, n) per cell of the next level within each of `cells`, in one scan."""
    shifts = [cell.shift for cell in cells]
    columns = sorted({cell.column for cell in cells})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in cells]

        def add_up(k: int) -> None:
            low, high, n = (np.concatenate(part) for part in zip(*held[k]))
            order = np.argsort(low, kind="stable")
            _, n, low, high = _histogram(low[order], n[order], low[order], high[order], shifts[k])
            held[k] = [(low, high, n)]

        for batch in batches:
            codes = {}
            for place, column in enumerate(columns):
                values = batch.column(place).drop_null().to_numpy(zero_copy_only=False)
                codes[column] = _codes(values[~np.isnan(values)])
            for k, cell in enumerate(cells):
                own = codes[cell.column]
                own = own[(own >= cell.low) & (own <= cell.high)]
                if len(own):
                    distinct, n = np.unique(own, return_counts=True)
                    _, n, low, high = _histogram(distinct, n, distinct, distinct, shifts[k])
                    held[k].append((low, high, n))
                    if len(held[k]) > 64:
                        add_up(k)
        for k in range(len(cells)):
            if held[k]:
                add_up(k)
                low, high, n = (pa.array(part) for part in held[k][0])
                yield pa.record_batch([pa.array([k] * len(n), pa.int32()), low, high, n], ["target", "low", "high", "n"])

    wanted = df.select(*[named(df.columns[c]).cast("double").alias(f"_{c}") for c in columns])
    counted = wanted.mapInArrow(count, "target int, low bigint, high bigint, n bigint")
    levels = sorted(set(shifts))
    level = F.get(F.array(*[F.lit(levels.index(s)) for s in shifts]), F.col("target"))
    cell = F.get(F.array(*[F.shiftright("low", s) for s in levels]), level)
    return (
        counted.groupBy("target", cell.alias("cell"))
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
        .drop("cell")
        .toArrow()  # per target a row for each cell that has values, whatever the number of rows
    )


def _narrowed(df: DataFrame, names: list[str], probabilities: list[float]) -> dict[str, list[float]]:
    """Quantiles of the columns that have values."""
    lowest, highest = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    open_cells = [_Cell(df.columns.index(c), int(lowest), int(highest), 0, 64 - _FIRST) for c in names]
    totals: dict[int, int] = {}
    at_rank: dict[tuple[int, int], float] = {}
    while open_cells:
        table = _pass(df, open_cells).sort_by([("target", "ascending"), ("low", "ascending")])
        targets, low, high, n = (table.column(c).to_numpy() for c in ("target", "low", "high", "n"))
        following = []
        for k, cell in enumerate(open_cells):
            of = slice(*np.searchsorted(targets, [k, k + 1]))
            upto = cell.before + np.cumsum(n[of])
            if not cell.ranks:  # the first pass counts the values
                if not len(upto):
                    continue
                totals[cell.column] = int(upto[-1])
                cell.ranks = {r for p in probabilities for r in _ranks(p, totals[cell.column])}
            inside: dict[int, _Cell] = {}
            for rank in cell.ranks:
                i = int(np.searchsorted(upto, rank, side="right"))
                least, most, count = int(low[of][i]), int(high[of][i]), int(n[of][i])
                if least == most:
                    at_rank[cell.column, rank] = _value(least)
                    continue
                below = 0 if count <= _FETCHED else max(0, cell.shift - _BITS)
                target = inside.setdefault(i, _Cell(cell.column, least, most, int(upto[i]) - count, below))
                target.ranks.add(rank)
            following += inside.values()
        open_cells = following
    found = {}
    for name in names:
        column = df.columns.index(name)
        if column not in totals:
            continue
        found[name] = []
        for p in probabilities:
            place = p * (totals[column] - 1)
            a, b = (at_rank[column, r] for r in _ranks(p, totals[column]))
            found[name].append(a if a == b else a + (b - a) * (place - math.floor(place)))
    return found


def _ranks(probability: float, total: int) -> tuple[int, int]:
    place = probability * (total - 1)
    return math.floor(place), math.ceil(place)


def column_modes(df: DataFrame, columns: Sequence[str], kind: str) -> DataFrame:
    """(column, mode): the most frequent value, the smallest of equals; columns without values lack."""
    counts = value_counts(df, columns, kind)
    first = F.struct((-F.col("n")).alias("rank"), F.col("value").alias("value"))
    return counts.groupBy("column").agg(F.min(first).getField("value").alias("mode"))


def mode_value(df: DataFrame, column: str) -> DataFrame:
    """One row with the most frequent value of a text column, "Unknown" if it has none."""
    modes = column_modes(df, [column], "string")
    return modes.agg(F.coalesce(F.max("mode"), F.lit("Unknown")).alias("mode"))
