"""Running totals over a global order, without a global window.

A window without partitions would run in one task. Here the rows are range-partitioned by the order
key, each range is summed where it lies, batch by batch, and the totals of the ranges before it are
added. So rows are shuffled and sorted once. The rows with their range are written to scratch in
between: the table is read once however often the result is used, and a lost executor cannot move the
borders of the ranges.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

from prospectra.functions import named
from prospectra.sources.scratch import materialize


def running_totals(
    df: DataFrame,
    order_columns: Sequence[str],
    sum_columns: Sequence[str],
    group_columns: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add `cum_<c>`: the sum of `c` over all rows up to and including this one, per group.

    `df` has one row per group and order key, so the ranges come out even. Groups are few by
    contract (labels, column names); one group may hold all rows, the ranges cut through groups.
    The summed columns hold whole numbers.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = list(group_columns)
    order = [named(c).asc() for c in groups]
    order += [named(c).desc() if descending else named(c).asc() for c in order_columns]
    ranged = (
        df.withColumns({c: named(c).cast("bigint") for c in sum_columns})
        .repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_range", F.spark_partition_id())
    )
    summed = [T.StructField(f"cum_{c}", T.LongType()) for c in sum_columns]
    schema = T.StructType([*ranged.schema.fields, *summed])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = [pa.scalar(0, pa.int64())] * len(sum_columns)
        for batch in batches:
            if batch.num_rows:
                columns = [pc.fill_null(batch.column(c), 0) for c in sum_columns]
                sums = [pc.cumulative_sum(c, start=b) for c, b in zip(columns, before, strict=True)]
                before = [s[-1] for s in sums]
                yield pa.record_batch([*batch.columns, *sums], schema.names)

    within = materialize(ranged.mapInArrow(add_up, schema), "running-totals")

    # One row per range and group in a range. A range sums over all its groups, so what the groups
    # before add to it comes off again.
    totals = within.groupBy("_range", *groups).agg(
        *[F.sum(named(c)).alias(f"_total_{c}") for c in sum_columns]
    )
    rows_before = (Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*(groups or [F.lit(0)])).orderBy("_range").rowsBetween(*rows_before)
    offsets = {c: _sum_or_zero(f"_total_{c}", earlier) for c in sum_columns}
    if groups:
        beside = Window.partitionBy("_range").orderBy(*groups).rowsBetween(*rows_before)
        offsets = {c: gained - _sum_or_zero(f"_total_{c}", beside) for c, gained in offsets.items()}
    shifts = totals.select(
        "_range", *groups, *[shift.alias(f"_shift_{c}") for c, shift in offsets.items()]
    )
    placed = within.join(shifts, ["_range", *groups])
    return placed.select(
        *[named(c) for c in df.columns],
        *[(F.col(f"cum_{c}") + F.col(f"_shift_{c}")).alias(f"cum_{c}") for c in sum_columns],
    )


def _sum_or_zero(column: str, window: WindowSpec) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def dense_number(keys: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Number distinct keys 0, 1, 2, ... in key order; a key with a NULL part gets no number."""
    complete = reduce(and_, [named(c).isNotNull() for c in columns])
    numbered = running_totals(keys.withColumn("_one", complete.cast("int")), columns, ["_one"])
    number = F.when(complete, F.col("cum__one") - 1).cast("bigint")
    return numbered.select(*[named(c) for c in keys.columns], number.alias(name))
