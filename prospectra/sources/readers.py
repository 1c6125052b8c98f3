"""CSV readers.

The header is read first (one line), so that columns are matched by name and typed without an
inference pass; a missing path or a value that is not of its type fails the read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prospectra.functions.scalars import named, strict_cast
from prospectra.schemas import CUSTOMERS, NONCUSTOMERS, USAGE

# What pandas reads as missing by default, besides empty text.
MISSING_MARKERS = [
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def read_csv_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    order_column: str | None = None,
    mode: str = "FAILFAST",
    multi_line: bool = False,
) -> DataFrame:
    """Read a headered CSV; columns outside `schema` come back as strings, absent ones stay absent.

    `order_column` adds the row's place in the input (see `scan_order`), which the keep-first and
    keep-last operators need because a DataFrame has no row order. `multi_line` allows line breaks
    inside quotes, at the price of one task per file. `mode` says what happens to rows with a wrong
    number of fields.
    """
    reader = (
        spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    )
    # Without a schema every column is text, and only the header line is read at this point.
    texts = reader.option("enforceSchema", False).option("mode", mode).csv(path)
    types = {field.name: field.dataType.simpleString() for field in schema}
    columns = [_typed(name, types.get(name, "string")).alias(name) for name in texts.columns]
    if order_column:
        columns.append(scan_order().alias(order_column))
    return texts.select(*columns)


def _typed(name: str, kind: str) -> Column:
    text = F.when(~named(name).isin(MISSING_MARKERS), named(name))
    return text if kind == "string" else strict_cast(text, kind)


def read_customers(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv_table(spark, path, CUSTOMERS, **options)


def read_noncustomers(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv_table(spark, path, NONCUSTOMERS, **options)


def read_usage(spark: SparkSession, path: str, **options) -> DataFrame:
    return read_csv_table(spark, path, USAGE, **options)


def scan_order() -> Column:
    """Place of a row in the files it was read from; only valid directly on a file scan.

    A retried task reads the same split, so the value survives the loss of an executor.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
