"""Reads of keyed tables: whole, by key range, and by cell name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.functions import float_to_long, to_float
from reelframe.schema import BUCKET, QUALIFIER, ROW_KEY, VALUE


def keyed_scan(
    spark: SparkSession, path: str, key: str = ROW_KEY, ordered: bool = False
) -> DataFrame:
    """All rows of a keyed table; sorted by key only on request, as that is a shuffle."""
    rows = spark.read.parquet(path)
    rows = rows.drop(BUCKET) if BUCKET in rows.columns else rows
    return rows.orderBy(key) if ordered else rows


def key_range(rows: DataFrame, start, stop, key: str = ROW_KEY) -> DataFrame:
    """Rows with ``start <= key < stop``.

    The bounds reach the Parquet scan. Files and row groups of a table sorted by key hold
    narrow key ranges, so most of them are skipped.
    """
    return rows.filter((F.col(key) >= F.lit(start)) & (F.col(key) < F.lit(stop)))


def cells_by_qualifier(cells: DataFrame, qualifier: str, decode: str = "string") -> DataFrame:
    """Cells of one column, decoded as ``string``, ``float`` or ``long``."""
    value = F.col(VALUE)
    decoded = {
        "string": value,
        "float": to_float(value),
        "long": F.coalesce(value.try_cast("bigint"), float_to_long(to_float(value))),
    }[decode]
    return cells.filter(F.col(QUALIFIER) == qualifier).withColumn(VALUE, decoded)


def row_count(rows: DataFrame, name: str = "rows") -> DataFrame:
    """One row with the number of rows; no column is read."""
    return rows.agg(F.count(F.lit(1)).alias(name))
