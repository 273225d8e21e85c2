"""Pairing by position, and what an unconditioned join leaves behind in a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.operators.ranking import Order, row_index


def positional_zip(
    left: DataFrame,
    left_order: Order,
    right: DataFrame,
    right_order: Order,
    index: str = "id",
) -> DataFrame:
    """The k-th row of one frame beside the k-th row of the other; the longer one runs on.

    Both sides are numbered, then joined on the number, which is unique. When both columns
    come from one row a plain ``select`` does the same without a shuffle.
    """
    return row_index(left, left_order, index).join(row_index(right, right_order, index), index, "full")


def keyed_cross_join(keys: DataFrame, key: str, values: DataFrame, value: str) -> DataFrame:
    """Every key joined with every value, then stored by key: one row per key is left.

    Which value survives is arbitrary in such a job; here it is always the largest. So the
    (keys x values) rows need not be made: the largest value is one scalar.
    """
    largest = values.agg(F.max(value)).scalar()
    return keys.filter(F.col(key).isNotNull()).select(key).distinct().withColumn(value, largest)
