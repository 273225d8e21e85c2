"""Literal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.schema import DEMO_ROWS


def literal_rows(spark: SparkSession, rows: Sequence[tuple], *names: str) -> DataFrame:
    """A few rows written in the program, as constants of the plan."""
    structs = [
        F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names, strict=True)]) for row in rows
    ]
    return spark.range(0, 1, numPartitions=1).select(F.inline(F.array(*structs)))


def inline_rows(
    spark: SparkSession,
    rows: Sequence[tuple[str, int]] = tuple(DEMO_ROWS),
    name: str = "productName",
    number: str = "nums",
) -> DataFrame:
    """A few (name, number) pairs."""
    return literal_rows(spark, rows, name, number).withColumn(number, F.col(number).cast("bigint"))
