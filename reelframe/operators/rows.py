"""Projections, casts, filters and unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.functions import nonzero, round_1, to_float
from reelframe.schema import PREVIEW_ROWS


def project_columns(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.select(*columns)


def cast_floats(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns as 32-bit floats, the others as they are."""
    return rows.withColumns({c: to_float(c) for c in columns})


def nonzero_rows(rows: DataFrame, column: str) -> DataFrame:
    """Rows whose text column holds a number other than 0."""
    return rows.filter(nonzero(column))


def nonblank_rows(rows: DataFrame, column: str) -> DataFrame:
    """Rows whose text column is neither null nor blank."""
    return rows.filter(F.col(column) != "")


def label_split(rows: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a label to learn from, and rows whose label is 0; null labels are in neither."""
    return rows.filter(F.col(label) != 0), rows.filter(F.col(label) == 0)


def drop_nulls(rows: DataFrame) -> DataFrame:
    return rows.na.drop()


def round_project(rows: DataFrame, column: str, name: str) -> DataFrame:
    """All columns, the named one replaced by its value rounded to one decimal."""
    kept = [c for c in rows.columns if c != column]
    return rows.select(*kept, round_1(column).alias(name))


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both by position, duplicates kept; numbers take the wider type."""
    return left.union(right)


def preview(rows: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return rows.limit(n)
