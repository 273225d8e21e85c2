"""Wide rows to cells and back, and last-write-wins merges of cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.schema import CELL_FAMILY, QUALIFIER, ROW_KEY, VALUE, VERSION


def wide_to_cells(rows: DataFrame, columns: Sequence[str], key: str = ROW_KEY) -> DataFrame:
    """One cell per row and column; nulls are cells that were never written.

    A narrow step: every input row is expanded where it is read.
    """
    text = rows.select(
        F.col(key).cast("string").alias(key), *[F.col(c).cast("string").alias(c) for c in columns]
    )
    return text.unpivot(key, list(columns), QUALIFIER, VALUE).filter(F.col(VALUE).isNotNull())


def cells_to_wide(cells: DataFrame, columns: Sequence[str], key: str = ROW_KEY) -> DataFrame:
    """One row per key with the latest cell of each column; absent cells give null.

    The column list is given, so no job is run to find it. Cells of one key are combined
    before the shuffle, so a key with many versions is not gathered in one task.
    """
    return cells.groupBy(key).pivot(QUALIFIER, list(columns)).agg(F.max_by(VALUE, VERSION))


def latest_cells(cells: DataFrame, key: str = ROW_KEY) -> DataFrame:
    """The cell with the highest version of each (key, column)."""
    return cells.groupBy(key, QUALIFIER).agg(
        F.max_by(VALUE, VERSION).alias(VALUE), F.max(VERSION).alias(VERSION)
    )


def upsert_cells(old: DataFrame, new: DataFrame, key: str = ROW_KEY) -> DataFrame:
    """Old cells overwritten by new ones, cell by cell; cells not written again stay.

    Versions are unique within one (key, column).
    """
    return latest_cells(old.unionByName(new), key)


def latest_rows(rows: DataFrame, key: str, version: str | Column) -> DataFrame:
    """One row per key: for each column the value with the highest version, nulls passed over."""
    order = F.col(version) if isinstance(version, str) else version
    left_out = {key, version} if isinstance(version, str) else {key}
    return rows.groupBy(key).agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
            for c in rows.columns
            if c not in left_out
        ]
    )


def cell_listing(cells: DataFrame, key: str = ROW_KEY, name: str = "line") -> DataFrame:
    """Cells as text lines ``family:key,column:value``."""
    line = F.concat(
        F.lit(f"{CELL_FAMILY}:"), F.col(key), F.lit(","), F.col(QUALIFIER), F.lit(":"), F.col(VALUE)
    )
    return cells.select(key, QUALIFIER, VALUE, line.alias(name))
