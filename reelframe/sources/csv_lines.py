"""Quoted CSV read line by line, so that files of any size split across tasks.

The line is the unit of work here; files whose quoted fields hold line breaks are read by
``csv_records``. The halves of a record cut at a line have an odd number of quotes each, by which
``torn_line`` knows them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.functions import split_quoted, unquote_field
from reelframe.schema import MOVIE_COLUMNS, ROW_KEY


def read_lines(
    spark: SparkSession, path: str, encoding: str = "UTF-8", header: str | None = None
) -> DataFrame:
    """Lines of text files as ``value STRING``; lines equal to ``header`` are left out.

    ``spark.read.text`` passes bytes through as they are, so another encoding is decoded
    from the bytes.
    """
    lines = spark.read.text(path)
    if encoding.upper() != "UTF-8":
        lines = lines.select(F.decode(F.col("value").cast("binary"), encoding).alias("value"))
    if header is not None:
        lines = lines.filter(F.col("value") != header)
    return lines


def torn_line(column: str) -> Column:
    """Whether a line has an odd number of quotes: one half of a record with a line break in it."""
    line = F.col(column)
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def split_lines(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``fields`` of each line, beside the columns to keep."""
    return lines.select(*keep, split_quoted("value").alias("fields"))


def named_fields(
    split: DataFrame, columns: Sequence[str] = (ROW_KEY, *MOVIE_COLUMNS), keep: Sequence[str] = ()
) -> DataFrame:
    """Fields as string columns by position; those beyond the last column are ignored."""
    return split.select(*[F.get("fields", i).alias(name) for i, name in enumerate(columns)], *keep)


def header_fields(fields: Column, columns: Sequence[str] = MOVIE_COLUMNS) -> Column:
    """Whether the fields after the key are the column names, padded or quoted or not."""
    own = F.transform(
        F.slice(fields, 2, len(columns)), lambda field: F.lower(F.trim(unquote_field(F.trim(field))))
    )
    return own == F.array(*[F.lit(column.lower()) for column in columns])


def fields_to_wide(
    lines: DataFrame,
    columns: Sequence[str] = (ROW_KEY, *MOVIE_COLUMNS),
    strict: bool = True,
    headers: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Lines as string columns by position; fields beyond the last column are ignored.

    A line with too few fields fails the job, or is left out if not ``strict``:
    ``short_lines`` gives those. Header lines are left out if not ``headers``.
    """
    fields = F.col("fields")
    wanted = F.array("fields") if headers else F.when(~header_fields(fields, columns[1:]), F.array("fields"))
    short = F.size(fields) < len(columns)
    message = F.concat(F.lit("too few fields: "), F.array_join(fields, ","))
    instead = F.raise_error(message).cast("array<array<string>>") if strict else F.lit(None)
    split = split_lines(lines, keep).select(F.explode(F.when(short, instead).otherwise(wanted)).alias("fields"), *keep)
    return named_fields(split, columns, keep)


def short_lines(lines: DataFrame, width: int = 1 + len(MOVIE_COLUMNS)) -> DataFrame:
    """The lines with fewer fields than ``width``."""
    return lines.filter(F.size(split_quoted("value")) < width)


def scan_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] = (ROW_KEY, *MOVIE_COLUMNS),
    header: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """CSV files as string columns, quotes kept as they stand in the file."""
    return fields_to_wide(read_lines(spark, path, header=header), columns, strict)


def scrub_lines(
    lines: DataFrame, columns: Sequence[str] = (ROW_KEY, *MOVIE_COLUMNS), torn: str = "pass"
) -> DataFrame:
    """Rows whose last column is filled and which have exactly blank text after it.

    Header lines go, and so do lines too short to have a field after the last column. Half a
    record with a line break in it looks short too: with ``torn="fail"`` it fails the job.
    """
    width = len(columns)
    fields = F.col("fields")
    blank = ["", '""']
    if torn == "fail":
        message = F.concat(F.lit("odd number of quotes: "), F.col("value"))
        lines = lines.select(F.when(torn_line("value"), F.raise_error(message)).otherwise(F.col("value")).alias("value"))
    full = F.get(fields, width).isin(blank) & ~F.get(fields, width - 1).isin(blank)
    kept = F.when(full & ~header_fields(fields, columns[1:]), F.array("fields"))
    # A filter would be pushed below the split and split every line again for each mention of a
    # field. Exploding a one-element array, or null, keeps or drops a row and is not moved.
    rows = split_lines(lines).select(F.explode(kept).alias("fields"))
    return rows.select(*[unquote_field(F.get(fields, i)).alias(name) for i, name in enumerate(columns)])
