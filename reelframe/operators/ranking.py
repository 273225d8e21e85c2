"""Sorts, top-k and row numbers."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that one range of a row index holds, about; ranges at most (beyond, they grow); rows of the
#: sample from which a range's ends are taken.
RANGE_ROWS = 2**18
MOST_RANGES = 8192
SAMPLE_PER_RANGE = 64


@dataclass(frozen=True)
class Descending:
    """An order column, highest first: NaN before all numbers, nulls last."""

    column: Column


#: What rows are ordered by: columns stand for ascending ones, nulls first.
Order = Sequence[Column | Descending]


def descending(column: str, tiebreak: str) -> list[Column | Descending]:
    """Highest first, NaN before all numbers, nulls last; ties by key."""
    return [Descending(F.col(column)), F.col(tiebreak)]


def sorting(order: Order) -> list[Column]:
    """The order as columns to sort by."""
    return [key.column.desc_nulls_last() if isinstance(key, Descending) else key.asc() for key in order]


def sort_desc(rows: DataFrame, column: str, tiebreak: str) -> DataFrame:
    return rows.orderBy(*sorting(descending(column, tiebreak)))


def top_k(rows: DataFrame, order: Order, k: int, name: str = "id") -> DataFrame:
    """The first k rows in order, numbered from 0.

    Every task keeps k rows and only those are merged; the window sees k rows.
    """
    first = rows.orderBy(*sorting(order)).limit(k)
    position = F.row_number().over(Window.orderBy(*sorting(order))) - 1
    return first.withColumn(name, position.cast("bigint"))


def _before(left: Sequence[Column], right: Sequence[Column], order: Order) -> Column:
    """Whether one tuple of order values comes before another."""

    def less(key: Column | Descending, a: Column, b: Column) -> Column:
        if isinstance(key, Descending):
            return F.coalesce(a > b, a.isNotNull() & b.isNull())
        return F.coalesce(a < b, a.isNull() & b.isNotNull())

    found = F.lit(False)
    for key, a, b in reversed(list(zip(order, left, right, strict=True))):
        found = less(key, a, b) | (a.eqNullSafe(b) & found)
    return found


def _range_of(cuts: Column, ranges: int, keys: Sequence[Column], order: Order) -> Column:
    """How many cuts a row is not before: a binary search in the array of cuts."""
    steps = [1 << bit for bit in reversed(range((ranges - 1).bit_length()))]

    def onward(low: Column, step: Column) -> Column:
        cut = F.get(cuts, low + step - 1)
        past = (low + step <= ranges - 1) & ~_before(keys, [cut[f"k{i}"] for i in range(len(order))], order)
        return F.when(past, low + step).otherwise(low)

    return F.aggregate(F.array(*[F.lit(step) for step in steps]), F.lit(0), onward)


def row_index(rows: DataFrame, order: Order, name: str = "id") -> DataFrame:
    """All rows numbered 0, 1, 2, ... in order; rows that tie go by a hash of their values.

    A window over all rows would be one task. Instead rows are numbered within ranges of the
    order, and each range starts where the ones before it end. The ranges' ends are whole tuples of
    the order columns and the hash, so rows that share their leading values, or all of them, spread
    over several ranges. They come from a sample of the rows chosen by that hash and are the same in
    each scan. So the rows are scanned three times (twice if they fit one range) and shuffled
    once, and are not written; the driver holds the ends and one number for each range.

    ``rows`` must be the same rows in each scan: write them first if they come from sums of
    floating-point numbers or the like. A range that has grown since it was counted fails the job.
    """
    spark, total = rows.sparkSession, rows.count()
    ranges = min(max(-(-total // RANGE_ROWS), 1), MOST_RANGES)
    spread = F.xxhash64(*rows.columns)
    whole: Order = [*order, spread]
    keys = [key.column if isinstance(key, Descending) else key for key in whole]
    at, place, before, size = "_range", "_place", "_before", "_size"
    ranged = rows.withColumn(at, F.lit(0))
    if ranges > 1:
        share = max(total // (ranges * SAMPLE_PER_RANGE), 1)
        sample = rows.where(F.pmod(F.xxhash64(spread, F.lit(1)), F.lit(share)) == 0)
        # Equal tuples are one row with a number, so copies of a row cannot fill the sample.
        tuples = sample.groupBy(*[key.alias(f"k{i}") for i, key in enumerate(keys)]).agg(F.count(F.lit(1)).alias("n"))
        names = [f"k{i}" for i in range(len(keys))]
        sorts = [Descending(F.col(n)) if isinstance(key, Descending) else F.col(n) for n, key in zip(names, whole, strict=True)]
        found = tuples.orderBy(*sorting(sorts)).collect()
        step, seen, cuts = max(sum(row.n for row in found) / ranges, 1), 0, []
        for row in found:
            seen += row.n
            if seen >= step * (len(cuts) + 1) and len(cuts) < ranges - 1:
                cuts.append(row)
        ranges = len(cuts) + 1
        if cuts:
            held = spark.createDataFrame([[cuts]], f"cuts array<{tuples.schema.simpleString()}>")
            searched = rows.withColumn("_cuts", held.scalar())
            ranged = searched.withColumn(at, _range_of(F.col("_cuts"), ranges, keys, whole)).drop("_cuts")
    sizes = dict(ranged.groupBy(at).agg(F.count(F.lit(1)).alias(size)).collect())
    starts, start = [], 0
    for number in range(ranges):
        starts.append((number, start, sizes.get(number, 0)))
        start += sizes.get(number, 0)
    offsets = spark.createDataFrame(starts, f"{at} int, {before} long, {size} long")
    position = F.row_number().over(Window.partitionBy(at).orderBy(*sorting(whole))) - 1
    placed = ranged.withColumn(place, position.cast("bigint")).join(F.broadcast(offsets), at)
    message = F.lit("rows differ between two scans: write them before they are numbered")
    number = F.when(F.col(place) < F.col(size), F.col(before) + F.col(place)).otherwise(F.raise_error(message).cast("bigint"))
    return placed.select(*rows.columns, number.alias(name))


def unique_id(rows: DataFrame, name: str = "id") -> DataFrame:
    """A unique id per row, neither consecutive nor the same on every run."""
    return rows.withColumn(name, F.monotonically_increasing_id())


def fixed_slots(
    rows: DataFrame,
    n: int,
    index: str = "id",
    label: str = "productName",
    number: str = "nums",
    more: bool = False,
) -> DataFrame:
    """Exactly n rows: those with index 0 to n-1, gaps filled with (null, 0).

    A row with another index fails the job, as it would be lost; with ``more`` rows with an index
    from n on stay.
    """
    message = F.concat(F.lit(f"{n} slots are too few for index "), F.col(index).cast("string"))
    inside = F.when(F.col(index).between(0, n - 1), F.col(index)).otherwise(F.raise_error(message).cast("bigint"))
    slots = rows.sparkSession.range(0, n, numPartitions=1).withColumnRenamed("id", index)
    filled = rows.select(index if more else inside.alias(index), label, number)
    return slots.join(filled, index, "full" if more else "left").select(
        index, label, F.coalesce(number, F.lit(0)).cast("bigint").alias(number)
    )
