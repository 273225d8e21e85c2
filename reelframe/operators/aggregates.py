"""Counts by value, shares and ranked counts. All combine before they shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.operators.ranking import Descending, Order, row_index, top_k
from reelframe.operators.rows import nonzero_rows
from reelframe.schema import MIN_GROUP_SIZE, TOP_KEYWORDS
from reelframe.session import scratch_path


def count_by(rows: DataFrame, column: str, min_count: int = 0) -> DataFrame:
    """Rows per distinct value; values seen fewer than ``min_count`` times are left out."""
    counts = rows.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.filter(F.col("count") >= min_count) if min_count > 0 else counts


def largest_first(column: str) -> Order:
    """Order of counted values: most frequent first, ties by value. Values are distinct."""
    return [Descending(F.col("count")), F.col(column)]


def nonzero_counts(rows: DataFrame, column: str, min_count: int = MIN_GROUP_SIZE) -> DataFrame:
    """Rows per distinct text (``"90"`` and ``"90.0"`` differ), zeros and non-numbers left out."""
    return count_by(nonzero_rows(rows, column), column, min_count)


def runtime_histogram(
    rows: DataFrame, column: str = "runtime", min_count: int = MIN_GROUP_SIZE
) -> DataFrame:
    """``nonzero_counts`` with an index from 0, most frequent first."""
    return row_index(nonzero_counts(rows, column, min_count), largest_first(column))


def share_of_total(counts: DataFrame, number: str = "count", name: str = "share") -> DataFrame:
    """Each count in percent of all counts; null if they add up to 0.

    The total is a scalar subquery: partial sums everywhere, one value at the end.
    """
    total = counts.agg(F.sum(number)).scalar()
    return counts.withColumn(name, F.try_divide(F.col(number) * F.lit(100.0), total))


def share_labels(counts: DataFrame, key: str, number: str = "count", name: str = "label", decimals: int = 2) -> DataFrame:
    """Each count in percent of all as printed, with so many decimals; the labels add up to 100.

    Largest remainders: every share is rounded down, and what is missing to 100 goes, one last
    digit each, to the shares that lost most; ties by key. Exact in whole numbers of 38 digits. Null
    if all counts are 0. There are at most ``100 * 10 ** decimals`` last digits to give, so only so
    many rows are ranked.
    """
    units = 100 * 10**decimals
    wide = F.col(number).cast("decimal(28,0)")
    shares = counts.select(key, (wide * F.lit(units)).cast("decimal(38,0)").alias("_scaled"))
    shares = shares.withColumn("_total", counts.agg(F.sum(wide).cast("decimal(38,0)")).scalar()).where("_total > 0")
    known = shares.selectExpr(key, "_scaled div _total AS _whole", "_scaled % _total AS _lost")
    first = [Descending(F.col("_lost")), F.col(key)]
    most = top_k(known.select(key, "_lost"), first, units, "_place")
    missing = known.agg((F.lit(units) - F.sum("_whole")).cast("bigint")).scalar()
    given = most.withColumn("_missing", missing).where("_place < _missing").select(key, F.lit(1).alias("_more"))
    digits = (F.col("_whole") + F.coalesce("_more", F.lit(0))).cast("decimal(20,0)") / F.lit(10**decimals)
    label = digits.cast(f"decimal(20,{decimals})").cast("string")
    whole = known.join(given, key, "left").select(key, label.alias(name))
    return counts.join(whole, key, "left")


def exploded(rows: DataFrame, names: Column, column: str) -> DataFrame:
    """Every element of an array column that is not null, as a row.

    The outer form: a plain ``explode`` gets a filter on the array's size, which is moved down and
    makes the array once more for every row.
    """
    return rows.select(F.explode_outer(names).alias(column)).filter(F.col(column).isNotNull())


def exploded_counts(rows: DataFrame, names: Column, column: str) -> DataFrame:
    """Occurrences of every element of an array column."""
    return count_by(exploded(rows, names, column), column)


def top_counts(counts: DataFrame, column: str, n: int = TOP_KEYWORDS) -> DataFrame:
    """The n most frequent values."""
    return top_k(counts, largest_first(column), n)


#: Values that the sketch of a frequent-value count keeps, at first; its error is this many times
#: the number of rows over that, at most (the bound of the sketch's makers).
TRACKED = 2**16
SKETCH_ERROR = 3.5


def frequent(values: DataFrame, column: str, n: int = TOP_KEYWORDS, tracked: int = TRACKED) -> DataFrame:
    """The n most frequent values of a column as ``top_counts`` gives them, over very many values.

    One pass makes a sketch of a bounded size in each task, whose merge names candidates; a second
    one counts only those. A value that is no candidate occurs at most as often as the sketch's
    error or its last candidate's estimate, which is never too low. If the n-th exact count is
    larger, none can be missing; else all values are counted. So the shuffle holds sketches
    instead of every distinct value of every task, unless the counts are nearly flat.
    """
    spark = values.sparkSession
    # The values are worked out once and read again by each pass below, which may be three.
    kept = scratch_path(spark, "frequent")
    values.where(F.col(column).isNotNull()).select(column).write.parquet(kept)
    filled = spark.read.schema(values.select(column).schema).parquet(kept)
    candidates = tracked // 4
    seen = filled.agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k({column}, {candidates}, {tracked})").alias("top")
    ).first()
    named = [(row["item"], row["count"]) for row in seen.top or []]
    if not named:
        return top_counts(count_by(filled, column), column, n)
    error = SKETCH_ERROR * seen.rows / tracked
    missed = max(named[-1][1], error) if len(named) == candidates else error
    found = spark.createDataFrame([(item,) for item, _ in named], values.select(column).schema)
    exact = count_by(filled.join(F.broadcast(found), column, "left_semi"), column)
    top = top_counts(exact, column, n)
    last = top.agg(F.count(F.lit(1)).alias("rows"), F.min("count").alias("count")).first()
    everything = len(named) < candidates and error < 1
    if everything or (last.rows == n and last["count"] > missed):
        return top
    return top_counts(count_by(filled, column), column, n)
