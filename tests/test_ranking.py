import math

import pytest
from plans import physical_plan
from pyspark.sql import functions as F

from reelframe.operators import (
    Descending,
    descending,
    fixed_slots,
    keyed_cross_join,
    positional_zip,
    row_index,
    sort_desc,
    sorting,
    top_k,
    unique_id,
)
from reelframe.operators import ranking


def test_descending_puts_nan_first_and_null_last(spark):
    rows = spark.createDataFrame(
        [(1, None), (2, 1.0), (3, math.nan), (4, 2.0)], "row_key int, p double"
    )
    assert [r.row_key for r in sort_desc(rows, "p", "row_key").collect()] == [3, 4, 2, 1]


def test_row_index_counts_through_a_hot_value(spark):
    """A third of all rows share the leading value; ids still follow the whole order."""
    rows = spark.range(3000).select(
        F.col("id").alias("row_key"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("p"),
    )
    got = row_index(rows.repartition(7), descending("p", "row_key"), "n").collect()
    expected = sorted(
        ((7 if i % 3 == 0 else i % 100, i) for i in range(3000)), key=lambda r: (-r[0], r[1])
    )
    assert [(r.p, r.row_key) for r in sorted(got, key=lambda r: r.n)] == expected
    assert sorted(r.n for r in got) == list(range(3000))


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(ranking, "RANGE_ROWS", 100)
    monkeypatch.setattr(ranking, "SAMPLE_PER_RANGE", 8)


def numbered(frame, name="n"):
    """Rows by their number, which count from 0 without a gap."""
    rows = sorted(frame.collect(), key=lambda r: r[name])
    assert [r[name] for r in rows] == list(range(len(rows)))
    return rows


def test_row_index_in_ranges_follows_any_order(spark, small_ranges):
    """Text, numbers with NaN and nulls, up and down, over many ranges."""
    rows = spark.range(3000).select(
        F.col("id").alias("row_key"),
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, float("nan")).otherwise(F.col("id") % 7 - 3.0).alias("p"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.concat(F.lit("Customer#00000"), (F.col("id") % 50).cast("string"))).alias("s"),
    )
    for order in (descending("p", "row_key"), [F.col("s"), *descending("p", "row_key")], [Descending(F.col("s")), F.col("row_key")]):
        got = numbered(row_index(rows.repartition(5), order, "n"))
        assert [r.row_key for r in got] == [r.row_key for r in rows.orderBy(*sorting(order)).collect()]


def test_row_index_splits_a_hot_leading_value(spark, small_ranges):
    """All rows share the leading value, a third of them the second one too; numbers do not depend on
    how the rows lie."""
    rows = spark.range(4000).select(
        F.lit("hot").alias("p"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("q"), F.col("id").alias("row_key")
    )
    runs = [row_index(rows.repartition(n), [F.col("p"), F.col("q")], "n") for n in (3, 5)]
    first, second = ({r.row_key: r.n for r in numbered(run)} for run in runs)
    assert first == second
    ordered = sorted(first, key=first.get)
    assert [0 if i % 3 == 0 else i for i in ordered] == sorted(0 if i % 3 == 0 else i for i in range(4000))


def test_row_index_writes_nothing_and_ranges_are_even(spark, small_ranges, monkeypatch):
    """Only counts by range reach the driver; no table of rows is written."""
    frames = []
    real = spark.createDataFrame

    def kept(data, schema=None, **more):
        frames.append((data, schema))
        return real(data, schema, **more)

    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, schema=None, **more: kept(data, schema, **more))
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.parquet", None)
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("p"), F.col("id").alias("k"))
    assert len(numbered(row_index(rows, [F.col("p"), F.col("k")], "n"))) == 5000
    offsets = next(data for data, schema in frames if "_size" in str(schema))
    sizes = [size for _, _, size in offsets]
    assert sum(sizes) == 5000 and len(sizes) > 30 and max(sizes) < 500


def test_row_index_of_copies(spark, small_ranges):
    """Rows that are the same in all columns are numbered one after the other."""
    rows = spark.range(2000).select(F.when(F.col("id") % 3 == 0, -5).otherwise(F.col("id")).alias("p"))
    got = numbered(row_index(rows, [F.col("p")], "n"))
    assert [r.p for r in got] == sorted(-5 if i % 3 == 0 else i for i in range(2000))


def test_row_index_of_nothing(spark):
    assert row_index(spark.range(0).withColumnRenamed("id", "k"), [F.col("k")], "n").collect() == []


def test_top_k_never_sorts_everything(spark, small_tables):
    orders = spark.read.parquet(f"{small_tables}/orders.parquet")
    plan = physical_plan(top_k(orders, descending("o_totalprice", "o_orderkey"), 10))
    assert "TakeOrderedAndProject(limit=10" in plan
    assert "rangepartitioning" not in plan


def test_fixed_slots_pads(spark):
    few = spark.createDataFrame([(0, "a", 5)], "id bigint, productName string, nums bigint")
    got = [tuple(r) for r in fixed_slots(few, 3).orderBy("id").collect()]
    assert got == [(0, "a", 5), (1, None, 0), (2, None, 0)]


def test_zip_pairs_by_position_not_by_key(spark):
    left = spark.createDataFrame([("1", "a"), ("10", "b"), ("2", "c")], "lk string, title string")
    right = spark.createDataFrame([("10", 5), ("3", 6)], "rk string, n int")
    got = positional_zip(left, [F.col("lk")], right, [F.col("rk")]).orderBy("id").collect()
    assert [(r.id, r.title, r.n) for r in got] == [(0, "a", 5), (1, "b", 6), (2, "c", None)]


def test_keyed_cross_join_keeps_one_row_per_key(spark):
    keys = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id int")
    scores = spark.createDataFrame([(3.0,), (8.5,)], "score double")
    frame = keyed_cross_join(keys, "id", scores, "score")
    assert sorted(tuple(r) for r in frame.collect()) == [(1, 8.5), (2, 8.5)]
    plan = physical_plan(frame)
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_unique_id(spark):
    ids = [r.n for r in unique_id(spark.range(100).repartition(5), "n").collect()]
    assert len(set(ids)) == 100


def test_slots_that_are_too_few_fail(spark):
    rows = spark.createDataFrame([(0, "a", 1), (3, "b", 2)], "id bigint, productName string, nums bigint")
    assert [tuple(r) for r in fixed_slots(rows, 4).orderBy("id").collect()][3] == (3, "b", 2)
    with pytest.raises(Exception, match="3 slots are too few for index 3"):
        fixed_slots(rows, 3).collect()
