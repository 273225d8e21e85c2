"""Frequent values by a sketch, and percentages as printed."""

import random

import pytest
from pyspark.sql import functions as F

from reelframe.operators import aggregates, count_by, frequent, share_labels, top_counts


def listed(frame):
    return [tuple(r) for r in frame.orderBy("id").select("id", "word", "count").collect()]


def words(spark, kind):
    rng = random.Random(2)
    if kind == "skewed":
        drawn = [f"w{min(int(rng.paretovariate(0.7)), 5000)}" for _ in range(20_000)]
    elif kind == "flat":
        drawn = [f"w{i % 5000}" for i in range(20_000)]
    else:
        drawn = ["a", "b", "a", "c", "c", "c"]
    return spark.createDataFrame([(w,) for w in drawn] + [(None,)], "word string").repartition(5)


@pytest.mark.parametrize("kind,proven", [("skewed", True), ("flat", False), ("few", True)])
def test_frequent_equals_the_full_count(spark, monkeypatch, kind, proven):
    values = words(spark, kind)
    full = []
    real = aggregates.count_by

    def counted(rows, column, min_count=0):
        full.append("left_semi" not in str(rows._jdf.queryExecution().logical()).lower().replace("leftsemi", "left_semi"))
        return real(rows, column, min_count)

    monkeypatch.setattr(aggregates, "count_by", counted)
    got = listed(frequent(values, "word", 20, tracked=2**12))
    monkeypatch.undo()
    wanted = listed(top_counts(count_by(values.where(F.col("word").isNotNull()), "word"), "word", 20))
    assert got == wanted and got
    assert any(full) == (not proven)


def test_frequent_of_nothing(spark):
    assert frequent(spark.createDataFrame([], "word string"), "word").collect() == []


@pytest.mark.parametrize("counts", [[1, 1, 1], [1] * 7, [10**12, 1, 1, 3], [5], [0, 0, 4], list(range(1, 60))])
def test_labels_add_up(spark, counts):
    rows = spark.createDataFrame([(f"k{i:03}", n) for i, n in enumerate(counts)], "key string, count long")
    got = {r.key: r for r in share_labels(rows, "key").collect()}
    total = sum(counts)
    units = {f"k{i:03}": divmod(10_000 * n, total) for i, n in enumerate(counts)}
    missing = 10_000 - sum(whole for whole, _ in units.values())
    more = sorted(units, key=lambda k: (-units[k][1], k))[:missing]
    assert {k: round(float(r.label) * 100) for k, r in got.items()} == {k: w + (k in more) for k, (w, _) in units.items()}
    assert sum(round(float(r.label) * 100) for r in got.values()) == 10_000
    assert all(len(r.label.split(".")[1]) == 2 for r in got.values())


def test_labels_of_nothing(spark):
    rows = spark.createDataFrame([("a", 0), ("b", 0)], "key string, count long")
    assert {r.label for r in share_labels(rows, "key").collect()} == {None}


@pytest.mark.parametrize("kind", ["skewed", "flat"])
def test_frequent_works_out_values_once(spark, kind):
    made = spark.sparkContext.accumulator(0)

    def word(value):
        made.add(1)
        return value

    values = words(spark, kind).select(F.udf(word, "string").asNondeterministic()("word").alias("word"))
    got = listed(frequent(values, "word", 20, tracked=2**12))
    assert got and made.value == 20_001
