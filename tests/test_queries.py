"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_module
from check import compare, connect
from reelframe.registry import ORACLES, QUERIES



@pytest.fixture(scope="module")
def con(small_tables):
    return connect(small_tables)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, small_tables, name):
    outcome = compare(spark, con, name, small_tables)
    assert outcome.startswith("ok"), outcome
    assert outcome != "ok (0)", "nothing was compared"


def test_entry_has_rows_in_rank_order(spark):
    rows = entry_module.entry(spark).collect()
    assert [row.id for row in rows] == list(range(10))
    assert sorted((row.popularity for row in rows), reverse=True) == [r.popularity for r in rows]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_results_do_not_depend_on_shuffle_partitions(spark, small_tables):
    def run(name):
        return [tuple(r) for r in QUERIES[name](spark, small_tables).orderBy("id").collect()]

    before = {name: run(name) for name in ("row_index", "popularity_top10", "positional_zip")}
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert {name: run(name) for name in before} == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
