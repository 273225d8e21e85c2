import datetime as dt

import pytest
from pyspark.sql import functions as F

from reelframe.session import scratch_table
from reelframe.sinks import KeyedTable
from reelframe.streaming import count_events, stream_files, write_counts


@pytest.fixture
def zone(spark):
    """A zone far from UTC with clock changes, restored afterwards."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def write_events(spark, path, name, events):
    rows = [(dt.datetime.fromisoformat(at), kind) for at, kind in events]
    frame = spark.createDataFrame(rows, "at timestamp_ntz, kind string")
    frame.coalesce(1).write.parquet(f"{path}/{name}")


def run(spark, source, out, progress, lateness=None, files=1000, event_id=None):
    counts = count_events(stream_files(spark, f"{source}/*", files), "at", "kind", lateness, event_id)
    table = KeyedTable(out, buckets=3)
    write_counts(counts, table, progress).awaitTermination()
    rows = table.scan(spark).collect()
    return {(r.day.isoformat(), r.kind): r["count"] for r in rows}


def test_counts_grow_over_restarts_and_late_rows_drop(spark, zone, tmp_path):
    source, progress = (str(tmp_path / p) for p in ("in", "progress"))
    out = scratch_table(spark, "out")
    write_events(
        spark,
        source,
        "a",
        [
            ("2024-03-10T00:00:00", "x"),
            ("2024-03-10T23:59:59.999999", "x"),
            ("2024-03-11T00:00:00", "y"),
        ],
    )
    def again():
        return run(spark, source, out, progress, "1 day")

    first = again()
    assert first == {("2024-03-10", "x"): 2, ("2024-03-11", "y"): 1}
    assert again() == first

    write_events(spark, source, "b", [("2024-03-11T12:00:00", "y"), ("2024-03-20T00:00:00", "x")])
    second = again()
    assert second == first | {("2024-03-11", "y"): 2, ("2024-03-20", "x"): 1}

    write_events(spark, source, "c", [("2024-03-10T05:00:00", "x"), ("2024-03-20T01:00:00", "x")])
    third = again()
    assert third == second | {("2024-03-20", "x"): 2}


@pytest.mark.parametrize("files", [1, 2, 1000])
def test_totals_do_not_depend_on_micro_batches(spark, tmp_path, files):
    source = str(tmp_path / "in")
    for i in (5, 0, 7, 2, 6, 1, 4, 3):
        events = [(f"2024-0{1 + (3 * i + j) % 8}-01T00:00:00", "xy"[j % 2]) for j in range(5)]
        write_events(spark, source, f"part{i}", events)
    got = run(spark, source, scratch_table(spark, "out"), str(tmp_path / "progress"), files=files)
    assert sum(got.values()) == 40
    expected = {}
    for i in range(8):
        for j in range(5):
            key = (f"2024-0{1 + (3 * i + j) % 8}-01", "xy"[j % 2])
            expected[key] = expected.get(key, 0) + 1
    assert got == expected


def test_paced_stream_picks_up_new_files(spark, tmp_path):
    source, progress = (str(tmp_path / p) for p in ("in", "progress"))
    out = scratch_table(spark, "out")
    write_events(spark, source, "a", [("2024-01-01T00:00:00", "x")])
    table = KeyedTable(out, buckets=2)
    counts = count_events(stream_files(spark, f"{source}/*"), "at", "kind")
    running = write_counts(counts, table, progress, every="1 second")
    try:
        running.processAllAvailable()
        write_events(spark, source, "b", [("2024-01-01T01:00:00", "x")])
        running.processAllAvailable()
        assert [r["count"] for r in table.scan(spark).collect()] == [2]
    finally:
        running.stop()


def test_rows_are_counted_before_the_shuffle(spark, tmp_path):
    source = str(tmp_path / "in")
    write_events(spark, source, "a", [("2024-01-01T00:00:00", "x")])
    counts = count_events(spark.read.parquet(f"{source}/a"), "at", "kind")
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.index("partial_count")
    assert counts.select(F.date_format("day", "yyyy-MM-dd")).first()[0] == "2024-01-01"


def write_numbered(spark, path, name, events):
    rows = [(i, dt.datetime.fromisoformat(at), kind) for i, at, kind in events]
    frame = spark.createDataFrame(rows, "event_id long, at timestamp_ntz, kind string")
    frame.coalesce(1).write.parquet(f"{path}/{name}")


def test_repeated_events_count_once_over_batches_and_a_restart(spark, tmp_path):
    """Events sent again in the same file, in another micro-batch and after a restart."""
    source, progress = str(tmp_path / "in"), str(tmp_path / "progress")
    out = scratch_table(spark, "out")
    events = [(i, f"2024-0{1 + i % 4}-0{1 + i % 9}T0{i % 10}:00:00", "xyz"[i % 3]) for i in range(60)]
    nameless = [(None, "2024-01-01T00:00:00", "x")] * 3
    write_numbered(spark, source, "a", events[:40] + events[:10] + nameless)
    write_numbered(spark, source, "b", events[20:50])

    def totals(of):
        found = {}
        for _, at, kind in of:
            found[at[:10], kind] = found.get((at[:10], kind), 0) + 1
        return found

    first = run(spark, source, out, progress, "3650 days", files=1, event_id="event_id")
    assert first == totals(events[:50] + nameless)
    write_numbered(spark, source, "c", events[::-1])
    second = run(spark, source, out, progress, "3650 days", files=1, event_id="event_id")
    assert second == totals(events + nameless)
    batch = spark.read.parquet(f"{source}/*").where("event_id is not null").dropDuplicates(["event_id"])
    assert sum(second.values()) == batch.count() + 3


def test_repeats_need_a_lateness(spark, tmp_path):
    write_numbered(spark, str(tmp_path / "in"), "a", [(1, "2024-01-01T00:00:00", "x")])
    with pytest.raises(ValueError, match="lateness"):
        count_events(stream_files(spark, str(tmp_path / "in/*")), "at", "kind", event_id="event_id")


def test_the_deal_of_repeated_events_grows_with_the_input(spark):
    from reelframe.registry.serve import repeated_events

    events = spark.range(8000).select(F.col("id").alias("event_id")).repartition(8)
    dealt = repeated_events(events)
    sizes = [row["count"] for row in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 8000 + 8000 // 3 + 1
    # Four files of the whole input gave a task a third of all rows.
    assert max(sizes) <= 8000 // 8
    placed = dealt.withColumn("file", F.spark_partition_id())
    ids = placed.groupBy("event_id").agg(F.count("*").alias("n"), F.count_distinct("file").alias("files"))
    assert ids.filter("n = 2 and files = 1").count() <= ids.filter("n = 2").count() // 4
