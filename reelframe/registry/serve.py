"""The result tables, their chart feeds and the event stream."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.functions import unquote_field
from reelframe.operators import count_by, fixed_slots, largest_first, runtime_histogram, top_k
from reelframe.plans import (
    load_job,
    popularity_chart,
    popularity_job,
    popularity_top10,
    runtime_chart,
    runtime_job,
    score_job,
    scrub_job,
)
from reelframe.registry.base import query, table
from reelframe.registry.ml import leak_sql
from reelframe.registry.rows import HISTOGRAM_SQL, MIN_LINES, TITLES_SQL, as_double, runtimes, titles
from reelframe.schema import (
    MIN_GROUP_SIZE,
    MOVIE_COLUMNS,
    POPULARITY_SLOTS,
    ROW_KEY,
    RUNTIME_SLOTS,
    TOP_TITLES,
)
from reelframe.session import scratch_path, scratch_table
from reelframe.sinks import KeyedTable
from reelframe.streaming import count_events, stream_files, write_counts

TOP_SQL = f"""
    SELECT row_number() OVER (ORDER BY popularity DESC, row_key) - 1 AS id, original_title, popularity
    FROM ({TITLES_SQL}) ORDER BY popularity DESC, row_key LIMIT {TOP_TITLES}
"""

RANKED_SQL = f"""
    SELECT row_number() OVER (ORDER BY count DESC, runtime) - 1 AS id, runtime, count
    FROM ({HISTOGRAM_SQL})
"""


@query("popularity_top10", TOP_SQL)
def _(spark, sf_dir):
    top = popularity_top10(titles(spark, sf_dir))
    return top.select("id", "original_title", as_double("popularity"))


@query("runtime_histogram", RANKED_SQL)
def _(spark, sf_dir):
    histogram = runtime_histogram(runtimes(spark, sf_dir), "runtime", MIN_LINES)
    return histogram.select("id", "runtime", "count")


@query(
    "fixed_slots",
    f"""
    SELECT slot AS id, name AS "productName", coalesce(n, 0) AS nums
    FROM (SELECT unnest(range({POPULARITY_SLOTS})) AS slot)
    LEFT JOIN (SELECT row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS id,
                      o_orderpriority AS name, count(*) AS n
               FROM orders GROUP BY o_orderpriority) ON slot = id
    """,
)
def _(spark, sf_dir):
    counts = count_by(table(spark, sf_dir, "orders"), "o_orderpriority")
    ranked = top_k(counts, largest_first("o_orderpriority"), POPULARITY_SLOTS)
    return fixed_slots(
        ranked.select("id", F.col("o_orderpriority").alias("productName"), F.col("count").alias("nums")),
        POPULARITY_SLOTS,
    )


@query(
    "popularity_chart",
    f"""
    SELECT slot AS id, split_part(original_title, ':', 1) AS "productName",
           coalesce(CAST(trunc(popularity) AS BIGINT), 0) AS nums
    FROM (SELECT unnest(range({POPULARITY_SLOTS})) AS slot) LEFT JOIN ({TOP_SQL}) ON slot = id
    """,
)
def _(spark, sf_dir):
    return popularity_chart(popularity_top10(titles(spark, sf_dir)))


@query(
    "runtime_chart",
    f"""
    SELECT id, "productName", nums, nums * CAST(100 AS DOUBLE) / nullif(sum(nums) OVER (), 0) AS share
    FROM (SELECT slot AS id, runtime AS "productName", coalesce(count, 0) AS nums
          FROM (SELECT unnest(range(greatest({RUNTIME_SLOTS}, (SELECT count(*) FROM ({RANKED_SQL}))))) AS slot)
          LEFT JOIN ({RANKED_SQL}) ON slot = id)
    """,
)
def _(spark, sf_dir):
    """The feed with as many slots as there are groups, and the usual number at least."""
    histogram = runtime_histogram(runtimes(spark, sf_dir), "runtime", MIN_LINES)
    return runtime_chart(histogram, RUNTIME_SLOTS, more=True)


def streamed(spark, events, **told):
    """Counts of events that are read as several micro-batches."""
    path = scratch_path(spark, "event-counts")
    events.write.parquet(f"{path}/events")
    result = KeyedTable(scratch_table(spark, "counts"), buckets=4)
    counts = count_events(stream_files(spark, f"{path}/events", files_per_batch=2), "ts", "event_type", **told)
    write_counts(counts, result, f"{path}/progress").awaitTermination()
    return result.scan(spark).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "count")


EVENT_COUNTS_SQL = """
    SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS count FROM events GROUP BY 1, 2
"""


@query("stream_event_counts", EVENT_COUNTS_SQL)
def _(spark, sf_dir):
    """The events dealt over four files, unordered in time, and read as three micro-batches."""
    return streamed(spark, table(spark, sf_dir, "events").repartition(4, "event_id"))


@query("stream_repeated_events", EVENT_COUNTS_SQL)
def _(spark, sf_dir):
    """Every third event is sent again in another file; each counts once."""
    return streamed(spark, repeated_events(table(spark, sf_dir, "events")), lateness="36500 days", event_id="event_id")


def repeated_events(events: DataFrame) -> DataFrame:
    """The events and every third one again, the copies dealt to other files than the first sending.

    Four files for each partition of the input, so no task of the deal gets a share of all events
    that grows with them.
    """
    again = events.filter(F.col("event_id") % 3 == 0)
    dealt = events.withColumn("_file", F.lit(0)).union(again.withColumn("_file", F.lit(1)))
    return dealt.repartition(4 * events.rdd.getNumPartitions(), "_file", "event_id").drop("_file")


def order_films(spark, sf_dir, changed: bool):
    """Orders as films, all text; the changed table lacks some titles' figures and some films."""
    orders = table(spark, sf_dir, "orders")
    if changed:
        orders = orders.filter(F.col("o_orderkey") % 7 != 0)
    popularity = F.col("o_totalprice").cast("float").cast("string")
    vote = F.substring_index("o_orderpriority", "-", 1).try_cast("int") - 1
    values = {
        "row_key": F.col("o_orderkey").cast("string"),
        "id": F.col("o_orderkey").cast("string"),
        "original_title": F.col("o_orderpriority"),
        "popularity": F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(popularity) if changed else popularity,
        "runtime": (F.col("o_orderkey") % (5 if changed else 11)).cast("string"),
        "vote_average": vote.cast("string"),
        "budget": F.col("o_custkey").cast("string"),
        "revenue": F.lit("1"),
        "vote_count": F.lit("1"),
    }
    return orders.select(*[value.alias(name) for name, value in values.items()])


def run_twice(spark, sf_dir, job):
    """A job's result table after a run on the full films and another on the changed ones."""
    movies = KeyedTable(scratch_table(spark, "movies"), buckets=4)
    result = KeyedTable(scratch_table(spark, "result"), key="id", buckets=4)
    for changed in (False, True):
        movies.replace(order_films(spark, sf_dir, changed))
        job(spark, movies, result)
    return result.scan(spark)


CHANGED_SQL = "SELECT * FROM orders WHERE o_orderkey % 7 <> 0"


@query(
    "popularity_result",
    f"""
    SELECT row_number() OVER (ORDER BY popularity DESC NULLS LAST, row_key) - 1 AS id, original_title, popularity
    FROM (SELECT CAST(o_orderkey AS VARCHAR) AS row_key, o_orderpriority AS original_title,
                 CASE WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) END AS popularity
          FROM ({CHANGED_SQL}))
    ORDER BY popularity DESC NULLS LAST, row_key LIMIT {TOP_TITLES}
    """,
)
def _(spark, sf_dir):
    rows = run_twice(spark, sf_dir, popularity_job)
    return rows.select("id", "original_title", as_double("popularity"))


@query(
    "runtime_result",
    f"""
    SELECT row_number() OVER (ORDER BY count DESC, runtime) - 1 AS id, runtime, count
    FROM (SELECT CAST(o_orderkey % 5 AS VARCHAR) AS runtime, count(*) AS count
          FROM ({CHANGED_SQL}) WHERE o_orderkey % 5 <> 0 GROUP BY 1 HAVING count(*) >= {MIN_GROUP_SIZE})
    """,
)
def _(spark, sf_dir):
    return run_twice(spark, sf_dir, runtime_job)


@query(
    "score_result",
    f"""
    SELECT CAST(o_orderkey AS INTEGER) AS id,
           CASE WHEN y <> 0 THEN y WHEN o_orderkey % 3 <> 0 THEN round(b, 1) END AS vote_average
    FROM (SELECT *, CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) - 1 AS y FROM ({CHANGED_SQL})),
         ({leak_sql(f"SELECT CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) - 1 AS y FROM ({CHANGED_SQL}) WHERE o_orderkey % 3 <> 0")})
    """,
)
def _(spark, sf_dir):
    return run_twice(spark, sf_dir, partial(score_job, leak=True))


@query(
    "film_load",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS row_key,
           o_orderpriority || CASE WHEN o_orderkey % 5 = 1 THEN ',' || chr(10) ELSE ', ' END || '"' || o_orderstatus || '"'
             AS original_title,
           CAST(o_custkey AS VARCHAR) AS popularity
    FROM orders WHERE o_orderkey % 5 <> 2
    """,
)
def _(spark, sf_dir):
    """Raw records with headers, line breaks in fields and short lines, scrubbed and loaded."""
    path = scratch_path(spark, "film-load")
    write_raw_films(spark, sf_dir, f"{path}/raw")
    scrub_job(spark, f"{path}/raw", f"{path}/clean", f"{path}/torn")
    movies = KeyedTable(scratch_table(spark, "movies"), buckets=4)
    load_job(spark, f"{path}/clean", movies, f"{path}/rejects")
    return movies.scan(spark).select(
        ROW_KEY, unquote_field("original_title").alias("original_title"), "popularity"
    )


@query(
    "load_counts",
    """
    SELECT unnest(['headers', 'loaded', 'rejected']) AS name,
           unnest([count(*) FILTER (o_orderkey % 5 = 3), count(*) FILTER (o_orderkey % 5 <> 2),
                   count(*) FILTER (o_orderkey % 5 = 2)]) AS records
    FROM orders
    """,
)
def _(spark, sf_dir):
    """What the pass that loads raw records has seen."""
    path = scratch_path(spark, "load-counts")
    write_raw_films(spark, sf_dir, f"{path}/raw")
    movies = KeyedTable(scratch_table(spark, "movies"), buckets=4)
    seen = load_job(spark, f"{path}/raw", movies, f"{path}/rejects")
    return spark.createDataFrame(sorted(seen.items()), "name string, records long")


def write_raw_films(spark, sf_dir, path):
    """Orders as raw film records: every fifth one has a line break in its title, another is short,
    and another stands below a header line."""
    orders = table(spark, sf_dir, "orders")
    title = F.concat(F.col("o_orderpriority"), F.lit(', ""'), F.col("o_orderstatus"), F.lit('""'))
    fields = dict.fromkeys([ROW_KEY, *MOVIE_COLUMNS], F.lit("x"))
    fields |= {
        ROW_KEY: F.col("o_orderkey").cast("string"),
        "original_title": F.concat(F.lit('"'), title, F.lit('"')),
        "popularity": F.col("o_custkey").cast("string"),
    }
    full = F.concat_ws(",", *fields.values(), F.lit(""), F.lit(""))
    torn = F.replace(full, F.lit(', ""'), F.lit(',\n""'))
    short = F.substring_index(full, ",", 6)
    header = F.lit(",".join([ROW_KEY, *[f" {name}" for name in MOVIE_COLUMNS], "", ""]))
    kind = F.col("o_orderkey") % 5
    line = F.when(kind == 1, torn).when(kind == 2, short).otherwise(full)
    lines = orders.select(F.explode(F.when(kind == 3, F.array(header, line)).otherwise(F.array(line))).alias("value"))
    lines.write.text(path)
