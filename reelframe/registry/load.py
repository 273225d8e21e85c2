"""CSV files, keyed tables and cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.functions import key_bytes, key_number, unquote_field
from reelframe.operators import (
    cell_listing,
    cells_to_wide,
    count_by,
    row_index,
    upsert_cells,
    wide_to_cells,
)
from reelframe.registry.base import query, table
from reelframe.registry.rows import event_lines
from reelframe.schema import MOVIE_COLUMNS, ROW_KEY, VERSION
from reelframe.session import scratch_path, scratch_table
from reelframe.sinks import KeyedTable, bulk_replace_sorted, write_csv
from reelframe.sources import (
    cells_by_qualifier,
    inline_rows,
    key_range,
    keyed_scan,
    read_lines,
    read_records,
    row_count,
    scan_csv,
    scrub_lines,
)

PART_COLUMNS = ["p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
PRIORITIES = [
    ("1-URGENT", 5),
    ("2-HIGH", 4),
    ("3-MEDIUM", 3),
    ("4-NOT SPECIFIED", 2),
    ("5-LOW", 1),
]

PART_TEXT_SQL = """
    SELECT CAST(p_partkey AS VARCHAR) AS row_key, p_name, p_brand, p_type,
           CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice
    FROM part
"""


def cells_sql(wide: str) -> str:
    return " UNION ALL ".join(
        f"SELECT row_key, '{c}' AS qualifier, {c} AS value FROM ({wide})" for c in PART_COLUMNS
    )


def part_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias(ROW_KEY),
        *[F.col(c).cast("string").alias(c) for c in PART_COLUMNS],
    )


def part_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_to_cells(part_text(spark, sf_dir), PART_COLUMNS)


@query(
    "csv_line_scan",
    """SELECT CAST(event_id AS VARCHAR) AS row_key, '"' || event_type || ', ' || user_id || '"' AS kind,
              '"' || replace(props, '"', '""') || '"' AS props, '' AS blank
       FROM events""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "events").select(event_lines()).write.text(path)
    return scan_csv(spark, path, [ROW_KEY, "kind", "props", "blank"])


def quoted(column: Column | str) -> Column:
    return F.concat(F.lit('"'), F.replace(column, F.lit('"'), F.lit('""')), F.lit('"'))


@query(
    "csv_scrub",
    """
    SELECT CAST(d.doc_id AS VARCHAR) AS row_key, replace(text, chr(10), ' ') AS overview,
           lang AS original_language, source AS homepage, CAST(n_chars AS VARCHAR) AS runtime,
           CAST(quality AS VARCHAR) AS vote_count
    FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic = 0
    """,
)
def _(spark, sf_dir):
    """Documents as film lines: kept if labelled (last column filled) and not toxic (blank after it)."""
    documents = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    fields = dict.fromkeys([ROW_KEY, *MOVIE_COLUMNS], F.lit("-"))
    fields |= {
        ROW_KEY: F.col("doc_id").cast("string"),
        "overview": quoted(F.replace("text", F.lit("\n"), F.lit(" "))),
        "original_language": F.col("lang"),
        "homepage": F.col("source"),
        "runtime": F.col("n_chars").cast("string"),
        "vote_count": F.coalesce(F.col("quality").cast("string"), F.lit("")),
    }
    after = F.when(F.col("toxic") == 1, "x").otherwise("")
    line = F.concat_ws(",", *fields.values(), after)
    path = scratch_path(spark, "latin-1")
    documents.select(F.encode(line, "ISO-8859-1").cast("string").alias("value")).write.text(path)
    scrubbed = scrub_lines(read_lines(spark, path, "ISO-8859-1"))
    return scrubbed.select(
        ROW_KEY, "overview", "original_language", "homepage", "runtime", "vote_count"
    )


@query(
    "csv_records",
    """SELECT CAST(doc_id AS VARCHAR) AS row_key, text AS overview, lang AS original_language,
              CAST(n_chars AS VARCHAR) AS runtime
       FROM documents""",
)
def _(spark, sf_dir):
    """Documents with all their line breaks as quoted fields of film records, scrubbed."""
    fields = dict.fromkeys([ROW_KEY, *MOVIE_COLUMNS], F.lit("-"))
    fields |= {
        ROW_KEY: F.col("doc_id").cast("string"),
        "overview": quoted("text"),
        "original_language": F.col("lang"),
        "runtime": F.col("n_chars").cast("string"),
    }
    path = scratch_path(spark, "records")
    line = F.concat_ws(",", *fields.values(), F.lit(""))
    table(spark, sf_dir, "documents").select(line.alias("value")).write.text(path)
    scrubbed = scrub_lines(read_records(spark, path))
    return scrubbed.select(ROW_KEY, "overview", "original_language", "runtime")


@query(
    "csv_write",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type || ', ' || user_id AS kind,
              '' AS blank, props
       FROM events""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "csv")
    kind = F.concat("event_type", F.lit(", "), "user_id")
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        kind.alias("kind"),
        F.lit("").alias("blank"),
        "props",
    )
    write_csv(rows, path)
    back = scan_csv(spark, path, rows.columns, header=",".join(rows.columns))
    return back.select(*[unquote_field(c).alias(c) for c in rows.columns])


@query("keyed_scan", PART_TEXT_SQL + " ORDER BY row_key")
def _(spark, sf_dir):
    parts = KeyedTable(scratch_table(spark, "parts"), buckets=8)
    parts.upsert(part_text(spark, sf_dir))
    return parts.scan(spark, ordered=True)


@query(
    "key_bytes_scan",
    """SELECT row_number() OVER (ORDER BY key < 0, key) - 1 AS id, key, p_name
       FROM (SELECT CASE WHEN p_partkey % 3 = 0 THEN -p_partkey ELSE p_partkey END AS key, p_name FROM part)""",
)
def _(spark, sf_dir):
    """Whole-number keys, some below 0, in the order of their bytes."""
    number = F.when(F.col("p_partkey") % 3 == 0, -F.col("p_partkey")).otherwise(F.col("p_partkey"))
    parts = KeyedTable(scratch_table(spark, "parts"), key="key", buckets=8)
    parts.replace(table(spark, sf_dir, "part").select(key_bytes(number).alias("key"), "p_name"))
    numbered = row_index(parts.scan(spark), [F.col("key")])
    return numbered.select("id", key_number("key").alias("key"), "p_name")


#: Keys far from each other: the powers of two.
SCATTERED = [str(2**i) for i in range(40)]


@query("pick_keys", f"SELECT * FROM ({PART_TEXT_SQL}) WHERE row_key IN ({', '.join(map(repr, SCATTERED))})")
def _(spark, sf_dir):
    parts = KeyedTable(scratch_table(spark, "parts"), buckets=8)
    parts.replace(part_text(spark, sf_dir))
    return parts.pick(spark, SCATTERED)


@query("cells_to_wide", PART_TEXT_SQL)
def _(spark, sf_dir):
    cells = part_cells(spark, sf_dir).withColumn(VERSION, F.lit(1))
    return cells_to_wide(cells, PART_COLUMNS)


@query(
    "cells_by_qualifier",
    """SELECT CAST(p_partkey AS VARCHAR) AS row_key, 'p_retailprice' AS qualifier,
              CAST(CAST(p_retailprice AS FLOAT) AS DOUBLE) AS value
       FROM part""",
)
def _(spark, sf_dir):
    prices = cells_by_qualifier(part_cells(spark, sf_dir), "p_retailprice", "float")
    return prices.withColumn("value", F.col("value").cast("double"))


@query(
    "inline_rows",
    f"""SELECT name AS "productName", CAST(n AS BIGINT) AS nums, count(o_orderkey) AS orders
        FROM (VALUES {", ".join(str(row) for row in PRIORITIES)}) AS t(name, n)
        LEFT JOIN orders ON o_orderpriority = name GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    """Literal weights beside the counts found in the data."""
    counts = count_by(table(spark, sf_dir, "orders"), "o_orderpriority")
    found = counts.select(F.col("o_orderpriority").alias("productName"), F.col("count").alias("orders"))
    weighted = inline_rows(spark, PRIORITIES).join(found, "productName", "left")
    return weighted.select("productName", "nums", F.coalesce("orders", F.lit(0)).alias("orders"))


@query("row_count", "SELECT count(*) AS rows FROM lineitem")
def _(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


@query(
    "rowkey_range_scan",
    f"""SELECT row_key, qualifier, value, 'info:' || row_key || ',' || qualifier || ':' || value AS line
        FROM ({cells_sql(PART_TEXT_SQL)}) WHERE row_key >= '12' AND row_key < '7'""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "sorted-cells")
    bulk_replace_sorted(part_cells(spark, sf_dir), path, (ROW_KEY, "qualifier"))
    return cell_listing(key_range(keyed_scan(spark, path), "12", "7"))


@query("bulk_replace_sorted", cells_sql(PART_TEXT_SQL))
def _(spark, sf_dir):
    path = scratch_path(spark, "sorted-cells")
    bulk_replace_sorted(part_cells(spark, sf_dir), path, (ROW_KEY, "qualifier"))
    return keyed_scan(spark, path)


@query("wide_to_cells", cells_sql(PART_TEXT_SQL))
def _(spark, sf_dir):
    return part_cells(spark, sf_dir)


# Parts over size 25 are written again: another brand, and one size less.
REWRITTEN_SQL = """
    SELECT CAST(p_partkey AS VARCHAR) AS row_key, p_name,
           CASE WHEN p_size > 25 THEN 'new ' || p_brand ELSE p_brand END AS p_brand, p_type,
           CAST(CASE WHEN p_size > 25 THEN p_size - 1 ELSE p_size END AS VARCHAR) AS p_size,
           CAST(p_retailprice AS VARCHAR) AS p_retailprice
    FROM part
"""


def part_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = table(spark, sf_dir, "part").filter(F.col("p_size") > 25)
    return large.select(
        F.col("p_partkey").cast("string").alias(ROW_KEY),
        F.concat(F.lit("new "), "p_brand").alias("p_brand"),
        (F.col("p_size") - 1).cast("string").alias("p_size"),
    )


@query("upsert_by_key", cells_sql(REWRITTEN_SQL))
def _(spark, sf_dir):
    old = part_cells(spark, sf_dir).withColumn(VERSION, F.lit(1))
    new = wide_to_cells(part_changes(spark, sf_dir), ["p_brand", "p_size"]).withColumn(
        VERSION, F.lit(2)
    )
    return upsert_cells(old, new).select(ROW_KEY, "qualifier", "value")


@query("upsert_table", REWRITTEN_SQL)
def _(spark, sf_dir):
    parts = KeyedTable(scratch_table(spark, "parts"), buckets=8)
    parts.upsert(part_text(spark, sf_dir))
    parts.upsert(part_changes(spark, sf_dir))
    return parts.scan(spark)


@query(
    "small_upsert",
    """SELECT CAST(c_custkey AS VARCHAR) AS row_key, c_name AS name,
              CAST(c_nationkey + CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS VARCHAR) AS age
       FROM customer""",
)
def _(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    people = KeyedTable(scratch_table(spark, "people"), buckets=8)
    key = F.col("c_custkey").cast("string").alias(ROW_KEY)
    people.upsert(
        customers.select(
            key, F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("age")
        )
    )
    older = customers.filter(F.col("c_acctbal") < 0)
    people.upsert(older.select(key, (F.col("c_nationkey") + 1).cast("string").alias("age")))
    return people.scan(spark)
