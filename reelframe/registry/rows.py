"""Projections, filters, sorts, counts, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.functions import (
    float_to_long,
    json_text,
    split_quoted,
    title_head,
    to_float,
    to_int,
)
from reelframe.operators import (
    count_by,
    descending,
    drop_nulls,
    keyed_cross_join,
    label_split,
    nonblank_rows,
    nonzero_counts,
    nonzero_rows,
    positional_zip,
    preview,
    project_columns,
    round_project,
    row_index,
    share_labels,
    share_of_total,
    sort_desc,
    top_k,
    union_all,
    unique_id,
)
from reelframe.plans import genre_histogram, keyword_top100
from reelframe.registry.base import query, table
from reelframe.schema import MIN_GROUP_SIZE, TOP_TITLES

# Running times stand-in: whole quantities as text, with the threshold of the real job.
MIN_LINES = MIN_GROUP_SIZE


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as titles: popularity is the order's price."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("row_key"),
        F.col("o_orderpriority").alias("original_title"),
        F.col("o_totalprice").cast("float").alias("popularity"),
    )


def runtimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as films: running time is the quantity, as text."""
    quantity = F.col("l_quantity").cast("int").cast("string")
    return table(spark, sf_dir, "lineitem").select(quantity.alias("runtime"))


def messy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with a text number that is no number for errors."""
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(
        F.col("value").cast("string")
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("text"))


MESSY_SQL = """
    SELECT event_id,
           CASE WHEN event_type = 'error' THEN event_type ELSE CAST(value AS VARCHAR) END AS text
    FROM events
"""

TITLES_SQL = """
    SELECT o_orderkey AS row_key, o_orderpriority AS original_title,
           CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS popularity
    FROM orders
"""

HISTOGRAM_SQL = f"""
    SELECT CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS runtime, count(*) AS count
    FROM lineitem
    WHERE CAST(l_quantity AS INTEGER) <> 0
    GROUP BY 1 HAVING count(*) >= {MIN_LINES}
"""


def as_double(column: str) -> Column:
    """Floats are compared as doubles, which hold them exactly."""
    return F.col(column).cast("double").alias(column)


@query("project_columns", "SELECT p_partkey, p_name, p_size FROM part")
def _(spark, sf_dir):
    return project_columns(table(spark, sf_dir, "part"), ["p_partkey", "p_name", "p_size"])


@query(
    "cast_float",
    f"SELECT event_id, CAST(try_cast(text AS FLOAT) AS DOUBLE) AS number FROM ({MESSY_SQL})",
)
def _(spark, sf_dir):
    rows = messy_events(spark, sf_dir)
    return rows.select("event_id", to_float("text").cast("double").alias("number"))


@query(
    "cast_int",
    f"""SELECT event_id, CAST(trunc(try_cast(text AS DOUBLE)) AS INTEGER) AS number
        FROM ({MESSY_SQL})""",
)
def _(spark, sf_dir):
    return messy_events(spark, sf_dir).select("event_id", to_int("text").alias("number"))


@query(
    "string_to_number",
    f"""SELECT event_id, CAST(try_cast(text AS FLOAT) AS DOUBLE) AS as_float,
               CAST(trunc(try_cast(text AS DOUBLE)) AS INTEGER) AS as_int
        FROM ({MESSY_SQL})""",
)
def _(spark, sf_dir):
    return messy_events(spark, sf_dir).select(
        "event_id", to_float("text").cast("double").alias("as_float"), to_int("text").alias("as_int")
    )


@query(
    "nonzero_string_filter",
    """
    SELECT l_orderkey, l_linenumber, text FROM (
        SELECT l_orderkey, l_linenumber,
               CASE WHEN l_returnflag = 'R' THEN '' ELSE CAST(l_tax AS VARCHAR) END AS text
        FROM lineitem)
    WHERE try_cast(text AS DOUBLE) <> 0
    """,
)
def _(spark, sf_dir):
    text = F.when(F.col("l_returnflag") == "R", "").otherwise(F.col("l_tax").cast("string"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text.alias("text"))
    return nonzero_rows(rows, "text")


@query(
    "label_split",
    """
    SELECT l_orderkey, l_linenumber, label, CASE WHEN label <> 0 THEN 'train' ELSE 'predict' END AS part
    FROM (SELECT l_orderkey, l_linenumber, round(l_discount * 100, 0) AS label FROM lineitem)
    """,
)
def _(spark, sf_dir):
    label = F.round(F.col("l_discount") * 100, 0)
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", label.alias("label"))
    train, unscored = label_split(rows, "label")
    return train.withColumn("part", F.lit("train")).union(
        unscored.withColumn("part", F.lit("predict"))
    )


@query(
    "drop_nulls",
    f"""SELECT event_id, CAST(try_cast(text AS FLOAT) AS DOUBLE) AS number
        FROM ({MESSY_SQL}) WHERE try_cast(text AS FLOAT) IS NOT NULL""",
)
def _(spark, sf_dir):
    rows = messy_events(spark, sf_dir)
    return drop_nulls(rows.select("event_id", to_float("text").cast("double").alias("number")))


@query(
    "having_min_count",
    "SELECT l_partkey, count(*) AS count FROM lineitem GROUP BY l_partkey HAVING count(*) >= 30",
)
def _(spark, sf_dir):
    return count_by(table(spark, sf_dir, "lineitem"), "l_partkey", 30)


@query(
    "index_below",
    f"""SELECT id, row_key, popularity FROM (
            SELECT row_number() OVER (ORDER BY popularity DESC, row_key) - 1 AS id, row_key, popularity
            FROM ({TITLES_SQL}))
        WHERE id < {TOP_TITLES}""",
)
def _(spark, sf_dir):
    rows = titles(spark, sf_dir).select("row_key", "popularity")
    first = top_k(rows, descending("popularity", "row_key"), TOP_TITLES)
    return first.select("id", "row_key", as_double("popularity"))


@query(
    "round_project",
    "SELECT o_orderkey, CAST(round(CAST(o_totalprice AS DECIMAL(18, 2)), 1) AS DOUBLE) AS price FROM orders",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return round_project(rows, "o_totalprice", "price")


@query(
    "round_1",
    """SELECT l_orderkey, l_linenumber,
              CAST(round(CAST(l_extendedprice AS DECIMAL(18, 2)), 1) AS DOUBLE) AS price
       FROM lineitem""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return round_project(rows, "l_extendedprice", "price")


@query(
    "nonblank_filter",
    """
    SELECT page_id, fragment FROM (
        SELECT page_id,
               CASE WHEN contains(url, '#') THEN substr(url, strpos(url, '#')) ELSE '' END AS fragment
        FROM pages)
    WHERE fragment <> ''
    """,
)
def _(spark, sf_dir):
    fragment = F.when(
        F.contains("url", F.lit("#")), F.concat(F.lit("#"), F.substring_index("url", "#", -1))
    ).otherwise("")
    rows = table(spark, sf_dir, "pages").select("page_id", fragment.alias("fragment"))
    return nonblank_rows(rows, "fragment")


@query(
    "cross_join",
    """
    SELECT DISTINCT o_custkey AS id,
           (SELECT max(CAST(CAST(l_tax AS FLOAT) AS DOUBLE)) FROM lineitem) AS vote_average
    FROM orders
    """,
)
def _(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"))
    score = F.col("l_tax").cast("float").cast("double").alias("vote_average")
    return keyed_cross_join(ids, "id", table(spark, sf_dir, "lineitem").select(score), "vote_average")


@query(
    "positional_zip",
    """
    SELECT id, p_name, c_acctbal
    FROM (SELECT row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) - 1 AS id, p_name FROM part)
    FULL JOIN (SELECT row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1 AS id, c_acctbal
               FROM customer)
    USING (id)
    """,
)
def _(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("part_key"), "p_name"
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_key"), "c_acctbal"
    )
    zipped = positional_zip(parts, [F.col("part_key")], customers, [F.col("customer_key")])
    return zipped.select("id", "p_name", "c_acctbal")


@query(
    "row_index",
    f"""SELECT row_number() OVER (ORDER BY popularity DESC, row_key) - 1 AS id, row_key, popularity
        FROM ({TITLES_SQL})""",
)
def _(spark, sf_dir):
    rows = titles(spark, sf_dir).select("row_key", "popularity")
    indexed = row_index(rows, descending("popularity", "row_key"))
    return indexed.select("id", "row_key", as_double("popularity"))


@query("unique_id", "SELECT count(*) AS rows, count(*) AS ids FROM lineitem")
def _(spark, sf_dir):
    rows = unique_id(table(spark, sf_dir, "lineitem").select("l_orderkey"))
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"))


@query("sort_desc", f"SELECT row_key, original_title, popularity FROM ({TITLES_SQL})")
def _(spark, sf_dir):
    return sort_desc(titles(spark, sf_dir), "popularity", "row_key").select(
        "row_key", "original_title", as_double("popularity")
    )


@query("sort_by_id", "SELECT CAST(p_partkey AS INTEGER) AS id, p_name FROM part ORDER BY id")
def _(spark, sf_dir):
    text = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(to_int(text).alias("id"), "p_name").orderBy("id")


@query(
    "union_widen",
    """SELECT CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS score FROM lineitem
       UNION ALL SELECT l_discount FROM lineitem""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return union_all(
        rows.select(F.col("l_tax").cast("float").alias("score")), rows.select("l_discount")
    )


@query("union_ids", "SELECT l_orderkey AS id FROM lineitem WHERE round(l_discount * 100, 0) IS NOT NULL")
def _(spark, sf_dir):
    label = F.round(F.col("l_discount") * 100, 0).alias("label")
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), label)
    train, unscored = label_split(rows, "label")
    return union_all(train.select("id"), unscored.select("id"))


@query(
    "split_quoted",
    """SELECT event_id, 5 AS fields, CAST(event_id AS VARCHAR) AS f0,
              '"' || event_type || ', ' || user_id || '"' AS f1,
              '"' || replace(props, '"', '""') || '"' AS f2, '' AS f3, '' AS f4
       FROM events""",
)
def _(spark, sf_dir):
    fields = split_quoted(event_lines())
    rows = table(spark, sf_dir, "events").select("event_id", fields.alias("fields"))
    return rows.select(
        "event_id",
        F.size("fields").alias("fields"),
        *[F.get("fields", i).alias(f"f{i}") for i in range(5)],
    )


def event_lines() -> Column:
    """An event as a CSV line with quoted commas, doubled quotes and trailing blanks."""
    return F.concat(
        F.col("event_id"),
        F.lit(',"'),
        F.col("event_type"),
        F.lit(", "),
        F.col("user_id"),
        F.lit('","'),
        F.replace("props", F.lit('"'), F.lit('""')),
        F.lit('",,'),
    )


@query("title_head", "SELECT page_id, split_part(url, ':', 1) AS head FROM pages")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", title_head("url").alias("head"))


@query(
    "float_to_long",
    "SELECT o_orderkey, CAST(trunc(CAST(o_totalprice AS FLOAT)) AS BIGINT) AS price FROM orders",
)
def _(spark, sf_dir):
    price = float_to_long(F.col("o_totalprice").cast("float"))
    return table(spark, sf_dir, "orders").select("o_orderkey", price.alias("price"))


@query(
    "json_text",
    """SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type
              || '","user_id":' || user_id || '}' AS json
       FROM events""",
)
def _(spark, sf_dir):
    text = json_text("event_id", "event_type", "user_id")
    return table(spark, sf_dir, "events").select("event_id", text.alias("json"))


def json_field(names: Column) -> Column:
    """Names as a film's JSON list, quoted as in the CSV file."""
    listed = F.transform(
        names, lambda name, i: F.struct(i.cast("bigint").alias("id"), name.alias("name"))
    )
    return F.concat(F.lit('"'), F.replace(F.to_json(listed), F.lit('"'), F.lit('""')), F.lit('"'))


@query(
    "genre_histogram",
    """SELECT name, count(*) AS count
       FROM (SELECT unnest(string_split(p_name, ' ')) AS name FROM part) GROUP BY name""",
)
def _(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(json_field(F.split("p_name", " ")).alias("genres"))
    return genre_histogram(parts, "genres", "name")


KEYWORDS_SQL = r"""
    SELECT row_number() OVER (ORDER BY count DESC, keyword) - 1 AS id, keyword, count
    FROM (SELECT keyword, count(*) AS count
          FROM (SELECT unnest(regexp_split_to_array(lower(text), '\s+')) AS keyword FROM documents)
          WHERE keyword <> '' GROUP BY keyword)
    ORDER BY count DESC, keyword LIMIT 100
    """


def document_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of a document as a film's keywords."""
    words = F.filter(F.split(F.lower("text"), r"\s+"), lambda word: word != "")
    return table(spark, sf_dir, "documents").select(json_field(words).alias("keywords"))


@query("keyword_top100", KEYWORDS_SQL)
def _(spark, sf_dir):
    return keyword_top100(document_films(spark, sf_dir)).select("id", "keyword", "count")


@query("keyword_top100_sketch", KEYWORDS_SQL)
def _(spark, sf_dir):
    return keyword_top100(document_films(spark, sf_dir), sketch=True).select("id", "keyword", "count")


@query(
    "share_of_total",
    f"""SELECT runtime, count, count * CAST(100 AS DOUBLE) / sum(count) OVER () AS share
        FROM ({HISTOGRAM_SQL})""",
)
def _(spark, sf_dir):
    return share_of_total(nonzero_counts(runtimes(spark, sf_dir), "runtime", MIN_LINES))


@query(
    "share_labels",
    f"""
    SELECT runtime, count, CAST(CAST(whole + CASE WHEN place <= 10000 - sum(whole) OVER () THEN 1 ELSE 0 END AS DECIMAL(18, 0))
                                / 100 AS DECIMAL(18, 2)) || '' AS label
    FROM (SELECT runtime, count, 10000 * count // total AS whole,
                 row_number() OVER (ORDER BY 10000 * count % total DESC, runtime) AS place
          FROM (SELECT *, sum(count) OVER () AS total FROM ({HISTOGRAM_SQL})))
    """,
)
def _(spark, sf_dir):
    """The percentages that a chart prints; they add up to 100.00."""
    return share_labels(nonzero_counts(runtimes(spark, sf_dir), "runtime", MIN_LINES), "runtime")


@query("preview", "SELECT p_partkey, p_name, p_size FROM part ORDER BY p_partkey LIMIT 20")
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return preview(rows.orderBy("p_partkey"))
