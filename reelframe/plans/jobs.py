"""The batch jobs, from raw CSV to result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelframe.functions import json_names, to_float, to_int, unquote_field
from reelframe.operators import (
    cast_floats,
    descending,
    exploded,
    exploded_counts,
    fit_metrics,
    fit_scores,
    frequent,
    label_split,
    latest_rows,
    model_inputs,
    runtime_histogram,
    score_fill,
    top_counts,
    top_k,
)
from reelframe.schema import (
    MOVIE_COLUMNS,
    ROW_KEY,
    SCORE_FEATURES,
    SCORE_LABEL,
    TOP_TITLES,
    VERSION,
)
from reelframe.session import scratch_path, scratch_scope
from reelframe.sinks import KeyedTable, write_csv
from reelframe.sources import (
    header_fields,
    named_fields,
    read_records,
    scrub_lines,
    split_lines,
    torn_line,
)


def scrub_job(spark: SparkSession, raw_path: str, csv_path: str, rejects_path: str | None = None) -> None:
    """Raw ISO-8859-1 CSV to clean CSV, without header lines; fields may hold line breaks.

    A record left open at the end of a file has an odd number of quotes. It fails the job, unless a
    place for such records is given.
    """
    with scratch_scope(spark):
        records = read_records(spark, raw_path, "ISO-8859-1")
        if rejects_path is None:
            write_csv(scrub_lines(records, torn="fail"), csv_path)
            return
        told = _staged(records.withColumn("_torn", torn_line("value")), "_torn")
        told.filter("_torn").select("value").write.text(rejects_path)
        write_csv(scrub_lines(told.filter("not _torn").select("value")), csv_path)


def load_job(spark: SparkSession, csv_path: str, movies: KeyedTable, rejects_path: str | None = None) -> dict[str, int]:
    """Clean CSV into the film table; a later record of a file replaces an earlier one.

    Header lines are left out: those whose fields after the key are the column names. A record
    with too few fields fails the job, unless a place for such records is given; then rows and
    rejects come from one pass over the files. Returned are the numbers of records ``loaded``,
    ``rejected`` and found to be ``headers``, observed in the pass that writes the rows.
    """
    seen = Observation("load")
    with scratch_scope(spark):
        records = read_records(spark, csv_path, place=VERSION)
        split = split_lines(records, keep=["value", VERSION])
        kind = F.when(F.size("fields") < 1 + len(MOVIE_COLUMNS), "short").when(header_fields(F.col("fields")), "header")
        told = split.withColumn("_kind", F.coalesce(kind, F.lit("row")))
        numbers = {"loaded": "row", "rejected": "short", "headers": "header"}
        told = told.observe(seen, *[F.count_if(F.col("_kind") == what).alias(name) for name, what in numbers.items()])
        if rejects_path is None:
            message = F.concat(F.lit("too few fields: "), F.array_join("fields", ","))
            short = F.raise_error(message).cast("array<array<string>>")
            row = F.when(F.col("_kind") == "row", F.array("fields")).when(F.col("_kind") == "short", short)
            rows = named_fields(told.select(F.explode(row).alias("fields"), VERSION), keep=[VERSION])
        else:
            told = _staged(told, "_kind")
            told.filter("_kind = 'short'").select("value").write.text(rejects_path)
            rows = named_fields(told.filter("_kind = 'row'"), keep=[VERSION])
        movies.upsert(rows, VERSION)
    return seen.get


def _staged(rows: DataFrame, tag: str) -> DataFrame:
    """Rows written once, in a folder for each value of a tag, and read again."""
    path = scratch_path(rows.sparkSession, "tagged")
    rows.write.partitionBy(tag).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def popularity_top10(
    movies: DataFrame,
    title: str = "original_title",
    popularity: str = "popularity",
    key: str = ROW_KEY,
    k: int = TOP_TITLES,
) -> DataFrame:
    """The most popular titles, ranked from 0; ties by key."""
    typed = movies.select(
        key, F.col(title).alias("original_title"), to_float(popularity).alias("popularity")
    )
    return top_k(typed, descending("popularity", key), k).select(
        "id", "original_title", "popularity"
    )


def popularity_job(spark: SparkSession, movies: KeyedTable, result: KeyedTable) -> None:
    result.replace(popularity_top10(movies.scan(spark)))


def runtime_job(spark: SparkSession, movies: KeyedTable, result: KeyedTable) -> None:
    with scratch_scope(spark):
        result.replace(runtime_histogram(movies.scan(spark)).select("id", "runtime", "count"))


def genre_histogram(movies: DataFrame, column: str = "genres", name: str = "genre") -> DataFrame:
    """Films per genre, from JSON lists as they stand in the CSV file."""
    return exploded_counts(movies, json_names(unquote_field(column)), name)


def keyword_top100(movies: DataFrame, column: str = "keywords", name: str = "keyword", sketch: bool = False) -> DataFrame:
    """The most frequent keywords, ranked from 0; with ``sketch`` by a way for very many distinct ones."""
    if sketch:
        return frequent(exploded(movies, json_names(unquote_field(column)), name), name)
    return top_counts(genre_histogram(movies, column, name), name)


def score_inputs(movies: DataFrame) -> DataFrame:
    """Id as text, label and features as floats."""
    columns = [*SCORE_FEATURES, SCORE_LABEL]
    return cast_floats(movies.select(ROW_KEY, "id", *columns), columns)


def score_job(
    spark: SparkSession, movies: KeyedTable, result: KeyedTable, leak: bool = False
) -> DataFrame:
    """Scores by film id, missing ones predicted; returns the fit metrics.

    Films without a whole-number id cannot be stored by id and are left out of the result.
    """
    rows = score_inputs(movies.scan(spark))
    features = model_inputs(SCORE_FEATURES, SCORE_LABEL, leak)
    train, _ = label_split(rows, SCORE_LABEL)
    model = fit_scores(train, features, SCORE_LABEL, keys=["id"])
    scores = score_fill(rows, model, features, SCORE_LABEL, [ROW_KEY, "id"])
    numbered = scores.withColumn("id", to_int("id")).filter(F.col("id").isNotNull())
    result.replace(latest_rows(numbered, "id", ROW_KEY))
    return fit_metrics(train, model, features, SCORE_LABEL, keys=["id"])
