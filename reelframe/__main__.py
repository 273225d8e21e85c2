"""The batch jobs from the command line: ``python -m reelframe JOB ...``, or this file to spark-submit.

    scrub RAW CLEAN [--rejects DIR]       raw ISO-8859-1 CSV to clean CSV
    load CLEAN TABLE [--rejects DIR]      clean CSV into the film table
    popularity FILMS RESULT               the most popular titles
    runtimes FILMS RESULT                 running times and how many films have them
    scores FILMS RESULT [--leak]          scores, missing ones predicted
    show TABLE [--rows N]                 the first rows of a table

Tables are names in the session's catalog. Only a catalog that outlives the session, such as a Hive
metastore (``--hive``), lets one job read what another one wrote.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from reelframe.plans import load_job, popularity_job, runtime_job, score_job, scrub_job
from reelframe.schema import PREVIEW_ROWS
from reelframe.session import build_session
from reelframe.sinks import KeyedTable


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="reelframe", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--buckets", type=int, default=16, help="partitions of the film table, and of scores")
    parser.add_argument("--hive", action="store_true", help="keep tables in a Hive metastore")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, places in {
        "scrub": ["raw", "clean"],
        "load": ["clean", "films"],
        "popularity": ["films", "result"],
        "runtimes": ["films", "result"],
        "scores": ["films", "result"],
        "show": ["table"],
    }.items():
        job = jobs.add_parser(name)
        for place in places:
            job.add_argument(place)
        if name in ("scrub", "load"):
            job.add_argument("--rejects")
        if name == "scores":
            job.add_argument("--leak", action="store_true")
        if name == "show":
            job.add_argument("--rows", type=int, default=PREVIEW_ROWS)
    return parser.parse_args(argv)


def run(spark: SparkSession, told: argparse.Namespace) -> None:
    if told.job == "scrub":
        scrub_job(spark, told.raw, told.clean, told.rejects)
    elif told.job == "load":
        seen = load_job(spark, told.clean, KeyedTable(told.films, buckets=told.buckets), told.rejects)
        print(", ".join(f"{number} {name}" for name, number in seen.items()))
    elif told.job == "show":
        spark.table(told.table).show(told.rows, truncate=False)
    else:
        films = KeyedTable(told.films, buckets=told.buckets)
        small = KeyedTable(told.result, key="id", buckets=1)
        if told.job == "popularity":
            popularity_job(spark, films, small)
        elif told.job == "runtimes":
            runtime_job(spark, films, small)
        else:
            score_job(spark, films, KeyedTable(told.result, key="id", buckets=told.buckets), told.leak).show()


def main(argv: Sequence[str] | None = None) -> None:
    told = arguments(argv)
    conf = {"spark.sql.catalogImplementation": "hive"} if told.hive else {}
    run(build_session(f"reelframe {told.job}", **conf), told)


if __name__ == "__main__":
    main()
