"""Helpers shared by the operators: Arrow tasks, shared tables, size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.session import scratch_path

#: Rows that one Arrow batch handed back to Spark holds, so that lists per row stay small in a task.
ROWS_PER_BATCH = 256
#: Rows of at most a few numbers each that may be broadcast; larger tables are shuffled.
MOST_BROADCAST_ROWS = 2_000_000

PACKAGE_ROOT = str(Path(__file__).resolve().parents[2])


#: Settings of the allocators in Python workers: large arrays, such as those of one very long text, go
#: back to the system when they are freed, instead of staying with a worker that is used again.
ALLOCATION = {
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(2**20),
    "MALLOC_TRIM_THRESHOLD_": str(2**20),
    "ARROW_DEFAULT_MEMORY_POOL": "system",
}


def reach_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it, and keep them small.

    On a cluster where it is installed or shipped with ``--py-files`` the extra path does no harm.
    Settings that the session has already are left as they are.
    """
    environment = spark.sparkContext.environment
    for name, value in ALLOCATION.items():
        environment.setdefault(name, value)
    known = environment.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in known.split(":"):
        environment["PYTHONPATH"] = f"{known}:{PACKAGE_ROOT}".lstrip(":")


def map_rows(frame: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """Run ``task`` on the Arrow batches of each partition; it yields dicts of columns."""
    spark = frame.sparkSession
    reach_package(spark)
    arrow_schema = arrow_of(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in task(small(batches)):
            yield pa.RecordBatch.from_pydict(columns, schema=arrow_schema)

    return frame.mapInArrow(run, schema)


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_PER_BATCH):
            yield batch.slice(start, ROWS_PER_BATCH)


def arrow_of(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it back: its lineage ends there."""
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def broadcast_if_small(frame: DataFrame, rows: int | None = None) -> DataFrame:
    """Mark a stored frame of narrow rows for broadcasting if its counted size allows."""
    rows = frame.count() if rows is None else rows
    return F.broadcast(frame) if rows <= MOST_BROADCAST_ROWS else frame
