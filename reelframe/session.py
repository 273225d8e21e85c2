"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "zstd",
}

MEBIBYTE = 2**20
SHUFFLE_PART = 256 * MEBIBYTE
#: Shuffle partitions to start from where the caller names no number; small ones are merged.
FIRST_PARTS = 4096

_prepared: set[str] = set()
_scopes: list[list[str]] = []
_own_folders: dict[str, str] = {}


def build_session(app_name: str = "reelframe", **conf: str) -> SparkSession:
    """A session with this library's defaults; the master is left to spark-submit.

    Adaptive execution merges small shuffle partitions but does not split large ones. So,
    unless the caller sets a number, shuffles start from many partitions and are merged down.
    """
    settings = {**DEFAULTS, **conf}
    if "spark.sql.shuffle.partitions" not in settings:
        settings.setdefault("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(FIRST_PARTS))
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(shuffled_bytes: int) -> dict[str, str]:
    """Settings for the largest shuffle a job makes, to be passed to ``build_session``.

    Parts of one size, however large the shuffle: they fit in memory while they are sorted.
    """
    parts = max(-(-shuffled_bytes // SHUFFLE_PART), 200)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_PART),
        "spark.sql.files.maxPartitionBytes": str(SHUFFLE_PART),
    }


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Every executor must be able to read what another one wrote there. Where it is not set, a
    session whose executors are threads of the driver, as in tests, gets a folder of its own;
    any other master is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="reelframe-")
    return _own_folders[application]


def _locate(spark: SparkSession, path: str):
    """The file system that holds a path, and the path as it knows it."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the shared folder.

    Tables written there are read lazily by the frames built on them, so they are kept until
    the innermost ``scratch_scope`` ends, or else until the driver does.
    """
    folder = f"{shared_folder(spark)}/reelframe-{spark.sparkContext.applicationId}"
    if folder not in _prepared:
        files, location = _locate(spark, folder)
        files.mkdirs(location)
        files.deleteOnExit(location)
        _prepared.add(folder)
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def scratch_table(spark: SparkSession, label: str) -> str:
    """A new, unused name for a table or view of the catalog, in a database below the scratch folder."""
    database = "reelframe_" + re.sub(r"\W", "_", spark.sparkContext.applicationId)
    if not spark.catalog.databaseExists(database):
        folder = scratch_path(spark, "tables")
        if _scopes:
            _scopes[-1].remove(folder)
        spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}'")
    return f"{database}.{label}_{uuid.uuid4().hex}"


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, every scratch table made inside.

    For long sessions: frames built on such tables must be used or written before.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            drop_scratch(spark, path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a path made by ``scratch_path`` that no frame will read again."""
    files, location = _locate(spark, path)
    files.delete(location, True)
