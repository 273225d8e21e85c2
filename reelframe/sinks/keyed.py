"""Keyed tables in the session's catalog, on ordinary Parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.operators.cells import latest_rows
from reelframe.schema import ROW_KEY
from reelframe.session import drop_scratch, scratch_path

#: Upserts after which the table is written as a whole again, so that a scan reads few tables.
MOST_LAYERS = 8
#: Keys in one pushed filter: Spark pushes longer lists as a range.
KEYS_A_FILTER = 10


def bulk_replace_sorted(rows: DataFrame, path: str, keys: tuple[str, ...] = (ROW_KEY,)) -> None:
    """Replace the files at ``path`` by files that follow each other in key order.

    Rows with equal keys may spread over neighbouring files, by a hash of their values, so a
    hot key does not end up in one task.
    """
    (
        rows.repartitionByRange(*keys, F.xxhash64(*rows.columns))
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .parquet(path)
    )


@dataclass(frozen=True)
class KeyedTable:
    """One row per key, by a view of the catalog named ``name``.

    Rows stand in Parquet tables partitioned by a hash of the key and sorted by it within each
    file, with bloom filters on it. A write makes a table of the partitions that it changes; the
    version of the rows is that table and, for all other partitions, the version before. At last
    the view is replaced by one of the new version, a single change in the catalog. So a reader has
    the rows from before a write or after it, never a mix, and so does one after a lost driver. The
    two last versions are kept.

    The catalog must outlive the session where tables are to: with a Hive metastore, say. There is
    one writer at a time. ``buckets`` is fixed for the life of the table; another number is refused.
    Choose it so that one partition is a fair unit of rewriting: at 100 TB, some ten thousand.
    """

    name: str
    key: str = ROW_KEY
    buckets: int = 16

    @property
    def bucket(self) -> str:
        return f"key_bucket_of_{self.buckets}"

    def _place(self, key: str | None = None) -> Column:
        return F.pmod(F.xxhash64(key or self.key), F.lit(self.buckets)).cast("int")

    def versions(self, spark: SparkSession) -> list[str]:
        """Names of the versions that are kept, the current one last; none without a table. A version
        whose name ends with ``whole`` does not build on the one before."""
        if not spark.catalog.tableExists(self.name):
            return []
        facts = dict(spark.sql(f"SHOW TBLPROPERTIES {self.name}").collect())
        if facts.get("buckets") != str(self.buckets):
            raise ValueError(f"{self.name} was not written with {self.buckets} buckets")
        return facts["versions"].split(",")

    def scan(self, spark: SparkSession, ordered: bool = False) -> DataFrame:
        """All rows as they are now; writes to come do not change the frame."""
        rows = self._rows(spark).drop(self.bucket)
        return rows.orderBy(self.key) if ordered else rows

    def _rows(self, spark: SparkSession) -> DataFrame:
        versions = self.versions(spark)
        if not versions:
            raise FileNotFoundError(self.name)
        return spark.table(f"{self.name}__{versions[-1]}")

    def lookup(self, spark: SparkSession, start, stop) -> DataFrame:
        """Rows with ``start <= key < stop``; files are sorted, so few row groups are read."""
        return self.scan(spark).filter((F.col(self.key) >= start) & (F.col(self.key) < stop))

    def pick(self, spark: SparkSession, keys: Sequence) -> DataFrame:
        """Rows of single keys, anywhere in the table: only their partitions are opened, and of those
        only row groups whose bloom filter has one of the keys. For lists of some thousands."""
        rows = self._rows(spark)
        kind = rows.schema[self.key].dataType
        wanted = spark.createDataFrame([(key,) for key in dict.fromkeys(keys)], "key " + kind.simpleString())
        placed = wanted.select("key", self._place("key").alias("bucket")).collect()
        if not placed:
            return rows.limit(0).drop(self.bucket)
        chunks = [placed[i : i + KEYS_A_FILTER] for i in range(0, len(placed), KEYS_A_FILTER)]
        named = reduce(or_, [F.col(self.key).isin([row.key for row in chunk]) for chunk in chunks])
        return rows.where(F.col(self.bucket).isin(sorted({row.bucket for row in placed})) & named).drop(self.bucket)

    def replace(self, rows: DataFrame) -> None:
        """Make these rows the whole table; keys that it lacks are gone, nulls are nulls.

        Each key occurs once, or the write fails and the table stays as it was. ``rows`` is
        evaluated once.
        """
        self._write(rows.sparkSession, rows, None, checked=False)

    def upsert(self, changes: DataFrame, version: str | None = None) -> None:
        """Write changes cell by cell; the last write wins.

        ``version`` names the column that orders changes of one key; without it each key
        occurs once, or the write fails and the table stays as it was.

        A null is a cell that is not written: it keeps its old value, as do columns that
        ``changes`` lacks. A new column makes the table be written as a whole. Changes of one key are
        first reduced to one row, before the shuffle, so a key with very many changes is not
        gathered in one task. Partitions without a changed key are neither read nor written, but
        for every ``MOST_LAYERS``-th write. ``changes`` is evaluated once.
        """
        spark = changes.sparkSession
        latest = latest_rows(changes, self.key, version) if version else changes
        versions = self.versions(spark)
        if not versions:
            self._write(spark, latest, None, checked=version is not None)
            return
        staged_path = scratch_path(spark, "upsert")
        placed = latest.withColumn(self.bucket, self._place())
        placed.write.parquet(staged_path)
        staged = spark.read.schema(placed.schema).parquet(staged_path)
        old = self._rows(spark)
        self._check_types(old, staged)
        # At most ``buckets`` numbers; they choose the partitions to read.
        touched = sorted(row[0] for row in staged.select(self.bucket).distinct().collect())
        if touched:
            layers = next(i for i, name in enumerate(reversed(versions)) if name.endswith("whole"))
            if set(staged.columns) - set(old.columns) or layers + 1 >= MOST_LAYERS:
                touched = None
            kept = old if touched is None else old.where(F.col(self.bucket).isin(touched))
            self._write(spark, self._merge(kept, staged).drop(self.bucket), touched, checked=True)
        drop_scratch(spark, staged_path)

    def _write(self, spark: SparkSession, rows: DataFrame, touched: list[int] | None, checked: bool) -> None:
        """Write a version, make sure of its keys, and make the view show it. Without ``touched``
        the rows are all there is; else those of these partitions."""
        versions = self.versions(spark)
        label = f"{uuid.uuid4().hex[:12]}_{'part' if touched else 'whole'}"
        version, table = f"{self.name}__{label}", f"{self.name}__{label}_rows"
        # Rebalancing splits large partitions over tasks and needs no second look at the rows.
        placed = rows.withColumn(self.bucket, self._place()).hint("rebalance", F.col(self.bucket))
        writer = placed.sortWithinPartitions(self.bucket, self.key).write.partitionBy(self.bucket)
        # Keys are unique: a dictionary of them saves nothing, and would take the place of the filter.
        options = {"enable.dictionary": "false", "bloom.filter.enabled": "true", "bloom.filter.adaptive.enabled": "true"}
        for option, value in options.items():
            writer = writer.option(f"parquet.{option}#{self.key}", value)
        writer.saveAsTable(table)
        if not checked:
            twice = spark.table(table).groupBy(self.key).count().filter("count > 1").take(1)
            if twice:
                spark.sql(f"DROP TABLE {table}")
                raise ValueError(f"key {twice[0][0]!r} occurs more than once in the rows for {self.name}")
        columns = ", ".join(f"`{column}`" for column in placed.columns)
        below = ""
        if touched:
            numbers = ", ".join(map(str, touched))
            below = f" UNION ALL SELECT {columns} FROM {self.name}__{versions[-1]} WHERE {self.bucket} NOT IN ({numbers})"
        spark.sql(f"CREATE VIEW {version} AS SELECT {columns} FROM {table}{below}")
        kept, gone = self._outlived([*versions, label])
        self._show(spark, version, kept, rows.columns)
        for old in gone:
            spark.sql(f"DROP VIEW {self.name}__{old}")
            spark.sql(f"DROP TABLE {self.name}__{old}_rows")

    def _show(self, spark: SparkSession, version: str, versions: list[str], columns: list[str]) -> None:
        """Make the view show a version: the one step by which a write takes effect."""
        facts = f"'buckets' = '{self.buckets}', 'versions' = '{','.join(versions)}'"
        listed = ", ".join(f"`{column}`" for column in columns)
        spark.sql(f"CREATE OR REPLACE VIEW {self.name} TBLPROPERTIES ({facts}) AS SELECT {listed} FROM {version}")

    @staticmethod
    def _outlived(versions: list[str]) -> tuple[list[str], list[str]]:
        """Versions to keep, and those that neither the last one nor the one before builds on."""
        wholes = [i for i, name in enumerate(versions[:-1]) if name.endswith("whole")]
        first = wholes[-1] if wholes else 0
        return versions[first:], versions[:first]

    def _check_types(self, old: DataFrame, staged: DataFrame) -> None:
        types = {f.name: f.dataType for f in old.schema.fields}
        differing = [f.name for f in staged.schema.fields if types.get(f.name, f.dataType) != f.dataType]
        if differing:
            raise ValueError(f"types differ from those of {self.name}: {differing}")

    def _merge(self, old: DataFrame, staged: DataFrame) -> DataFrame:
        """At most two rows per key, an old and a new one; more than one new row is refused."""
        rank = "_written"
        both = old.withColumn(rank, F.lit(0)).unionByName(
            staged.withColumn(rank, F.lit(1)), allowMissingColumns=True
        )
        columns = [c for c in both.columns if c not in (self.bucket, self.key, rank)]
        message = F.concat(F.lit("key occurs more than once: "), F.col(self.key).cast("string"))
        merged = both.groupBy(self.bucket, self.key).agg(
            F.sum(rank).alias(rank),
            *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(rank))).alias(c) for c in columns],
        )
        once = F.when(F.col(rank) > 1, F.raise_error(message)).otherwise(F.col(self.key))
        return merged.select(self.bucket, once.alias(self.key), *columns)
