"""CSV records whose quoted fields may hold line breaks, from files that split across tasks anywhere.

A line break ends a record if the number of quotes before it in the file is even. So:

1. every split counts the quotes of its own lines;
2. a prefix sum over the splits of a file tells for each one whether it begins inside a record;
3. every split cuts its lines into records from there on, and what it has of a record that began
   in an earlier split, or goes on in the next, is put together in a shuffle of such pieces alone.

Lines are cut at ``\\n`` and a ``\\r`` before the end of a record is left out; within a field both stay.
Quotes stand around whole fields and are doubled inside them, as CSV writers put them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from reelframe.session import scratch_path

#: Splits whose states are sent to all tasks: one row of a path and three numbers for each.
MOST_SPLITS = 2_000_000

PIECES = "file string, start long, line long, owner long, piece binary"


def quoted_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, piece): the lines, as bytes, of each split, by where it starts in its file."""
    lines = spark.read.option("lineSep", "\n").text(path)
    split = {"file": F.col("_metadata.file_path"), "start": F.col("_metadata.file_block_start")}
    return lines.select(*[column.alias(name) for name, column in split.items()], F.col("value").cast("binary").alias("piece"))


def split_states(lines: DataFrame) -> DataFrame:
    """(file, start, inside, opens, owner) of each split: whether it begins inside a record, whether
    a record that begins in it goes on in the next, and the split in which the one it is inside of began."""
    text = F.col("piece").cast("string")
    odd = (F.octet_length(text) - F.octet_length(F.replace(text, F.lit('"'), F.lit("")))) % 2
    counts = lines.groupBy("file", "start").agg((F.sum(odd) % 2).alias("odd"), F.max(odd).alias("any"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("inside")
    states = counts.select("*", inside)
    opens = ((F.col("inside") + F.col("odd")) % 2 == 1) & ((F.col("inside") == 0) | (F.col("any") == 1))
    states = states.withColumn("opens", opens)
    owner = F.last(F.when(F.col("opens"), F.col("start")), ignorenulls=True).over(earlier)
    return states.select("file", "start", (F.col("inside") == 1).alias("inside"), "opens", owner.alias("owner"))


def cut_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (file, start, piece, inside, owner), in order within a split, as whole records, without
    an owner, and pieces of records, with the split in which the record began."""
    split, owner, open_lines, own, number = None, None, [], False, 0
    rows: list[tuple] = []

    def left_over() -> None:
        if open_lines:
            rows.append((*split, number - len(open_lines), split[1] if own else owner, b"\n".join(open_lines)))
            open_lines.clear()

    def taken() -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        batch = pa.RecordBatch.from_arrays(
            [pa.array(list(column), kind) for column, kind in zip(columns, kinds, strict=True)],
            names=["file", "start", "line", "owner", "piece"],
        )
        rows.clear()
        return batch

    for batch in batches:
        odd = np.asarray(pc.count_substring(batch.column("piece"), '"')) % 2
        table = batch.to_pydict()
        for file, start, line, inside, of, turns in zip(
            table["file"], table["start"], table["piece"], table["inside"], table["owner"], odd.tolist(), strict=True
        ):
            if (file, start) != split:
                left_over()
                split, owner, own, number = (file, start), of, not inside, 0
                going = inside
            number += 1
            if going:
                open_lines.append(line)
                if turns:
                    going = False
                    first = number - len(open_lines)
                    rows.append((file, start, first, None if own else owner, b"\n".join(open_lines)))
                    open_lines.clear()
                    own = True
            elif turns:
                going = True
                open_lines.append(line)
            else:
                rows.append((file, start, number - 1, None, line))
        yield taken()
    left_over()
    yield taken()


def read_records(spark: SparkSession, path: str, encoding: str = "UTF-8", place: str | None = None) -> DataFrame:
    """Records of CSV files as ``value STRING``, line breaks inside quotes kept, and with ``place``
    a column of that name which puts the records of a file in the order in which they stand.

    Files are read twice: once to count quotes, in generated code, and once to cut. Splits at whose
    ends a record is open are read a third time for the pieces there. No line is shuffled but
    those pieces. A record left open at the end of a file is returned as it stands, with an odd
    number of quotes.
    """
    lines = quoted_lines(spark, path)
    counted = scratch_path(spark, "splits")
    split_states(lines).write.parquet(counted)
    states = spark.read.parquet(counted)
    if states.count() > MOST_SPLITS:
        raise ValueError(f"more than {MOST_SPLITS} splits: set a larger spark.sql.files.maxPartitionBytes")
    at = ["file", "start"]

    def pieces(of: DataFrame) -> DataFrame:
        return lines.join(F.broadcast(of.select(*at, "inside", "owner")), at).mapInArrow(cut_records, PIECES)

    whole = pieces(states).where("owner is null").select(F.struct("file", "start", "line").alias("place"), "piece")
    ends = pieces(states.where("inside or opens")).where("owner is not null")
    parts = F.array_sort(F.collect_list(F.struct("start", "line", F.col("piece").cast("string").alias("text"))))
    torn = ends.groupBy("file", "owner").agg(parts.alias("parts"))
    head = F.struct("file", F.col("owner").alias("start"), F.col("parts")[0]["line"].alias("line"))
    mended = torn.select(head.alias("place"), F.array_join("parts.text", "\n").cast("binary").alias("piece"))
    size = F.octet_length("piece")
    ended = F.substring("piece", size, F.lit(1)) == F.lit(b"\r")
    record = F.when(ended, F.substring("piece", F.lit(1), size - 1)).otherwise(F.col("piece"))
    text = record.cast("string") if encoding.upper() == "UTF-8" else F.decode(record, encoding)
    return whole.union(mended).select(text.alias("value"), *([F.col("place").alias(place)] if place else []))
