"""Running counts of log events per day and type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelframe.sinks import KeyedTable

SECONDS_PER_DAY = 86400


def utc_timestamp(column: str) -> Column:
    """A zone-less UTC time as an instant, whatever the session's zone."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(column))
    return local.cast("timestamp")


def stream_files(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files as a stream, a bounded number per micro-batch."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def count_events(
    events: DataFrame, time: str, kind: str, lateness: str | None = None, event_id: str | None = None
) -> DataFrame:
    """Events per UTC day and type, however the input is split into micro-batches.

    Rows are counted per task before the shuffle, so a frequent type is no hot spot, and the
    state is one number per day and type. ``lateness`` is for streams that never end: days
    that old, by the newest time seen, are closed, and rows for them are no longer counted.

    With ``event_id`` an event that is sent again counts once: ids are kept in the state, spread over
    tasks by the id, until the watermark is ``lateness`` past the event. So that many rows of time
    bound the state, and an event repeated later than that, by event time, counts again. Events
    without an id count each.
    """
    columns = [kind, event_id] if event_id else [kind]
    timed = events.select(utc_timestamp(time).alias("_at"), *columns)
    open_days = timed.withWatermark("_at", lateness) if lateness else timed
    if event_id:
        if not lateness:
            raise ValueError("repeated events are told by id within a lateness: name one")
        # No id is no repeat of another: such rows get an id of their own.
        own = F.coalesce(F.concat(F.lit("="), F.col(event_id).cast("string")), F.uuid())
        open_days = open_days.withColumn(event_id, own).dropDuplicatesWithinWatermark([event_id])
    counts = open_days.groupBy(F.window("_at", "1 day"), kind).agg(F.count(F.lit(1)).alias("count"))
    day = F.date_from_unix_date((F.unix_seconds("window.start") / SECONDS_PER_DAY).cast("int"))
    return counts.select(day.alias("day"), kind, "count")


def write_counts(
    counts: DataFrame, table: KeyedTable, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Put changed counts into a keyed table after each micro-batch.

    Runs on with a micro-batch ``every`` so often ("1 minute"), or else ends when all there
    is has been read.
    Each count replaces the one before, so a micro-batch that is run again counts nothing
    twice, and the table does not grow with the number of micro-batches.
    """
    keyed = counts.withColumn(table.key, F.concat_ws("/", *counts.columns[:2]))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch)

    writer = keyed.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    paced = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return paced.foreachBatch(write_batch).start()
