from reelframe.streaming.counts import (
    count_events,
    stream_files,
    utc_timestamp,
    write_counts,
)

__all__ = ["count_events", "stream_files", "utc_timestamp", "write_counts"]
