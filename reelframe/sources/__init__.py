from reelframe.sources.csv_lines import (
    fields_to_wide,
    header_fields,
    named_fields,
    read_lines,
    scan_csv,
    scrub_lines,
    short_lines,
    split_lines,
    torn_line,
)
from reelframe.sources.csv_records import read_records
from reelframe.sources.inline import inline_rows
from reelframe.sources.keyed import cells_by_qualifier, key_range, keyed_scan, row_count

__all__ = [
    "cells_by_qualifier",
    "fields_to_wide",
    "header_fields",
    "inline_rows",
    "key_range",
    "keyed_scan",
    "named_fields",
    "read_lines",
    "read_records",
    "row_count",
    "scan_csv",
    "scrub_lines",
    "short_lines",
    "split_lines",
    "torn_line",
]
