from reelframe.sinks.csv import write_csv
from reelframe.sinks.keyed import KeyedTable, bulk_replace_sorted

__all__ = ["KeyedTable", "bulk_replace_sorted", "write_csv"]
