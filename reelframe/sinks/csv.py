"""CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows with a header per file; blanks stay blank, quotes are doubled, spaces are kept."""
    (
        rows.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
