"""Chart feeds: fixed-length (productName, nums) tables in key order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.functions import float_to_long, title_head
from reelframe.operators import fixed_slots, share_of_total
from reelframe.schema import POPULARITY_SLOTS, RUNTIME_SLOTS


def popularity_chart(top: DataFrame, slots: int = POPULARITY_SLOTS) -> DataFrame:
    """Bar chart of a popularity table: short title and whole popularity by rank."""
    bars = top.select(
        "id",
        title_head("original_title").alias("productName"),
        float_to_long("popularity").alias("nums"),
    )
    return fixed_slots(bars, slots)


def runtime_chart(histogram: DataFrame, slots: int = RUNTIME_SLOTS, more: bool = False) -> DataFrame:
    """Pie chart of a running-time table, with each slice in percent of all.

    With ``more`` there are as many slices as groups if those are more than ``slots``.
    """
    slices = histogram.select(
        "id", F.col("runtime").alias("productName"), F.col("count").alias("nums")
    )
    return share_of_total(fixed_slots(slices, slots, more=more), "nums")
