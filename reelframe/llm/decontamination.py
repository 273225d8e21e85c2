"""Benchmark decontamination: MinHash containment search by size, verified on exact shingles.

An item is in a document if at least ``PERCENT`` of the item's distinct shingles are. Items are
partitioned by the number of their shingles. In a partition whose largest item has n shingles, an
item's sketch is its k = n - ceil(PERCENT n) + 1 least shingle hashes: a document that holds
enough of the item must hold one of them, as it lacks fewer than k. So looking the sketches up
in the documents' shingles misses no item, however long the document, and the sketches stay
short where items are short. Documents with fewer shingles than an item needs are left out.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.llm.workers import broadcast_if_small, stored

PERCENT = 80
SHINGLE = 5


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case, so that marks and line breaks don't matter."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def shingles(text: Column) -> Column:
    """The distinct hashes of all runs of five words; of the whole text if it has fewer."""

    def runs(hashes: Column) -> Column:
        size = F.size(hashes)
        places = F.sequence(F.lit(0), size - SHINGLE)
        whole = F.array(F.xxhash64(hashes))
        several = F.transform(places, lambda i: F.xxhash64(*(F.get(hashes, i + j) for j in range(SHINGLE))))
        return F.when(size >= SHINGLE, several).when(size > 0, whole).otherwise(F.array().cast("array<long>"))

    one = F.transform(F.array(F.transform(words(text), lambda w: F.xxhash64(w))), runs)
    return F.array_distinct(F.get(one, F.lit(0)))


def items_of(benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(item_id, n, h, k): each item's shingles, and the size of the sketch in its partition.

    A partition holds the items whose number of shingles has the same bit length. Items without
    a word are left out.
    """
    items = benchmark.select(F.col("item_id").cast("long"), shingles(F.col("text")).alias("h"))
    items = items.withColumn("n", F.size("h")).where("n > 0")
    largest = f"least(n * 2, (shiftleft(1, cast(floor(log2(n)) as int) + 1) - 1))"
    return items.withColumn("k", F.expr(f"least(n, {largest} - ({percent} * {largest} + 99) div 100 + 1)"))


def contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment) of documents that hold an item.

    One row for each doc_id and item_id; a doc_id that repeats counts as held if one of its texts
    holds the item, and rows without doc_id or item_id are reported under null. Null and empty
    texts hold nothing; an item of fewer than five words is held only by a text that is the same.
    Other columns are ignored, whatever their names.
    """
    items = stored(items_of(benchmark, percent), "items")
    sketches = items.select("item_id", "n", F.explode(F.slice(F.array_sort("h"), F.lit(1), F.col("k"))).alias("e"))
    sketches = stored(sketches.groupBy("e").agg(F.min("n").alias("least")), "sketches")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    elements = texts.select("doc_id", shingles(F.col("text")).alias("h")).select("doc_id", F.size("h").alias("size"), F.explode("h").alias("e"))
    large_enough = 100 * F.col("size") >= percent * F.col("least")
    proposed = elements.join(broadcast_if_small(sketches), "e").where(large_enough).select("doc_id").distinct()
    proposed = broadcast_if_small(stored(proposed, "proposed"))
    suspects = texts.join(proposed, texts["doc_id"].eqNullSafe(proposed["doc_id"]), "left_semi")
    listed = items.select("item_id", "n", F.explode("h").alias("e"))
    listed = broadcast_if_small(stored(listed, "listed"))
    whole = suspects.select("doc_id", F.xxhash64("text").alias("copy"), F.explode(shingles(F.col("text"))).alias("e"))
    shared = whole.join(listed, "e").groupBy("doc_id", "copy", "item_id", "n").agg(F.count_distinct("e").alias("n_shared"))
    held = shared.where(100 * F.col("n_shared") >= percent * F.col("n"))
    best = held.groupBy("doc_id", "item_id", F.col("n").cast("long").alias("n_item")).agg(F.max("n_shared").alias("n_shared"))
    return best.select("doc_id", "item_id", "n_shared", "n_item", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, all columns, that hold no item of the benchmark."""
    found = stored(contaminated(docs, benchmark, percent).select(F.col("doc_id").alias("held_by")).distinct(), "contaminated")
    found = broadcast_if_small(found)
    return docs.join(found, docs["doc_id"].cast("long").eqNullSafe(found["held_by"]), "left_anti")
