"""Near duplicates by circulant MinHash, banding and exact Jaccard verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.llm.linking import crowded, link
from reelframe.llm.shingles import band_keys, circulant, shingle_hashes, word_hashes, words_of
from reelframe.llm.workers import broadcast_if_small, map_rows, stored

PERCENT = 85
#: 36 bands of 6 coordinates: a pair at the threshold misses all bands once in 25 million, one
#: of similarity 0.80, which the pipeline asks for, twice in 100,000.
BANDS, ROWS = 36, 6

SIGNED = "doc_id long, n_shingles long, set_key binary, keys array<long>"
SETS = "id long, n int, h array<long>"


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct 5-word shingles of a whole text, as sorted 64-bit hashes."""
    return np.unique(shingle_hashes(word_hashes(words_of(text))))


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, keys): a digest of each whole set and its band keys."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            sets = [shingle_set(text) for text in batch.column(1).to_pylist()]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            keys = [band_keys(circulant(s, BANDS * ROWS), ROWS) if len(s) else np.zeros(0, np.int64) for s in sets]
            yield {"doc_id": batch.column(0), "n_shingles": [len(s) for s in sets], "set_key": digests, "keys": keys}

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), task, SIGNED)


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, n, h) of the documents whose ids are given."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            sets = [shingle_set(text) for text in batch.column(1).to_pylist()]
            yield {"id": batch.column(0), "n": [len(s) for s in sets], "h": [s.view(np.int64) for s in sets]}

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    return map_rows(texts.join(broadcast_if_small(ids), "id"), task, SETS)


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): the class of each document, one row per row.

    Documents with equal shingle sets are one class from the start; classes are linked if their
    whole sets have a Jaccard similarity of ``percent`` or more. ``component_id`` is the least
    doc_id of all that links reach. Null, empty and wordless texts are linked with nothing. Rows
    of one doc_id count as one document that has each of their texts. Rows without doc_id are
    linked with nothing, keep a null component, and are kept. Other columns are ignored,
    whatever their names.
    """
    signed = stored(signatures(docs), "signatures")
    usable = signed.where(F.col("doc_id").isNotNull() & F.col("set_key").isNotNull())
    classes = usable.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    first = usable.join(classes.withColumnRenamed("node", "doc_id"), ["set_key", "doc_id"])
    members = first.select(F.explode("keys").alias("key"), F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"))
    members = stored(crowded(members), "members")
    ids = stored(members.select("id").distinct(), "candidates")
    sets = stored(sets_of(docs, ids), "sets")
    found = link(members, sets, percent)
    placed = signed.join(classes, "set_key", "left").join(found.withColumnRenamed("id", "node"), "node", "left")
    reached = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id"))
    out = placed.select("doc_id", "n_shingles", reached.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents, all columns, without those of which another one of their class stays.

    The one with the least doc_id stays. Of rows that repeat a doc_id and a text one stays.
    """
    gone = stored(near_duplicates(docs, percent).where(~F.col("kept")).select("doc_id").distinct(), "gone")
    left = docs.join(broadcast_if_small(gone), "doc_id", "left_anti").select(docs.columns)
    repeated = docs.groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return left
    repeated = broadcast_if_small(stored(repeated, "repeated"))
    once = left.join(repeated, left["doc_id"].eqNullSafe(repeated["doc_id"]), "left_anti")
    twice = left.join(repeated, left["doc_id"].eqNullSafe(repeated["doc_id"]), "left_semi")
    return once.union(twice.dropDuplicates(["doc_id", "text"]))
