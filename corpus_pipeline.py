"""From raw documents to token ids: five filters and rewrites, each over all that the last one kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.llm import bpe, decontamination, langid, neardup, pii
from reelframe.session import scratch_path

#: Documents of which the network takes a larger share to be in no learned language are rejected.
MOST_STRANGE = 0.6
#: Jaccard similarity of whole sets of 5-word shingles, in percent, from which documents are near copies.
NEAR_PERCENT = 80


#: Rows in a batch that goes to Python or comes back. Rows are whole texts here, so Spark's own number
#: of rows makes batches of tens of megabytes, a few of them for each task at a time.
BATCH_ROWS = 1_000
#: Bytes of a row group in what a stage writes. A task's writer holds its row group until it is full,
#: and token ids fill one much faster than texts, so the default of 128 MB grew with the input.
ROW_GROUP_BYTES = 16 * 1024 * 1024


def batches_of_texts(spark: SparkSession) -> None:
    """Set the session's batches to ``BATCH_ROWS`` rows, unless they are smaller."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, str(min(BATCH_ROWS, int(spark.conf.get(setting)))))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters and those of no learned language."""
    batches_of_texts(spark)
    return langid.accepted(docs, langid.fit(docs, rejecting=True), MOST_STRANGE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    batches_of_texts(spark)
    return neardup.deduplicated(docs, NEAR_PERCENT)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts."""
    return pii.redact(docs, pii.fit(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with digests of the ids and of what they decode to."""
    batches_of_texts(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN)
    return encoded.select("doc_id", "ids", *bpe.digests())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("redact", redact),
    ("tokenize", tokenize),
]

#: A trained network, trees and a tokenizer are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def written(frame: DataFrame, path: str) -> None:
    """Write what a stage keeps in row groups of at most ``ROW_GROUP_BYTES``."""
    frame.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what each one keeps is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        written(stage(spark, docs, sf_dir), path)
        docs = spark.read.parquet(path)
    return docs
