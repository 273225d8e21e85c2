"""The numbered operators over their whole tables, with the digests their results are held by."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.llm import bpe, centroids, collocations, decontamination, fingerprints, htmltext, langid, licenses, neardup, pieces, pii, substrings, toxicity

LLM_QUERIES = {}
LLM_ORACLES = {}


def query(function):
    LLM_QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_decode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return encoded.select("doc_id", *bpe.digests())


@query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    counts = [
        F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")  # noqa: B023
        for rank, kind in enumerate(pii.BASE)
    ]
    names = pii.span_names(F.col("base"))
    return found.select("doc_id", *counts, F.sha2(names, 256).alias("base_sha256"), pii.span_names(F.col("spans")).alias("spans"))


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = langid.fit(docs.where(~langid.held_out(4, 2)))
    found = langid.identify(docs, network)
    return found.select("doc_id", langid.held_out(4, 2).alias("held_out"), "lang_pred", "score")


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = toxicity.fit(docs, labels.where(~toxicity.held_out(5, 0)))
    found = toxicity.score(docs, machine)
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return found.select("doc_id", toxicity.held_out(5, 0).alias("held_out"), "score", predicted)


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = htmltext.extract(pages, htmltext.fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.with_next(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = licenses.scan(docs, licenses.Index(licenses.document_counts(docs)))
    joined = {name: F.concat_ws(",", name) for name in ("base_labels", "labels")}
    return found.withColumns(joined)


@query
def op10_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(table(spark, sf_dir, "documents"))


@query
def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode_decode(table(spark, sf_dir, "documents"), model).select("doc_id", *pieces.digests())


@query
def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return centroids.cluster(vectors, centroids.fit(vectors))


LLM_ORACLES["op11_centroids"] = centroids.as_sql()


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


LLM_ORACLES["op12_collocations"] = collocations.as_sql()
