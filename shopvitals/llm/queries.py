"""The registered queries of this folder, each an operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopvitals.llm import (
    byte_bpe, collocations, html_main, importance, line_dedup, merkle, mixing, pii, secret_scan, simhash, toxicity,
    vector_join, warc,
)

RANKS = "byte_bpe_multi_50k.tiktoken"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_document_fingerprints(spark, sf_dir):
    return merkle.fingerprint_edits(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark, sf_dir):
    return html_main.extract(table(spark, sf_dir, "pages"))


def op3_toxicity(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = toxicity.learn(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents.select("doc_id", "text"), model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted",
        "worst_score", "worst_start", "worst_end",
    )


def op4_line_dedup(spark, sf_dir):
    return line_dedup.without_boilerplate(table(spark, sf_dir, "documents"), "source").select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"), F.length("text").cast("long").alias("kept_chars"),
    )


def op5_pii(spark, sf_dir):
    return pii.find(table(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark, sf_dir):
    return simhash.classes(table(spark, sf_dir, "documents"))


def op7_mixing(spark, sf_dir):
    taken = mixing.copies(table(spark, sf_dir, "documents"))
    return taken.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"
    )


def op8_warc(spark, sf_dir):
    return warc.archive_and_read(table(spark, sf_dir, "pages"))


def op9_embedding_near_dedup(spark, sf_dir):
    return vector_join.classes(table(spark, sf_dir, "embeddings"))


def op10_byte_bpe(spark, sf_dir):
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark, sf_dir):
    drawn = importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_secret_scan(spark, sf_dir):
    return secret_scan.find(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_document_fingerprints, op2_html_extraction, op3_toxicity, op4_line_dedup, op5_pii, op6_simhash_near_dedup,
        op7_mixing, op8_warc, op9_embedding_near_dedup, op10_byte_bpe,
        op11_collocations, op12_importance_resampling, op13_secret_scan,
    )
}
