"""A corpus from documents to tokens in five stages, each written and read again by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shopvitals.llm import byte_bpe, line_dedup, mixing, near_copies, toxicity
from shopvitals.llm.queries import RANKS, table
from shopvitals.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Below the share that a repeated line reaches on a source, so that it goes from all sources alike.
BOILERPLATE = 0.05


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; the model learns from the labels that are not held out."""
    docs = docs.select(*COLUMNS)
    return toxicity.without_toxic(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that are boilerplate of their source; n_chars follows the text."""
    from pyspark.sql import functions as F

    kept = line_dedup.without_boilerplate(docs.select(*COLUMNS), "source", BOILERPLATE)
    n_chars = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_copies.without_near_copies(docs.select(*COLUMNS))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' target weights take them, no more than three times."""
    return mixing.mixed(docs.select(*COLUMNS))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document of the mix."""
    return byte_bpe.digests(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("near_dedup", drop_near_copies),
    ("mixing", mix),
    ("byte_bpe", tokenize),
]

#: Learned weights, fingerprint hashes and random rounding have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
