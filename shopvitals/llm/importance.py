"""Target-distribution importance resampling, with the corpus counted by distinct lines.

Features are hashed runs of words. A text is the lines between its newlines; most repeated text
repeats by lines, so the features of each distinct line are counted once and multiplied by how
often it occurs. Runs that cross a newline belong to no line and are added separately. A feature
bucket's gain is the logarithm of its share in the target over its share in the corpus; documents
are drawn by their mean gain with Gumbel noise, which is sampling without replacement.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from shopvitals.llm.common import shuffle_partitions, small_batches
from shopvitals.session import materialize

#: Longest runs of words, hash buckets, draws per hundred documents, words a drawn document needs, seed.
WORDS, BUCKETS, PERCENT, LEAST_WORDS, SEED = 1, 10_000, 10, 20, 2024
#: A-Z to a-z; what is neither an ASCII letter or digit nor beyond ASCII to a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: Bytes of a text that are cut into words at a time.
CHUNK = 1 << 20


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def chunks(text: bytes) -> Iterator[bytes]:
    """The text in parts that end between words."""
    folded, start = text.translate(FOLD), 0
    while len(folded) - start > CHUNK and (cut := folded.find(b" ", start + CHUNK)) > 0:
        yield folded[start:cut]
        start = cut
    yield folded[start:]


def hashed(runs, n_buckets: int) -> np.ndarray:
    return np.fromiter(map(crc32, runs), np.int64) % n_buckets


def features(words: list[bytes], longest: int, n_buckets: int) -> np.ndarray:
    """Buckets of all runs of 1 to ``longest`` words."""
    found = [hashed(words, n_buckets)]
    for n in range(2, longest + 1):
        found.append(hashed((b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)), n_buckets))
    return np.concatenate(found)


def crossing(lines: list[list[bytes]], longest: int, n_buckets: int) -> np.ndarray:
    """Buckets of the runs of up to ``longest`` words that hold words of more than one line."""
    words = [w for line in lines for w in line]
    ends = np.cumsum([len(line) for line in lines])
    line_of = np.repeat(np.arange(len(lines)), [len(line) for line in lines])
    runs = []
    for n in range(2, longest + 1):
        near = np.unique(np.concatenate([np.arange(max(0, e - n + 1), e) for e in ends[:-1]] or [np.array([], int)]))
        runs += [b" ".join(words[i : i + n]) for i in near if i + n <= len(words) and line_of[i] != line_of[i + n - 1]]
    return hashed(runs, n_buckets)


def bucket_counts(texts: DataFrame, longest: int = WORDS, n_buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket's features occur in all of ``texts`` (null ones have none).

    Lines are counted before they are shuffled, so a line that is everywhere is one row of each
    task. Every task adds up its lines and returns at most ``n_buckets`` numbers.
    """
    small_batches(texts.sparkSession)
    text = F.col("text").cast("string")
    lines = texts.select(F.explode(F.split(text, "\n", -1)).alias("line")).groupBy("line").agg(F.count("*").alias("n"))

    def sums(counts: np.ndarray) -> pd.DataFrame:
        some = np.flatnonzero(counts)
        return pd.DataFrame({"bucket": some, "n": counts[some]})

    def of_lines(batches):
        counts = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for line, n in zip(batch["line"], batch["n"]):
                if longest == 1:
                    for part in chunks(line):
                        np.add.at(counts, hashed(part.split(), n_buckets), n)
                else:
                    np.add.at(counts, features(words_of(line), longest, n_buckets), n)
        yield sums(counts)

    def of_crossings(batches):
        counts = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for whole in batch["text"]:
                np.add.at(counts, crossing([words_of(line) for line in whole.split(b"\n")], longest, n_buckets), 1)
        yield sums(counts)

    found = lines.select(F.col("line").cast("binary").alias("line"), "n").mapInPandas(of_lines, "bucket long, n long")
    if longest > 1:
        several = texts.where(F.instr(text, "\n") > 0).select(text.cast("binary").alias("text"))
        found = found.unionByName(several.mapInPandas(of_crossings, "bucket long, n long"))
    counts = np.zeros(n_buckets, np.int64)
    for row in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most n_buckets rows
        counts[row.bucket] = row.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the corpus."""
    n, every, wanted = len(corpus), float(int(corpus.sum())), float(int(target.sum()))
    return np.array(
        [math.floor(1000 * math.log((t + 1.0) * (every + n) / ((s + 1.0) * (wanted + n))))
         for s, t in zip(corpus.tolist(), target.tolist())], np.int64,
    )


def with_weight(documents: DataFrame, gain: np.ndarray, longest: int = WORDS) -> DataFrame:
    """doc_id, n_words, n_features and weight, the floored mean gain of a document's features (0 of none)."""
    small_batches(documents.sparkSession)

    @F.pandas_udf("n_words long, n_features long, weight long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                if longest == 1:
                    n_words = n = total = 0
                    for part in chunks(text or b""):
                        found = hashed(part.split(), len(gain))
                        n_words += len(found)
                        total += int(gain[found].sum())
                    n = n_words
                else:
                    words = words_of(text or b"")
                    found = features(words, longest, len(gain))
                    n_words, n, total = len(words), len(found), int(gain[found].sum())
                rows.append((n_words, n, total // n if n else 0))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "weight"], dtype=np.int64)

    text = F.col("text").cast("string").cast("binary")
    return documents.select("doc_id", run(text).alias("found")).select("doc_id", "found.*")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from the digest of seed and id; a null id counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their place from 1 in ``order``, without a task that holds all of them.

    Rows are sorted into ranges, numbered within each, and moved on by the sizes of the ranges before.
    """
    spark = rows.sparkSession
    n = shuffle_partitions(spark)
    placed = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    placed = materialize(placed, "ranges")
    part = F.shiftright("_at", 33)
    before, starts = 0, []
    for row in sorted(placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()):  # at most n rows
        starts.append((row.part, before))
        before += row.n
    starts = spark.createDataFrame(starts, "_part long, _before long")
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return placed.join(F.broadcast(starts), part == F.col("_part")).select(*rows.columns, place.alias(name))


def resampled(
    documents: DataFrame, target: DataFrame, longest: int = WORDS, n_buckets: int = BUCKETS,
    percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every document.

    Of the documents with at least ``least_words`` words the ``percent`` hundredths of the highest
    scores are drawn and ranked from 1, equal scores by smaller doc_id (null last); others have a
    null rank. Null and empty texts have no features and weight 0; repeated rows are drawn each on
    its own. An empty target leaves gains that follow the corpus alone. Other columns are not read.
    """
    spark = documents.sparkSession
    gain = gains(bucket_counts(documents, longest, n_buckets), bucket_counts(target, longest, n_buckets))
    scored = with_weight(documents, gain, longest).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialize(scored.withColumn("_row", F.monotonically_increasing_id()), "scores")
    enough = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("_row")]
    n_drawn = scored.where(enough).count() * percent // 100
    drawn = ranked(scored.where(enough), order).withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("_row")


def drawn_documents(documents: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents with all their columns and ``rank``; doc_id must be unique and not null."""
    ranks = resampled(documents, target, **options).where(F.col("rank").isNotNull()).select("doc_id", "rank")
    return documents.drop("rank").join(ranks, "doc_id")
