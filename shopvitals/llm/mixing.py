"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source should appear target / source size times. The whole part of that is
given at once; the fractions are rounded in pairs: mass moves between two documents, by a fair
random choice, until one of them is 0 or 1, and the other goes on to the next pair. Mass is moved
in words, so each step keeps a source's total exactly, and the expected copies of each document.
Blocks of documents leave one open document each; these are paired again, level by level, until
each source has one, which is rounded alone.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from shopvitals.llm.common import attach, shuffle_partitions, whole_text
from shopvitals.session import materialize

MAX_COPIES = 3
WEIGHTS = (1, 2, 3)
#: Documents that are rounded one after the other; larger sources are cut into such blocks.
BLOCK = 4096
SEED = 20_240
WORDS = r"[^\x20\x09-\x0D]+"


def sizes(documents: DataFrame):
    """The documents with ``size``, the number of words of the whole text (null: 0)."""
    return documents.withColumn("size", F.regexp_count(whole_text(F.col("text")), F.lit(WORDS)).cast("long"))


def targets(sized: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """source, n, source_size, target of every source; the targets' sum is the sum of all sizes.

    Sources by code point, null last, have ``weights`` in turn. A target is the smaller of
    max_copies * source_size and level * weight, for the one level at which the targets use up all
    words; this is where resharing every excess by weight ends.
    """
    spark = sized.sparkSession
    totals = materialize(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), "sources"
    )
    ranked = totals.orderBy(F.col("source").asc_nulls_last()).select("source", "source_size", "n")
    schema = "source string, source_size long, n long, rank long"
    ranked = materialize(
        spark.createDataFrame(ranked.rdd.zipWithIndex().map(lambda x: (*x[0], x[1])), schema), "sources"
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = ranked.select("source", "n", "source_size", weight.alias("weight"))
    room = F.col("source_size") * float(max_copies)
    whole = float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, n_full = 0.0, -1
    while True:
        full = room <= F.col("weight") * level if n_full >= 0 else F.lit(False)
        row = table.agg(
            F.sum(F.when(full, room).otherwise(0.0)).alias("given"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("weights"),
            F.sum(F.when(full, 1).otherwise(0)).alias("full"),
        ).first()
        if not row.weights or row.full == n_full:
            break
        level, n_full = (whole - row.given) / row.weights, row.full
    return table.select("source", "n", "source_size", F.least(room, F.col("weight") * level).alias("target"))


def pivot(size: np.ndarray, part: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Round the fractions ``part`` in order, words kept; at most one stays between 0 and 1.

    Documents of size 0 move no words and are rounded alone.
    """
    out = part.astype(float).copy()
    out[out < 1e-9] = 0.0
    out[out > 1 - 1e-9] = 1.0
    empty = (size == 0) & (out > 0) & (out < 1)
    out[empty] = (draw.random(len(out))[empty] < out[empty]).astype(float)
    held = -1
    for j in np.flatnonzero((out > 0) & (out < 1)):
        if held < 0:
            held = j
            continue
        i = held
        forward = min(out[i] * size[i], (1 - out[j]) * size[j])  # words that i can give to j
        back = min((1 - out[i]) * size[i], out[j] * size[j])
        words = -back if draw.random() * (forward + back) < forward else forward
        out[i] -= words / size[i]
        out[j] += words / size[j]
        held = -1
        for k in (i, j):
            if out[k] < 1e-9:
                out[k] = 0.0
            elif out[k] > 1 - 1e-9:
                out[k] = 1.0
            else:
                held = k
    return out


def _round_blocks(batches, level: int, seed: int):
    """Round whole blocks of a partition that is sorted by block; the last one waits for more."""
    waiting = None

    def rounded(rows: pd.DataFrame) -> pd.DataFrame:
        pieces = []
        for at, block in rows.groupby("at", sort=False):
            block = block.sort_values(["size", "tie"], ascending=[False, True], kind="stable")
            draw = np.random.default_rng([seed, level, zlib.crc32(at.encode("utf-8", "replace"))])
            block["part"] = pivot(block["size"].to_numpy(float), block["part"].to_numpy(float), draw)
            pieces.append(block)
        return pd.concat(pieces)

    for batch in batches:
        rows = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
        if not len(rows):
            continue
        open_at = rows["at"].to_numpy() == rows["at"].iloc[-1]
        waiting = rows[open_at]
        if not open_at.all():
            yield rounded(rows[~open_at])
    if waiting is not None:
        yield rounded(waiting)


def copies(documents: DataFrame, block: int = BLOCK, seed: int = SEED, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """One row per document: row, doc_id, source, size, source_size, target, copies.

    ``row`` is a hash of the whole row, which names it with its doc_id. Blocks and random numbers
    depend on rows and sources alone, so reruns agree whatever the partitions are. Null texts have
    size 0; a null source is a source of its own. Rows that are equal in every column are rounded
    as separate documents. A source without words has target 0.
    """
    spark = documents.sparkSession
    sized = sizes(documents.select("doc_id", "source", "text")).select(
        "doc_id", "source", "size", F.xxhash64("doc_id", "source", "text").alias("row")
    )
    sized = materialize(sized, "sizes")
    table = materialize(targets(sized, weights, max_copies), "targets")
    rows = attach(sized, table, ["source"], F.col("row"), table.count())
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("whole", F.floor(rate)).withColumn("part", rate - F.floor(rate))
    named = F.concat_ws("|", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null")), F.col("bucket").cast("string"))
    bucket = F.pmod(F.xxhash64("doc_id", "row"), F.ceil(F.col("n") / F.lit(block)))
    state = rows.withColumn("bucket", bucket).withColumn("at", named)
    done, level = [], 0
    columns = ["doc_id", "row", "source", "size", "source_size", "target", "whole", "part", "bucket", "at"]
    schema = ("id string, tie long, source string, size long, source_size long, target double, whole long, part double, "
              "bucket long, at string, most long")
    most = F.ceil(F.col("n") / F.lit(block))
    state = state.select(*columns, most.alias("most"))
    state = state.select(F.col("doc_id").cast("string").alias("id"), F.col("row").alias("tie"), *columns[2:], "most")
    while True:
        dealt = state.repartition(shuffle_partitions(spark), "at").sortWithinPartitions("at")
        found = materialize(dealt.mapInPandas(lambda b, level=level: _round_blocks(b, level, seed), schema), "rounded")
        still = (F.col("part") > 0) & (F.col("part") < 1)
        done.append(found.where(~still))
        rest = found.where(still)
        if not rest.where(F.col("most") > 1).limit(1).count():
            draw = F.pmod(F.xxhash64(F.coalesce("source", F.lit("")), F.col("source").isNull(), F.lit(seed)), F.lit(1 << 40))
            last = rest.withColumn("part", F.when(draw / F.lit(float(1 << 40)) < F.col("part"), 1.0).otherwise(0.0))
            done.append(last)
            break
        state = rest.withColumn("bucket", F.floor(F.col("bucket") / F.lit(block))).withColumn("at", named).withColumn(
            "most", F.ceil(F.col("most") / F.lit(block))
        ).select(*found.columns)
        level += 1
    every = done[0]
    for part in done[1:]:
        every = every.unionByName(part)
    return every.select(
        F.col("tie").alias("row"), F.col("id").cast("long").alias("doc_id"), "source", "size", "source_size", "target",
        (F.col("whole") + F.col("part")).cast("long").alias("copies"),
    )


def mixed(documents: DataFrame, **options) -> DataFrame:
    """The documents, each row as often as the mix takes it."""
    taken = copies(documents, **options)
    chosen = taken.groupBy("doc_id", "row").agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    chosen = chosen.withColumnsRenamed({"doc_id": "_id", "row": "_row"})
    named = documents.withColumn("_named", F.xxhash64("doc_id", "source", "text"))
    # One row per document: the table grows with them, so it is never broadcast.
    joined = named.join(chosen.hint("merge"), named.doc_id.eqNullSafe(F.col("_id")) & (F.col("_named") == F.col("_row")))
    # rows that repeat in every way share their copies; the first ones get what does not divide
    place = F.row_number().over(Window.partitionBy("_id", "_row").orderBy(F.lit(0)))
    alone = joined.where(F.col("_rows") == 1).withColumn("_times", F.col("_copies"))
    shared = joined.where(F.col("_rows") > 1).withColumn("_place", place)
    extra = F.when(F.col("_place") <= F.col("_copies") % F.col("_rows"), 1).otherwise(0)
    shared = shared.withColumn("_times", F.floor(F.col("_copies") / F.col("_rows")) + extra).drop("_place")
    both = alone.unionByName(shared).where(F.col("_times") > 0)
    return both.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times").cast("long")))).select(*documents.columns)

