"""Near copies of documents: texts whose sets of word shingles have a similarity of 0.8 or more.

SimHash comes first: 64 votes over the distinct shingles, linked within a few bits by the generalised
pigeonhole search of ``simhash``. Its classes are checked against the shingle sets along a sorted
order, each member with the few before it, so the copies of a large group become one component for
a constant number of comparisons each. Bands of minima then complete the recall: texts that share all minima of a
band meet in its cell, cells that hold one component are closed, and the rest is compared inside the
cell: component first, a sketch next, the sets last. Cells return forests of links, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from shopvitals.llm.common import attach, components_at, may_be_in, shuffle_partitions, small_batches, whole_text
from shopvitals.llm.simhash import SEED, links_at, majority, shingle_hashes
from shopvitals.session import discard, materialize_at

#: Bits within which SimHash links, and how many members before it each member of a class is compared with.
MAX_BITS, NEIGHBOURS = 6, 4
#: Near copies share all minima of one of so many bands of so many; a pair at 0.8 shares none with (1 - 0.8 ** 6) ** 24 = 7e-4.
BANDS, BAND = 24, 6
FACTORS = np.random.default_rng(SEED).integers(0, 2**64, BANDS * BAND, dtype=np.uint64) | np.uint64(1)
#: Share of equal minima, of 144, below which the sets are not compared: a pair at 0.8 falls below with 1e-4.
LOOSE = 0.68
#: Members and bytes of shingles of a cell that is compared as a whole; larger ones are cut into parts.
CELL, CELL_BYTES = 4096, 32 << 20


def shingle_set(text: str, words: int) -> np.ndarray:
    """The distinct shingle hashes of a text, in order."""
    return np.unique(shingle_hashes(text, words))


def set_node(hashes: np.ndarray) -> int:
    """One number for a shingle set; texts of equal sets are one node."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).view(np.int64))


def minima(hashes: np.ndarray) -> np.ndarray:
    least = np.full(len(FACTORS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 1024):
        least = np.minimum(least, (hashes[i : i + 1024, None] * FACTORS[None]).min(axis=0))
    return least


def band_keys(least: np.ndarray) -> list[int]:
    """A key of each band; two sets have one in common with probability similarity ** BAND."""
    keys = [xxhash.xxh64_intdigest(least[BAND * i : BAND * (i + 1)].tobytes(), i) for i in range(BANDS)]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def sketch(least: np.ndarray) -> bytes:
    """One byte of each minimum."""
    return (least >> np.uint64(16)).astype(np.uint8).tobytes()


def alike(one: np.ndarray, other: np.ndarray, tenths: int) -> bool:
    """Whether two sets have a similarity of ``tenths`` / 10 or more, in whole numbers."""
    low, high = sorted((len(one), len(other)))
    if low * 10 < high * tenths:
        return False
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both * 10 >= (low + high - both) * tenths


# ------------------------------------------------------------------------- texts to nodes


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(whole_text(text)))


def with_prints(documents: DataFrame, words: int) -> DataFrame:
    """doc_id, digest, node, fp, n_set, bands, sketch of every whole text; one without words has no band."""
    small_batches(documents.sparkSession)

    @F.pandas_udf("node long, fp long, n_set long, bands array<long>, sketch binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                hashes = shingle_set(text, words)
                least = minima(hashes)
                bands = band_keys(least) if len(hashes) else []
                rows.append((set_node(hashes), majority(hashes), len(hashes), bands, sketch(least)))
            yield pd.DataFrame(rows, columns=["node", "fp", "n_set", "bands", "sketch"])

    found = run(whole_text(F.col("text"))).alias("found")
    return documents.select("doc_id", _digest(F.col("text")).alias("digest"), found).select("doc_id", "digest", "found.*")


def with_sets(documents: DataFrame, words: int) -> DataFrame:
    """node and the sorted shingle hashes of every whole text."""
    small_batches(documents.sparkSession)

    @F.pandas_udf("node long, shingles binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(text, words) for text in batch]
            yield pd.DataFrame({"node": [set_node(x) for x in sets], "shingles": [x.tobytes() for x in sets]})

    return documents.select(run(whole_text(F.col("text"))).alias("found")).select("found.*")


# ----------------------------------------------------------------------- classes, checked


def chained(batches, tenths: int) -> Iterator[pd.DataFrame]:
    """Links (a, b) of a partition sorted by class: members alike to one of the few of their class before them."""
    last, before = None, []
    for batch in batches:
        found = []
        for block, node, own in zip(batch["block"], batch["node"], batch["shingles"]):
            if block != last:
                last, before = block, []
            hashes = np.frombuffer(own, dtype=np.uint64)
            found += [(node, other) for other, theirs in before if alike(hashes, theirs, tenths)][:1]
            before = [(node, hashes), *before[: NEIGHBOURS - 1]]
        yield pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def class_links(blocks: DataFrame, sets: DataFrame, tenths: int) -> DataFrame:
    """Links (a, b) between neighbours in the order of SimHash classes (block, fp, node).

    The order is cut into ranges, so a class of any size is spread; what a cut parts, bands find.
    """
    order = ["block", "fp", "node"]
    placed = blocks.join(sets, "node").repartitionByRange(shuffle_partitions(sets.sparkSession), *order)
    return placed.sortWithinPartitions(*order).mapInPandas(lambda b: chained(b, tenths), "a long, b long")


# --------------------------------------------------------------------------------- cells


def whole_cells(batches) -> Iterator[pd.DataFrame]:
    """The cells of a partition sorted by key, one frame each."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        keys = batch["key"].to_numpy()
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            part = batch.iloc[a:b]
            if held and len(part) and held[0]["key"].iloc[0] != part["key"].iloc[0]:
                yield pd.concat(held, ignore_index=True)
                held = []
            if len(part):
                held.append(part)
    if held:
        yield pd.concat(held, ignore_index=True)


def candidates(cell: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of a cell's rows of different components whose sketches are close.

    In a cell of two parts only members of different parts are paired; those of one meet in its own cell.
    """
    sketches = np.frombuffer(b"".join(cell["sketch"]), dtype=np.uint8).reshape(len(cell), -1)
    component, part = cell["component"].to_numpy(np.int64), cell["part"].to_numpy(np.int64)
    two_parts = part.min() != part.max()
    least = int(np.ceil(LOOSE * sketches.shape[1]))
    step = max(1, (1 << 25) // max(1, sketches.size))
    for i in range(0, len(cell), step):
        end = min(len(cell), i + step)
        differ = component[i:end, None] != component[None, i:]
        if two_parts:
            differ &= part[i:end, None] != part[None, i:]
        differ &= np.arange(i, end)[:, None] < np.arange(i, len(cell))[None]
        if differ.any():
            close = (sketches[i:end, None] == sketches[None, i:]).sum(axis=2, dtype=np.int32) >= least
            x, y = np.nonzero(differ & close)
            yield x + i, y + i


def close_members(batches, columns: list[str]) -> Iterator[pd.DataFrame]:
    """Members of cells that have a close sketch in another component."""
    for cell in whole_cells(batches):
        near = np.zeros(len(cell), bool)
        for x, y in candidates(cell):
            near[x] = near[y] = True
        if near.any():
            yield cell.loc[near, columns]


def linked_members(batches, tenths: int) -> Iterator[pd.DataFrame]:
    """Links (a, b) of cells as forests: sets are compared only where components still differ."""
    for cell in whole_cells(batches):
        node = cell["node"].to_numpy(np.int64)
        names, root = np.unique(cell["component"].to_numpy(np.int64), return_inverse=True)
        above = np.arange(len(names))
        sets: dict[int, np.ndarray] = {}

        def top(i: int) -> int:
            while above[i] != i:
                above[i] = above[above[i]]
                i = above[i]
            return i

        found = []
        for x, y in candidates(cell):
            for i, j in zip(x.tolist(), y.tolist()):
                p, q = top(root[i]), top(root[j])
                if p == q:
                    continue
                for k in (i, j):
                    if k not in sets:
                        sets[k] = np.frombuffer(cell["shingles"].iloc[k], dtype=np.uint64)
                if alike(sets[i], sets[j], tenths):
                    above[max(p, q)] = min(p, q)
                    found.append((node[i], node[j]))
        if found:
            yield pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)


def cut_cells(cells: DataFrame) -> DataFrame:
    """``cells`` with ``part``; those of too many members or shingles are cut, and each pair of parts is a cell."""
    size = cells.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.col("n_set") * 8).alias("bytes"))
    parts = F.ceil(F.greatest(F.col("n") / F.lit(CELL), F.col("bytes") / F.lit(CELL_BYTES)) * 2).cast("int")
    large, path = materialize_at(size.select("key", parts.alias("_parts")).where(F.col("_parts") > 2), "cells")
    n_large = large.count()
    if not n_large:
        discard(cells.sparkSession, path)
        return cells.withColumn("part", F.lit(0))
    marked = attach(cells, large, ["key"], F.col("node"), n_large)
    part = F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("node", F.lit("part")), F.col("_parts"))).cast("int")
    cut = marked.withColumn("part", part)
    others = F.when(F.col("_parts").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("_parts") - 1))
    cut = cut.withColumn("_other", F.explode(others))
    pair = F.xxhash64("key", F.least("part", "_other"), F.greatest("part", "_other"))
    return cut.withColumn("key", F.when(F.col("_parts").isNull(), F.col("key")).otherwise(pair)).drop("_parts", "_other")


def cell_links(cells: DataFrame, nodes: DataFrame, sets: DataFrame, named: DataFrame, tenths: int) -> tuple[DataFrame, str]:
    """Links (a, b) that connect what all alike pairs within the cells (key, node) do, given components (node, component); and their folder."""
    spark = cells.sparkSession
    n = shuffle_partitions(spark)
    known = cells.join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ends = known.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
    known = known.join(ends.where("_low != _high").select("key"), "key", "left_semi")
    known, known_path = materialize_at(known, "cells")
    met = cut_cells(known.join(nodes.select("node", "n_set", "sketch"), "node")).drop("n_set")
    columns = ["key", "node", "component", "part", "sketch"]
    met = met.select(*columns).repartition(n, "key").sortWithinPartitions("key")
    near = met.mapInPandas(lambda b: close_members(b, columns), met.schema)
    near, near_path = materialize_at(near, "cells")
    both = near.join(sets, "node").repartition(n, "key").sortWithinPartitions("key", "node")
    found = materialize_at(both.mapInPandas(lambda b: linked_members(b, tenths), "a long, b long"), "links")
    discard(spark, known_path)
    discard(spark, near_path)
    return found


# ----------------------------------------------------------------------------- documents


def dropped(documents: DataFrame, words: int = 5, tenths: int = 8) -> DataFrame:
    """(doc_id, digest) of the rows that go: all of each group but the one of the least doc_id."""
    spark = documents.sparkSession
    folders: list[str] = []

    def kept(frame: DataFrame, label: str) -> DataFrame:
        out, path = materialize_at(frame, label)
        folders.append(path)
        return out

    named = documents.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    prints = kept(with_prints(named, words), "prints")
    nodes = kept(
        prints.groupBy("node").agg(
            F.min(F.struct("doc_id", "digest")).alias("least"), F.first("fp").alias("fp"), F.first("n_set").alias("n_set"),
            F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
        ),
        "nodes",
    )
    # SimHash classes, those of one node left out
    fps = nodes.select("fp").distinct()
    near, near_path = links_at(fps.select(F.col("fp").alias("node"), "fp"), MAX_BITS)
    classes, classes_path = components_at(near)
    folders += [near_path, classes_path]
    blocks = nodes.select("node", "fp").join(classes.withColumnRenamed("node", "fp"), "fp", "left")
    blocks = blocks.select("node", "fp", F.coalesce("component", "fp").alias("block"))
    several = blocks.groupBy("block").agg(F.min("node").alias("_low"), F.max("node").alias("_high")).where("_low != _high")
    blocks = kept(blocks.join(several.select("block"), "block", "left_semi"), "classes")
    # cells of the bands, those of one node left out
    rows = nodes.select(F.explode("bands").alias("key"), "node")
    shared = rows.groupBy("key").agg(F.min("node").alias("_low"), F.max("node").alias("_high")).where("_low != _high")
    cells = kept(rows.join(shared.select("key"), "key", "left_semi"), "cells")
    # the sets of what is in either
    wanted = kept(
        nodes.join(blocks.select("node").unionByName(cells.select("node")).distinct(), "node", "left_semi").select("node", "least.doc_id"),
        "wanted",
    )
    ids = wanted.select("doc_id").distinct()
    texts = named.where(may_be_in([F.col("doc_id")], ids, ["doc_id"])).join(ids.hint("merge"), "doc_id", "left_semi")
    sets = with_sets(texts, words).join(wanted.select("node"), "node", "left_semi")
    sets = kept(sets.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")

    first = kept(class_links(blocks, sets, tenths), "links")
    linked, linked_path = components_at(first)
    folders.append(linked_path)
    second, second_path = cell_links(cells, nodes, sets, linked, tenths)
    linked, linked_path = components_at(first.unionByName(second))
    folders += [second_path, linked_path]

    groups = nodes.select("node", "least").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    keepers = groups.groupBy("component").agg(F.min("least").alias("keeper"))
    keepers = groups.join(keepers, "component").select("node", "keeper")
    gone = prints.select("node", F.struct("doc_id", "digest").alias("row")).join(keepers, "node").where(F.col("row") != F.col("keeper"))
    out, _ = materialize_at(gone.select("row.doc_id", "row.digest").distinct(), "dropped")
    for folder in folders:
        discard(spark, folder)
    return out


def without_near_copies(documents: DataFrame, words: int = 5, tenths: int = 8) -> DataFrame:
    """One document of each near-duplicate group, the one of the least doc_id, with its columns.

    Linked are texts whose sets of word shingles have a similarity (common / all) of ``tenths`` / 10
    or more, groups are what links connect. Null texts count as empty, and texts without words are copies of one another.
    Rows without doc_id stay, as nothing names them; of rows that repeat id and text one stays, rows
    that repeat an id with other texts are documents of their own.
    """
    out = dropped(documents, words, tenths)
    names, key = documents.columns, ["doc_id", "_digest"]
    rows = documents.where(F.col("doc_id").isNotNull()).withColumn("_digest", _digest(F.col("text")))
    gone = out.select("doc_id", F.col("digest").alias("_digest"))
    twice, _ = materialize_at(rows.select(*key).groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "repeated")
    # Only texts that may go, or are there twice, are shuffled; the tables grow with the documents, so they are not broadcast.
    concerned = may_be_in([F.col(k) for k in key], gone.unionByName(twice), key)
    rest = rows.where(concerned).join(gone.hint("merge"), key, "left_anti")
    once = rest.join(twice.hint("merge"), key, "left_anti")
    again = rest.join(twice.hint("merge"), key, "left_semi").dropDuplicates(key)
    left = rows.where(~concerned).unionByName(once).unionByName(again)
    return left.select(*names).unionByName(documents.where(F.col("doc_id").isNull()).select(*names))
