"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are 64 majority votes over the hashes of a text's word shingles. To find all pairs
within ``max_bits`` differing bits, the bits are grouped into blocks, correlated ones together, and
block i gets a threshold t(i) with sum(t(i) + 1) = max_bits + 1: any such pair is within t(i) bits in
at least one block i. Thresholds are allocated by dynamic programming on candidate counts that are
estimated from a sample; the sample only steers the cost, every fingerprint is indexed and probed.
Each fingerprint is at home in one cell per block and visits the cells within t(i) of it; cells
verify by counting differing bits and return their links as a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from shopvitals.llm.common import attach, components, forest, shuffle_partitions, small_batches, whole_text
from shopvitals.session import discard, materialize, materialize_at

SEED = 42
BITS = 64
#: Bound of the sample that the blocks and thresholds are planned on.
SAMPLE = 2048
#: Cost of one probe (dealt, sorted, read) in verified pairs, as measured: 2 us against 2 ns.
PROBE_COST = 1000.0
#: Members at home in a cell that is compared as it is; larger cells are refined or cut.
CELL = 4096
#: Up to so many bits an oversized cell is refined by its other bits; beyond, it is cut in parts, and
#: only from so many times as many members.
REFINED_BITS, CUT_CELLS = 4, 8
#: Odd multipliers that make hash values of cells, and of the cells within a cell.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
LINK = "a long, b long"


# ------------------------------------------------------------------ fingerprints


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of all ``words``-word shingles; of the whole sequence, if it has fewer words."""
    found = text.encode("utf-8", "replace").lower().split()  # of bytes: A-Z and ASCII white space only
    h = xxhash.xxh64_intdigest
    if len(found) <= words:
        return np.array([h(b" ".join(found), SEED)] if found else [], dtype=np.uint64)
    return np.fromiter(
        (h(b" ".join(found[i : i + words]), SEED) for i in range(len(found) - words + 1)),
        np.uint64, len(found) - words + 1,
    )


def majority(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have set, as a signed 64-bit integer."""
    votes = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 65_536):
        part = hashes[i : i + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes)).view(">i8")[0])


def mixed(hashes: np.ndarray, factor: int) -> np.ndarray:
    x = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(factor)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def with_fingerprint(documents: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and fp of every whole text.

    A shingle votes as often as it occurs. Null texts count as empty; a text without words has
    fingerprint 0 and links like any other.
    """
    small_batches(documents.sparkSession)

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([majority(shingle_hashes(text, words)) for text in batch], dtype=np.int64)

    return documents.select("doc_id", run(whole_text(F.col("text"))).alias("fp"))


# ---------------------------------------------------------------------- planning


@dataclass(frozen=True)
class Block:
    bits: tuple[int, ...]
    radius: int

    def values(self, fps: np.ndarray) -> np.ndarray:
        """The block's bits of each fingerprint, as a number."""
        out = np.zeros(len(fps), dtype=np.uint64)
        for i, bit in enumerate(self.bits):
            out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(i)
        return out

    def flips(self) -> np.ndarray:
        """What to exclusive-or a value with to reach all values within the radius, 0 first."""
        width = range(len(self.bits))
        return np.array(
            [sum(1 << i for i in chosen) for n in range(self.radius + 1) for chosen in combinations(width, n)],
            dtype=np.uint64,
        )


def grouped_bits(sample: np.ndarray, n_blocks: int) -> list[tuple[int, ...]]:
    """Blocks of about equal size that hold bits which agree or disagree with each other.

    Correlated bits together leave the blocks more independent of one another, so that fewer
    candidates pass several of them.
    """
    if not len(sample):
        sample = np.zeros(1, dtype=np.uint64)
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(float)
    centred = bits - bits.mean(axis=0)
    scale = np.sqrt((centred**2).sum(axis=0)) + 1e-9
    tied = np.abs((centred.T @ centred) / np.outer(scale, scale))
    free, blocks = list(range(BITS)), []
    for i in range(n_blocks):
        size = BITS * (i + 1) // n_blocks - BITS * i // n_blocks
        block = [free.pop(0)]
        while len(block) < size:
            best = max(free, key=lambda j: (tied[j, block].sum(), -j))
            free.remove(best)
            block.append(best)
        blocks.append(tuple(sorted(block)))
    return blocks


def plan(sample: np.ndarray, n_rows: int, max_bits: int) -> list[Block]:
    """Blocks and thresholds of the least estimated cost for ``n_rows`` fingerprints.

    For each number of blocks, dynamic programming deals max_bits + 1 units to the blocks; a block
    with u units has threshold u - 1, one without is not probed.
    """
    pairs = max(1, len(sample) * (len(sample) - 1) // 2)
    best: tuple[float, list[Block]] | None = None
    for n_blocks in range(1, max_bits + 2):
        if BITS // n_blocks < 4:
            break
        units = {0: (0.0, [])}
        for bits in grouped_bits(sample, n_blocks):
            whole = Block(bits, 0).values(sample)
            near = np.zeros(BITS + 1)
            for i in range(0, len(whole), 256):
                near += np.bincount(np.bitwise_count(whole[i : i + 256, None] ^ whole[None]).ravel(), minlength=BITS + 1)
            near[0] -= len(whole)
            near = near.cumsum() / 2 / pairs
            dealt: dict[int, tuple[float, list[Block]]] = {}
            probes = 0.0
            for u in range(max_bits + 2):
                if u:
                    n = 1.0
                    for k in range(u - 1):
                        n = n * (len(bits) - k) / (k + 1)
                    probes += n
                    if probes > 4000 or u > len(bits) + 1:
                        break
                share = max(float(near[u - 1]), probes / 2.0 ** len(bits)) if u else 0.0
                cost = n_rows * probes * PROBE_COST + share * n_rows * (n_rows - 1) / 2 if u else 0.0
                for had, (spent, chosen) in units.items():
                    if had + u <= max_bits + 1:
                        now = (spent + cost, chosen + ([Block(bits, u - 1)] if u else []))
                        if had + u not in dealt or now[0] < dealt[had + u][0]:
                            dealt[had + u] = now
            units = dealt
        if (found := units.get(max_bits + 1)) and (best is None or found[0] < best[0]):
            best = found
    return best[1]


# ------------------------------------------------------------------------- links


def _hashed(keys: np.ndarray) -> np.ndarray:
    return mixed(keys, MIX[0]).view(np.int64)


def probes(fps: DataFrame, blocks: list[Block]) -> DataFrame:
    """One row per fingerprint and cell: key, home, block, and the columns of ``fps``."""
    masks = [sum(1 << b for b in block.bits) for block in blocks]
    names = fps.columns

    def run(batches):
        for batch in batches:
            own = batch["fp"].to_numpy(np.int64).view(np.uint64)
            for i, block in enumerate(blocks):
                flips = block.flips()
                per = max(1, 200_000 // len(flips))
                for at in range(0, len(own), per):
                    part = batch.iloc[at : at + per]
                    cells = block.values(own[at : at + per])[:, None] ^ flips[None]
                    keys = _hashed(cells.ravel() * np.uint64(len(blocks)) + np.uint64(i))
                    out = part.loc[part.index.repeat(len(flips))].reset_index(drop=True)
                    out.insert(0, "key", keys)
                    out.insert(1, "home", np.tile(np.arange(len(flips)) == 0, len(part)))
                    out.insert(2, "used", np.array([masks[i]], dtype=np.uint64).view(np.int64)[0])
                    yield out

    kept = ", ".join(f"{n} long" for n in names)
    return fps.mapInPandas(run, f"key long, home boolean, used long, {kept}")


def refined(rows: DataFrame, max_bits: int) -> DataFrame:
    """Members of oversized cells, dealt by max_bits + 1 blocks of the bits their cell leaves open.

    A pair within max_bits agrees in one of these blocks, so it meets again in a smaller cell.
    """
    names = [c for c in rows.columns if c not in ("key", "home", "used")]

    def run(batches):
        for batch in batches:
            own = batch["fp"].to_numpy(np.int64).view(np.uint64)
            used = batch["used"].to_numpy(np.int64).view(np.uint64)
            keys = batch["key"].to_numpy(np.int64).view(np.uint64)
            for mask in np.unique(used):
                at = used == mask
                free = [b for b in range(BITS) if not int(mask) >> b & 1]
                for i in range(max_bits + 1):
                    bits = tuple(free[len(free) * i // (max_bits + 1) : len(free) * (i + 1) // (max_bits + 1)])
                    part = batch[at].copy()
                    value = Block(bits, 0).values(own[at]) * np.uint64(max_bits + 1) + np.uint64(i)
                    part["key"] = _hashed(mixed(keys[at], MIX[1]) ^ value)
                    part["used"] = np.array([int(mask) | sum(1 << b for b in bits)], dtype=np.uint64).view(np.int64)[0]
                    yield part

    kept = ", ".join(f"{n} long" for n in names)
    return rows.select("key", "home", "used", *names).mapInPandas(run, f"key long, home boolean, used long, {kept}")


def link_cells(batches, max_bits: int) -> Iterator[pd.DataFrame]:
    """Links of the cells of a partition sorted by key, homes first, as forests (a, least member b).

    Each cell's homes are compared with all its members, some thousands at a time. The rows of the
    last cell of a batch wait for the next batch; of a long cell only the homes wait, as its visitors
    have met them. Links are reduced to forests whenever many have gathered, so memory follows the
    homes of a cell and not its pairs.
    """
    us: list[np.ndarray] = []
    vs: list[np.ndarray] = []

    def compare(node, bits, n_homes: int, met: int) -> None:
        """Homes against the members from ``met`` on, and those homes against all."""
        for i in range(0, n_homes, 256):
            for j in range(met if i < met else i, len(node), 8192):
                end = min(i + 256, n_homes)
                apart = np.bitwise_count(bits[i:end, None] ^ bits[None, j : j + 8192])
                x, y = np.nonzero(apart <= max_bits)
                x, y = x + i, y + j
                new = x < y
                x, y = x[new], y[new]
                if len(x):
                    us.append(node[x])
                    vs.append(node[y])

    def reduced() -> pd.DataFrame:
        u, v = np.concatenate(us), np.concatenate(vs)
        us.clear()
        vs.clear()
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = forest(len(nodes), at[: len(u)], at[len(u) :])
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        return pd.DataFrame({"a": nodes[moved], "b": nodes[root[moved]]})

    def cells(rows: pd.DataFrame, met: int) -> None:
        key, home = rows["key"].to_numpy(), rows["home"].to_numpy(bool)
        node = rows["node"].to_numpy(np.int64)
        bits = rows["fp"].to_numpy(np.int64).view(np.uint64)
        cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        for k in np.flatnonzero(np.diff(cuts) > 1):
            a, b = cuts[k], cuts[k + 1]
            if n_homes := int(home[a:b].sum()):
                compare(node[a:b], bits[a:b], n_homes, met if k == 0 else 0)

    waiting, met = None, 0  # rows of an unfinished cell, how many of them have met each other
    for batch in batches:
        rows = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
        if not len(rows):
            continue
        same = rows["key"].to_numpy() == rows["key"].iloc[-1]
        whole = 0 if same.all() else int(np.flatnonzero(~same)[-1]) + 1
        if whole:
            cells(rows.iloc[:whole], met)
            met = 0
        waiting = rows.iloc[whole:].reset_index(drop=True)
        if len(waiting) > 32_768 and not waiting["home"].iloc[-1]:
            cells(waiting, met)
            waiting = waiting[waiting["home"]].reset_index(drop=True)
            met = len(waiting)
        if sum(map(len, us)) > 300_000:
            yield reduced()
    if waiting is not None:
        cells(waiting, met)
    if us:
        yield reduced()


def links(fps: DataFrame, max_bits: int, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """As ``links_at``, where the caller's result still reads the folder when it returns."""
    return links_at(fps, max_bits, cell, sample)[0]


def links_at(fps: DataFrame, max_bits: int, cell: int = CELL, sample: int = SAMPLE) -> tuple[DataFrame, str]:
    """Links (a, b) between nodes whose fingerprints differ in at most ``max_bits`` bits, and their folder.

    ``fps`` has one row per node with node and fp. The links returned connect the same nodes as all
    links do; no pair within the bound is left unconnected.

    A cell with more than ``cell`` members at home is not compared by one task: up to four bits it is
    dealt anew by the bits it leaves open. For more bits, or when few are left open, a cell of over
    CUT_CELLS times as many is cut into parts, and each pair of parts meets in a cell of its own.
    """
    if max_bits > REFINED_BITS:
        cell *= CUT_CELLS
    spark = fps.sparkSession
    names = ["node", "fp"]
    n_rows = fps.count()
    chosen = fps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()
    numbers = np.array([r.fp for r in chosen], dtype=np.int64).view(np.uint64)
    rows, path = materialize_at(probes(fps.select(*names), plan(numbers, n_rows, max_bits)), "probes")
    parts, folders = [], [path]
    while True:
        large = rows.groupBy("key").agg(F.count_if("home").alias("n")).where(F.col("n") > cell)
        large, large_path = materialize_at(large, "cells")
        folders.append(large_path)
        n_large = large.count()
        if not n_large:
            parts.append(rows)
            break
        marked = attach(rows, large, ["key"], F.col("fp"), n_large)
        parts.append(marked.where(F.col("n").isNull()).drop("n"))
        over = marked.where(F.col("n").isNotNull())
        open_bits = BITS - F.bit_count("used")
        can = (open_bits > 10) if max_bits <= REFINED_BITS else F.lit(False)
        parts.append(_cut(over.where(~can), cell))
        rows, path = materialize_at(refined(over.where(can).drop("n"), max_bits), "probes")
        folders.append(path)
    every = parts[0].select("key", "home", *names)
    for part in parts[1:]:
        every = every.unionByName(part.select("key", "home", *names))
    sorted_cells = every.repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key", F.desc("home"))
    found = sorted_cells.mapInPandas(lambda batches: link_cells(batches, max_bits), LINK)
    out = materialize_at(found, "links")
    for folder in folders:
        discard(spark, folder)
    return out


def _cut(over: DataFrame, cell: int) -> DataFrame:
    """Rows of oversized cells, copied to the pairs of parts (a, b) their part belongs to."""
    n_parts = F.ceil(F.col("n") / F.lit(cell / 2)).cast("int")
    cut = over.withColumn("_n", n_parts).withColumn("_part", F.pmod(F.xxhash64("node", F.lit("part")), F.col("_n")).cast("int"))
    cut = cut.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    pair = F.xxhash64("key", F.least("_part", "_other"), F.greatest("_part", "_other"))
    return cut.withColumn("key", pair).drop("n", "_n", "_part", "_other")


# ------------------------------------------------------------------- documents


def classes(documents: DataFrame, words: int = 3, max_bits: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the least doc_id reachable by links.

    Documents of equal fingerprints are one node, so a group of exact copies is one row before any
    cell is built. Rows without doc_id get the component of their fingerprint; it is null only if
    no member has an id. Repeated rows come back repeated.
    """
    fps = materialize(with_fingerprint(documents, words), "fingerprints")
    nodes = materialize(fps.groupBy(F.col("fp").alias("node")).agg(F.min("doc_id").alias("least")), "nodes")
    found, found_path = links_at(nodes.select("node", F.col("node").alias("fp")), max_bits)
    linked = components(found)
    discard(documents.sparkSession, found_path)
    named = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.select("node", "component").join(least, "component").select(F.col("node").alias("fp"), "component_id")
    return fps.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
