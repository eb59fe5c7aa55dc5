"""Embedding near-duplicates: an exact metric range join on cosine.

On the unit sphere a cosine of at least c is a distance of at most r = sqrt(2 - 2c). Every vector is
at home in the cell of its nearest pivot. A vector with pivots p (its own) and q can only have a
neighbour in q's cell if it is within r of the boundary: by the triangle inequality
(d(q) - d(p)) / 2 <= r, and, as the space is Euclidean, (d(q)^2 - d(p)^2) / (2 d(p, q)) <= r. So it also
visits the cells within that bound. Each pair is compared in one cell: vectors visit only cells of a
smaller number than their own. Cells are joined independently, a block of home vectors against a
stream of visitors, and return link counts and a spanning forest, never pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shopvitals.llm.common import components, forest, shuffle_partitions, small_batches
from shopvitals.session import discard, materialize, materialize_at

MIN_COSINE = 0.9
#: Home vectors of a cell, on average and at most; fuller cells are cut into parts.
CELL = 4096
#: Bounds of the pivots and of the sample they are chosen from, the least hashed ids.
MAX_PIVOTS, SAMPLE = 1024, 8192
#: Room left for rounding when distances decide where vectors go; never when pairs are compared.
SLACK = 1e-6


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) of the vectors that can link, one row per id.

    Null, empty or zero vectors and ones with null or non-finite components link with nothing, nor do
    rows without id. A repeated id counts as one vector, its least in array order.
    """
    v = F.col("embedding").cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    good = F.forall(v, finite) & F.exists(v, lambda x: x != 0.0)
    return (
        vectors.where(F.col("vec_id").isNotNull()).select("vec_id", v.alias("embedding"))
        .where(F.col("embedding").isNotNull() & good)
        .groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    )


def unit(rows: np.ndarray) -> np.ndarray:
    top = np.abs(rows).max(axis=1, keepdims=True)  # against overflow of squares
    scaled = rows / top
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` vectors of the sample, each the farthest from those before it, dense places first.

    The first is the one with most of the sample within the link distance, so a large group of near
    copies is one cell and the rest hardly visits it.
    """
    if not len(sample):
        return sample
    looked = sample[:1024]
    crowd = ((sample @ looked.T) >= MIN_COSINE).sum(axis=0)
    chosen = [int(crowd.argmax())]
    nearest = sample @ sample[chosen[0]]
    while len(chosen) < min(n, len(sample)):
        far = int(nearest.argmin())
        if nearest[far] > 1 - 1e-9:
            break
        chosen.append(far)
        nearest = np.maximum(nearest, sample @ sample[far])
    return sample[chosen]


def deal(points: np.ndarray, pivots: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each point, and whether it must also go to each cell."""
    squares = np.maximum(0.0, 2 - 2 * points @ pivots.T)
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * pivots @ pivots.T))
    home = squares.argmin(axis=1)
    own = squares[np.arange(len(points)), home]
    triangle = (np.sqrt(squares) - np.sqrt(own)[:, None]) / 2 <= reach + SLACK
    plane = squares - own[:, None] <= 2 * apart[home] * (reach + SLACK)
    goes = triangle & plane & (np.arange(len(pivots)) < home[:, None])
    return home, goes


def scaled(rows: np.ndarray) -> np.ndarray:
    """Each row divided by a power of two, so that products neither overflow nor vanish; other results keep their bits."""
    _, exponent = np.frexp(np.abs(rows).max(axis=1))
    return np.ldexp(rows, -exponent[:, None])


def compare(home, points, min_cosine: float, same: bool):
    """Links between scaled home vectors and points: (home index, point index), in double precision."""
    norm = np.sqrt((home * home).sum(axis=1))[:, None] * np.sqrt((points * points).sum(axis=1))[None]
    close = home @ points.T >= min_cosine * norm
    if same:
        close = np.triu(close, 1)
    return np.nonzero(close)


def join_cells(batches, min_cosine: float):
    """Counts (vec_id, n) and forest links (vec_id, to) of a partition sorted by cell, homes first."""
    cell, ids, home, counts, links, gathered = None, None, None, None, [], 0
    loose: list[np.ndarray] = []

    def out(nodes, n, to):
        return pd.DataFrame({"vec_id": nodes, "n": n, "to": to})

    def close_links():
        nonlocal links, gathered
        if not links:
            return None
        u, v = np.concatenate([x[0] for x in links]), np.concatenate([x[1] for x in links])
        links, gathered = [], 0
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = forest(len(nodes), at[: len(u)], at[len(u) :])
        moved = np.flatnonzero(root != np.arange(len(nodes)))
        return out(nodes[moved], np.zeros(len(moved), np.int64), nodes[root[moved]])

    def flush():
        nonlocal loose
        if ids is not None and counts is not None and counts.any():
            some = np.flatnonzero(counts)
            loose.append(out(ids[some], counts[some], ids[some]))
        if (found := close_links()) is not None:
            loose.append(found)
        done, loose = loose, []
        return done

    for batch in batches:
        keys = batch["cell"].to_numpy()
        for start, end in _runs(keys):
            part = batch.iloc[start:end]
            if keys[start] != cell:
                yield from flush()
                cell, ids, home, counts = keys[start], None, None, None
            visitor = part["visitor"].to_numpy(bool)
            points = scaled(np.stack(part["embedding"].to_numpy()).astype(float))
            names = part["vec_id"].to_numpy(np.int64)
            settled = ~visitor
            if settled.any():
                new_ids, new = names[settled], points[settled]
                u, v = compare(new, new, min_cosine, True)
                n_new = np.bincount(u, minlength=len(new)) + np.bincount(v, minlength=len(new))
                links.append((new_ids[u], new_ids[v]))
                if home is None:
                    ids, home, counts = new_ids, new, n_new
                else:
                    u, v = compare(home, new, min_cosine, False)
                    counts = counts + np.bincount(u, minlength=len(home))
                    n_new = n_new + np.bincount(v, minlength=len(new))
                    links.append((ids[u], new_ids[v]))
                    ids, home, counts = np.concatenate([ids, new_ids]), np.concatenate([home, new]), np.concatenate([counts, n_new])
            if visitor.any() and home is not None:
                guests = names[visitor]
                u, v = compare(home, points[visitor], min_cosine, False)
                if len(u):
                    counts = counts + np.bincount(u, minlength=len(home))
                    links.append((ids[u], guests[v]))
                    n_guest = np.bincount(v, minlength=len(guests))
                    some = np.flatnonzero(n_guest)
                    yield out(guests[some], n_guest[some], guests[some])
            if sum(len(x[0]) for x in links) > 300_000 and (found := close_links()) is not None:
                loose.append(found)
                yield from loose
                loose = []
    yield from flush()


def _runs(keys: np.ndarray):
    if not len(keys):
        return
    cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)])


def classes(vectors: DataFrame, min_cosine: float = MIN_COSINE, cell: int = CELL, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept.

    Rows that cannot link have no links and are their own component; without an id that is null and
    ``kept`` false. Rows of a repeated id share one result. Vectors of different lengths never link.
    """
    spark = vectors.sparkSession
    small_batches(spark, 1024)
    good, good_path = materialize_at(usable(vectors), "vectors")
    good = good.withColumn("dim", F.size("embedding"))
    dims = [(r.dim, r.n) for r in good.groupBy("dim").agg(F.count("*").alias("n")).collect()]
    every = None
    reach = float(np.sqrt(max(0.0, 2 - 2 * min_cosine)))
    for dim, n in sorted(dims):
        own = good.where(F.col("dim") == dim)
        n_pivots = int(min(max_pivots, max(1, -(-n // cell))))
        chosen = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE if n_pivots > 1 else 1).collect()
        pivots = choose_pivots(unit(np.array([r.embedding for r in chosen], dtype=float)), n_pivots)
        found = _dealt(own.select("vec_id", "embedding"), pivots, reach, dim)
        every = found if every is None else every.unionByName(found)
    if every is None:
        facts = None
    else:
        dealt, dealt_path = materialize_at(every, "cells")
        parts = F.ceil(F.col("homes") / F.lit(cell))
        homes = dealt.where(~F.col("visitor")).groupBy("cell").agg(F.count("*").alias("homes"))
        homes = homes.select("cell", F.greatest(parts, F.lit(1)).cast("int").alias("parts"))
        known = {r.cell: r.parts for r in homes.collect()}  # at most max_pivots rows per length
        n_parts = F.coalesce(F.create_map(*[F.lit(x) for kv in known.items() for x in kv])[F.col("cell")], F.lit(1))
        own_part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
        split = dealt.withColumn("parts", n_parts).withColumn("own", own_part)
        # visitors meet every part of a cell; home vectors visit the parts before their own
        last = F.when(F.col("visitor"), F.col("parts") - 1).otherwise(F.col("own"))
        split = split.withColumn("part", F.explode(F.sequence(F.lit(0), last)))
        split = split.withColumn("visitor", F.col("visitor") | (F.col("part") != F.col("own")))
        split = split.withColumn("cell", F.xxhash64("cell", "part")).select("cell", "visitor", "vec_id", "embedding")
        cells = split.repartition(shuffle_partitions(spark), "cell").sortWithinPartitions("cell", "visitor", "vec_id")
        facts = materialize(
            cells.mapInPandas(lambda b: join_cells(b, min_cosine), "vec_id long, n long, to long"), "links"
        )
        discard(spark, dealt_path)
    rows = vectors.select("vec_id")
    if facts is None:
        out = rows.withColumn("n_links", F.lit(0).cast("long")).withColumn("component_id", F.col("vec_id"))
    else:
        n_links = facts.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
        linked = components(facts.where(F.col("vec_id") != F.col("to")).select(F.col("vec_id").alias("a"), F.col("to").alias("b")))
        known = n_links.join(linked.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        out = rows.join(known, "vec_id", "left").select(
            "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
        )
    discard(spark, good_path)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _dealt(vectors: DataFrame, pivots: np.ndarray, reach: float, dim: int) -> DataFrame:
    """vec_id, embedding, cell, visitor: each vector at home, and where it visits."""

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            points = unit(np.stack(batch["embedding"].to_numpy()).astype(float))
            home, goes = deal(points, pivots, reach)
            row, to = np.nonzero(goes)
            at = np.concatenate([np.arange(len(batch)), row])
            out = batch.iloc[at].reset_index(drop=True)
            out["cell"] = np.concatenate([home, to]).astype(np.int64) + dim * 1_000_000
            out["visitor"] = np.arange(len(at)) >= len(batch)
            yield out

    return vectors.mapInPandas(run, "vec_id long, embedding array<double>, cell long, visitor boolean")
