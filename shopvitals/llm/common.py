"""What several operators of this folder share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopvitals.session import discard, materialize_at

#: Rows of a table that is sent to every executor; larger ones are joined by salted keys.
BROADCAST_ROWS = 50_000
SALTS = 32


def whole_text(column: Column) -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(column.cast("string"), F.lit(""))


def small_batches(spark: SparkSession, rows: int = 512, size: int = 32 << 20) -> None:
    """Keep Arrow batches of whole texts small: texts may be very long.

    A batch ends after so many rows or bytes, whichever comes first. Plans read the options when they run,
    so they stay set for the session; smaller values that a user chose are kept.
    """
    for option, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{option}"
        given = int(spark.conf.get(name).removesuffix("b"))
        if given <= 0 or given > most:
            spark.conf.set(name, str(most))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def attach(
    frame: DataFrame, table: DataFrame, keys: list[str], spread: Column, n_rows: int,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join of ``table`` (``n_rows`` rows, unique ``keys``) to ``frame``, nulls equal.

    A table of at most ``broadcast_rows`` rows is broadcast. A larger one is copied to each of
    ``SALTS`` salts and ``frame`` is dealt by key and salt of ``spread``, so a key that holds a
    third of all rows is shared by many tasks.
    """
    renamed = table.select(*[F.col(k).alias(f"_key_{k}") for k in keys],
                           *[c for c in table.columns if c not in keys])
    same = [frame[k].eqNullSafe(renamed[f"_key_{k}"]) for k in keys]
    drop = [f"_key_{k}" for k in keys]
    if n_rows <= broadcast_rows:
        return frame.join(F.broadcast(renamed), _all(same), "left").drop(*drop)
    salted = frame.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    copies = renamed.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, _all(same) & (F.col("_salt") == F.col("_copy")), "left").drop(*drop, "_salt", "_copy")


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out & condition
    return out


#: Bits of the map that tells which rows a join can do without, a multiple of 32,768: eight megabytes.
MAP_BITS = 1 << 26


def may_be_in(keys: list[Column], table: DataFrame, names: list[str], bits: int = MAP_BITS) -> Column:
    """Whether a row's ``keys`` may be among those of ``table`` (columns ``names``); never false for one that is.

    A bit map of a fixed size is broadcast, whatever the table's: a larger table only makes it
    say yes more often. So a join with a table that grows is fed the rows it concerns and few others.
    """
    spark = table.sparkSession
    at = F.pmod(F.xxhash64(*names), F.lit(bits)) + 1
    parts = table.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("n")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("map")
    )
    found = np.zeros(bits // 8, np.uint8)
    for row in parts.collect():  # at most bits / 32,768 rows of 4 KB
        found[(row.n - 1) * 4096 : row.n * 4096] = np.frombuffer(bytes(row["map"]), np.uint8)
    shared = spark.sparkContext.broadcast(found)

    @F.pandas_udf("boolean")
    def held(at: pd.Series) -> pd.Series:
        i = at.to_numpy(np.int64)
        return pd.Series((shared.value[i >> 3] >> (i & 7).astype(np.uint8)) & 1 == 1)

    return held(F.pmod(F.xxhash64(*keys), F.lit(bits)))


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The least member of each of ``n`` nodes' component under the links u-v."""
    root = np.arange(n)
    while len(u):
        a, b = root[u], root[v]
        apart = a != b
        if not apart.any():
            break
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            above = root[root]
            if np.array_equal(above, root):
                break
            root = above
    return root


def components(links: DataFrame) -> DataFrame:
    """As ``components_at``, where the caller's result still reads the folder when it returns."""
    return components_at(links)[0]


def components_at(links: DataFrame) -> tuple[DataFrame, str]:
    """Connected components of links (a, b): one row (node, component), the least node's id; and their folder.

    Only nodes with a link to another one come back. Alternating large and small stars: each
    round points every node's neighbours to the least node around it, by a grouped minimum and
    a join, until nothing moves. A round is written to the shared folder, which cuts the lineage,
    and the round before is removed.
    """
    spark = links.sparkSession
    a, b = F.col("a"), F.col("b")
    edges, path = materialize_at(
        links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "links"
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("m", "a").alias("m"))
        large = both.join(least, F.col("a") == F.col("k")).where(b > a).select(b.alias("a"), F.col("m").alias("b"))
        large = large.where(a != b).distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(down.withColumnRenamed("a", "k"), F.col("a") == F.col("k")).where(b != F.col("m"))
        small = moved.select(F.greatest(b, F.col("m")).alias("a"), F.least(b, F.col("m")).alias("b"))
        small = small.unionByName(down.select(a, F.col("m").alias("b"))).where(a != b).distinct()
        after, new_path = materialize_at(small, "links")
        seen = tuple(after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        discard(spark, path)
        edges, path = after, new_path
        if seen == before:
            break
        before = seen
    every = edges.select(a.alias("node"), b.alias("component")).unionByName(
        edges.select(b.alias("node"), b.alias("component")).distinct()
    )
    return every, path
