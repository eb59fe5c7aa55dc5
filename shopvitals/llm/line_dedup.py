"""Line dedup by site-relative frequency.

Pages are grouped by host. A line's frequency is the number of the host's pages that contain it
divided by all pages of the host; lines above the boilerplate ratio are dropped wherever they stand
on that host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopvitals.llm.common import BROADCAST_ROWS, attach, whole_text
from shopvitals.session import materialize

#: Lines of more than this share of a host's pages go, if they repeat: stand on at least so many pages. Without
#: the second a host of fewer than 1 / RATIO pages would lose every line.
RATIO, MIN_PAGES = 0.05, 2


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(line))


def _filled(line: Column) -> Column:
    return F.regexp_like(line, F.lit(r"[^ \t\n\x0B\f\r]"))


def boilerplate(pages: DataFrame, host: str, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, drop: the digests of each host's boilerplate lines.

    A host has at most (mean lines of a page) / ratio of them. Each page is counted once for a line
    however often it has it; counts are summed before they are shuffled, so neither a line that is
    everywhere nor a host with a third of all pages makes a large task.
    """
    lines = pages.select(
        F.col(host).alias("host"),
        F.explode(F.array_distinct(F.transform(F.filter(F.split(whole_text(F.col("text")), "\n", -1), _filled), _digest))).alias("line"),
    )
    counts = lines.groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = materialize(pages.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("pages")), "hosts")
    heavy = attach(counts, totals, ["host"], F.col("line"), totals.count()).where(F.col("n") > F.col("pages") * ratio)
    return heavy.groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("drop"))


def without_boilerplate(
    pages: DataFrame, host: str, ratio: float = RATIO, min_pages: int = MIN_PAGES, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """All columns of ``pages``; ``text`` without boilerplate lines, and the counts n_lines and n_dropped.

    Lines end with ``\\n`` and are compared as they are. Lines of white space only are neither
    counted nor dropped. Null texts stay null; a null host is a host of its own. Rows stay, even
    if nothing is left of their text.
    """
    heavy = materialize(boilerplate(pages, host, ratio, min_pages), "boilerplate")
    named = pages.drop("n_lines", "n_dropped", "_host").withColumn("_host", F.col(host))
    heavy = heavy.select(F.col("host").alias("_host"), "drop")
    joined = attach(named, heavy.withColumnRenamed("drop", "_drop"), ["_host"], F.col("text"), heavy.count(), broadcast_rows)
    lines = F.split("text", "\n", -1)
    kept = F.filter(lines, lambda x: ~(_filled(x) & F.array_contains("_drop", _digest(x))))
    return (
        joined.withColumn("_kept", F.when(F.col("_drop").isNull(), lines).otherwise(kept))
        .withColumn("n_lines", F.coalesce(F.size(lines), F.lit(0)).cast("long"))
        .withColumn("n_lines", F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines")))
        .withColumn("n_dropped", F.when(F.col("text").isNull(), 0).otherwise(F.col("n_lines") - F.size("_kept")).cast("long"))
        .withColumn("text", F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(F.array_join("_kept", "\n")))
        .select(*[c for c in pages.columns if c not in ("n_lines", "n_dropped", "_host")], "n_lines", "n_dropped")
    )
