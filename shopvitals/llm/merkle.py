"""Document fingerprints: Merkle trees over paragraphs and sections, in SQL functions only.

Leaves are pieces of up to three words that end with a sentence; a paragraph (line) is the hash
of its leaves, a section (paragraphs up to a blank line) the hash of its paragraphs, the root the
hash of the sections. A fingerprint is ``root;sections;paragraphs;leaves`` with shortened hashes
below the root, so that two of them tell equality (roots), where they differ (sections, then
paragraphs) and how alike they are (leaves).

The empty text and a null one have the same tree: one empty paragraph. Paragraphs that are empty
are written "-" and are no place of an edit. Every character of a text is in some leaf, white space
included, so texts differ exactly if their roots do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopvitals.llm.common import shuffle_partitions, whole_text

SPACE = " \\t\\r\\n"
#: Up to two words that do not end a sentence, then one more; runs without a space are cut at 200.
LEAF = (f"[{SPACE}]*(?:[^{SPACE}]{{0,199}}[^{SPACE}.!?][{SPACE}]+){{0,2}}[^{SPACE}]{{1,200}}[{SPACE}]*|[{SPACE}]+")
SECTION = "[^#]+#*|#+"
BUCKETS_PER_PARTITION = 4


def with_fingerprint(frame: DataFrame, text: str, out: str) -> DataFrame:
    """Add the fingerprint of column ``text`` as ``out``."""
    leaves, paragraphs, sections = f"_{out}_l", f"_{out}_p", f"_{out}_s"
    pattern = F.lit(LEAF)
    frame = frame.withColumn(
        leaves,
        F.transform(
            F.split(whole_text(F.col(text)), "\n", -1),
            lambda p: F.transform(F.regexp_extract_all(p, pattern, F.lit(0)), lambda x: F.sha2(x, 256)),
        ),
    )
    frame = frame.withColumn(
        paragraphs,
        F.transform(leaves, lambda x: F.when(F.size(x) == 0, "#").otherwise(F.sha2(F.array_join(x, ""), 256))),
    )
    frame = frame.withColumn(
        sections,
        F.transform(
            F.regexp_extract_all(F.array_join(paragraphs, ""), F.lit(SECTION), F.lit(0)), lambda x: F.sha2(x, 256)
        ),
    )
    short = lambda x: F.substring(x, 1, 16)
    return frame.withColumn(
        out,
        F.concat_ws(
            ";",
            F.sha2(F.array_join(sections, ""), 256),
            F.array_join(F.transform(sections, short), ","),
            F.array_join(F.transform(paragraphs, lambda x: F.when(x == "#", "-").otherwise(short(x))), ","),
            F.array_join(
                F.transform(leaves, lambda x: F.array_join(F.transform(x, lambda y: F.substring(y, 1, 8)), " ")), ","
            ),
        ),
    ).drop(leaves, paragraphs, sections)


def _leaves(fingerprint: Column) -> Column:
    parts = F.split(F.translate(F.substring_index(fingerprint, ";", -1), ",", " "), " ")
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def with_likeness(frame: DataFrame, one: str, other: str, out: str) -> DataFrame:
    """Add twice the shared distinct leaves by the sum of both, from two fingerprints.

    1 if neither has a leaf or both are equal; null if one is null.
    """
    frame = frame.withColumn("_one", _leaves(F.col(one))).withColumn("_other", _leaves(F.col(other)))
    total = F.size("_one") + F.size("_other")
    shared = F.size(F.array_intersect("_one", "_other"))
    return frame.withColumn(
        out,
        F.when(F.col(one).isNull() | F.col(other).isNull(), None)
        .when(total == 0, 1.0)
        .otherwise(2.0 * shared / total),
    ).drop("_one", "_other")


def edited_paragraphs(one: Column, other: Column) -> Column:
    """Positions (from 1) of the paragraphs of ``one`` that ``other`` does not have.

    Equal roots end the comparison at once.
    """
    mine, theirs = (F.split(F.split(x, ";")[2], ",") for x in (one, other))
    same = F.substring_index(one, ";", 1) == F.substring_index(other, ";", 1)
    places = F.transform(mine, lambda p, i: F.when((p != "-") & ~F.array_contains(theirs, p), i + 1))
    return F.when(same, F.array().cast("array<int>")).otherwise(F.filter(places, lambda i: i.isNotNull()))


def with_next(frame: DataFrame, key: str, columns: list[str], order: list[str]) -> DataFrame:
    """Add ``next_<column>``: the columns' values in the row with the next ``key``; after the last, the first.

    Rows are dealt to ranges of ``key``, whose bounds are keys at even ranks. A row at a bound also
    goes to the range before, where it only serves as a successor; so one shuffle is enough. Equal
    keys follow ``order``. Rows without a key have no successor: their columns are null.
    """
    spark = frame.sparkSession
    n = BUCKETS_PER_PARTITION * shuffle_partitions(spark)
    bounds = frame.agg(
        F.percentile_approx(key, [i / n for i in range(1, n)], 20 * n).alias("bounds"), F.min(key).alias("least")
    ).first()
    if bounds.least is None:
        empty = [F.lit(None).cast(frame.schema[c].dataType).alias(f"next_{c}") for c in columns]
        return frame.select("*", *empty)
    starts = sorted({bounds.least, *bounds.bounds})
    known = F.array(*[F.lit(s) for s in starts])
    own = F.size(F.filter(known, lambda s: s <= F.col(key)))
    before = F.when(own == 1, len(starts)).otherwise(own - 1)
    at_bound = F.array_contains(known, F.col(key))
    nowhere = -F.pmod(F.xxhash64(*order), F.lit(n)).cast("int")
    dealt = frame.withColumn(
        "_at",
        F.explode(
            F.when(F.col(key).isNull(), F.array(F.struct(nowhere.alias("range"), F.lit(False).alias("guest"))))
            .when(
                at_bound,
                F.array(
                    F.struct(own.alias("range"), F.lit(False).alias("guest")),
                    F.struct(before.alias("range"), F.lit(True).alias("guest")),
                ),
            )
            .otherwise(F.array(F.struct(own.alias("range"), F.lit(False).alias("guest"))))
        ),
    ).select(*frame.columns, F.col("_at.range").alias("_range"), F.col("_at.guest").alias("_guest"))
    from pyspark.sql import Window

    window = Window.partitionBy("_range").orderBy("_guest", key, *order)
    followed = [F.when(F.col(key).isNotNull(), F.lead(c).over(window)).alias(f"next_{c}") for c in columns]
    return dealt.select("*", *followed).where(~F.col("_guest")).drop("_range", "_guest")


def fingerprint_edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are.

    The edited text has the last quarter of its code points replaced by the first as many of the
    next document's (by doc_id, the last followed by the first; repeated ids by text). A row
    without doc_id is followed by none: the quarter goes and nothing replaces it. Other columns of
    the input are not read.
    """
    docs = documents.select("doc_id", whole_text(F.col("text")).alias("text"))
    docs = with_next(with_fingerprint(docs, "text", "fingerprint"), "doc_id", ["text", "fingerprint"], ["text"])
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    docs = docs.withColumn(
        "edited",
        F.concat(
            F.expr("left(text, cast(n_chars - floor(n_chars / 4) as int))"),
            F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut),
        ),
    )
    docs = with_fingerprint(docs.drop("text", "next_text"), "edited", "edited_fingerprint")
    docs = with_likeness(docs, "fingerprint", "edited_fingerprint", "near_edited")
    docs = with_likeness(docs, "fingerprint", "next_fingerprint", "near_next")
    return docs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next",
        F.array_join(edited_paragraphs(F.col("fingerprint"), F.col("edited_fingerprint")).cast("array<string>"), ",").alias("edited_at"),
    )
