"""Phrase collocations by weighted acyclic automata over words.

Every word starts a path of up to five words, cut at the end of its piece. A task sorts the paths of
a block of words and freezes them as a count transducer: each path keeps only what follows the prefix
it shares with the path before, with the number of times it occurs. Transducers are cut by prefix
ranges; a range's transducers from all blocks are united, their weights summed, and the weight of
every prefix read off. So n-grams of all lengths travel as one path per distinct window, and a hot
word or passage is spread over as many ranges as it fills.

Parts of a phrase are looked up by composition with the same kind of path: in the order of the words,
the counts of a phrase's first parts lie on the path to it; in the order of the reversed words, the
counts of its last parts do. Both walks go range by range; a range also gets the few prefixes of its
first path.
"""

from __future__ import annotations

import pickle
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from shopvitals.llm.common import attach, shuffle_partitions, small_batches
from shopvitals.session import discard, materialize, materialize_at

#: Longest phrases, least count of a phrase, phrases listed for each language.
LONGEST, LEAST, LISTED = 5, 100, 2000
#: Words that a task freezes at a time; paths and words that a range gathers before it unites them.
BLOCK, GATHERED = 1 << 20, 1 << 18
#: Bytes of text for each prefix range, and at least one range for each shuffle partition.
RANGE_BYTES = 5 << 20
#: Bounds of the sample that ranges are planned on: documents of the least hashed ids, paths of each.
SAMPLE, SAMPLE_PATHS = 2048, 256
#: Rows of the count table for each bound when parts are looked up.
PER_BOUND = 16
#: Bytes of a text that are cut into words at a time.
CHUNK = 1 << 20

#: A-Z to a-z, tabs to spaces, what ends a piece to a newline.
FOLD = bytes(
    10 if b in b".,;:!?" or 10 <= b <= 13 else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
CUT = re.compile(rb"[ \n]")


# ------------------------------------------------------------------------ transducers


def word_ids(text: bytes, vocabulary: defaultdict) -> np.ndarray:
    """Numbers of a text's words, 0 where a piece ends."""
    text, start, parts = text.translate(FOLD), 0, []
    while start < len(text):
        cut = CUT.search(text, start + CHUNK)
        end = cut.start() if cut else len(text)
        words = text[start:end].replace(b"\n", b" \n ").split(b" ")
        parts.append(np.fromiter(map(vocabulary.__getitem__, filter(None, words)), np.int32))
        start = end
    return np.concatenate(parts) if parts else np.array([], np.int32)


def new_vocabulary() -> defaultdict:
    """Numbers words as they come, the end of a piece as 0."""
    vocabulary: defaultdict = defaultdict()
    vocabulary.default_factory = vocabulary.__len__
    vocabulary[b"\n"]
    return vocabulary


def united(cols: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Paths (one array of word numbers a place, 0 after the end) in order, equal ones summed."""
    if not len(counts):
        return cols, counts
    width = max(1, max(int(c.max()) for c in cols).bit_length())
    key, used = cols[0].astype(np.uint64), width
    for col in cols[1:]:
        if used + width > 64:
            distinct, key = np.unique(key, return_inverse=True)
            key, used = key.astype(np.uint64), len(distinct).bit_length()
        key, used = (key << np.uint64(width)) | col.astype(np.uint64), used + width
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    del key
    first = order[starts]
    return [c[first] for c in cols], np.add.reduceat(counts[order], starts)


def shared(cols: list[np.ndarray]) -> np.ndarray:
    """How many words each path has in common with the path before it."""
    n = np.zeros(len(cols[0]), np.uint8)
    same = np.ones(max(0, len(n) - 1), bool)
    for col in cols:
        same &= col[1:] == col[:-1]
        n[1:] += same
    return n


def freeze(names: list[bytes], cols: list[np.ndarray], counts: np.ndarray) -> bytes:
    """A transducer of sorted distinct paths: shared prefix, the words after it, count."""
    depth = shared(cols)
    arcs = [c[depth <= j] for j, c in enumerate(cols)]
    used = np.unique(np.concatenate(arcs))
    used = used[used > 0]
    kind = np.min_scalar_type(len(used) + 1)
    arcs = [np.where(a > 0, np.searchsorted(used, a) + 1, 0).astype(kind) for a in arcs]
    weights = counts.astype(np.min_scalar_type(int(counts.max())))
    body = pickle.dumps((b" ".join(names[i - 1] for i in used), depth, arcs, weights), 5)
    return zstandard.ZstdCompressor(level=1).compress(body)


def thaw(blob: bytes) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """The sorted words, paths and counts of a transducer."""
    text, depth, arcs, weights = pickle.loads(zstandard.ZstdDecompressor().decompress(blob))
    cols = [a.astype(np.int32)[np.cumsum(depth <= j) - 1] for j, a in enumerate(arcs)]
    return text.split(b" "), cols, weights.astype(np.int64)


def union(parts: list[tuple[list[bytes], list[np.ndarray], np.ndarray]]) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """One transducer that accepts what ``parts`` do, with summed weights."""
    names = sorted({w for own, _, _ in parts for w in own})
    at = {w: i for i, w in enumerate(names, 1)}
    numbers = [np.array([0, *(at[w] for w in own)], np.int32) for own, _, _ in parts]
    del at
    cols = [np.concatenate([number[p[1][j]] for number, p in zip(numbers, parts)]) for j in range(len(parts[0][1]))]
    return names, *united(cols, np.concatenate([p[2] for p in parts]))


def place(names: list[bytes], cols: list[np.ndarray], path: tuple[bytes, ...]) -> int:
    """How many of the sorted paths come before ``path``."""
    low, high = 0, len(cols[0])
    for j, word in enumerate(path):
        i = bisect_left(names, word)
        low, end = (low + int(np.searchsorted(cols[j][low:high], i + 1, side)) for side in ("left", "right"))
        if i == len(names) or names[i] != word or low == end:
            return low
        high = end
    return low


def weights_of(names: list[bytes], cols: list[np.ndarray], counts: np.ndarray, least: int) -> Iterator[tuple[bytes, int]]:
    """Prefixes and their weights, those of at least ``least`` and those a neighbouring range may share."""
    new = np.zeros(len(counts), bool)
    new[:1] = True
    for j, col in enumerate(cols):
        new[1:] |= col[1:] != col[:-1]
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(counts, starts)
        keep = sums >= least
        keep[0] = keep[-1] = True
        keep &= col[starts] > 0
        for i, n in zip(starts[keep].tolist(), sums[keep].tolist()):
            yield b" ".join(names[c[i] - 1] for c in cols[: j + 1]), n


# ------------------------------------------------------------------------------ counts


def _texts(documents: DataFrame) -> DataFrame:
    """lang (null: und) and the bytes of the text (null: empty)."""
    return documents.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )


def range_bounds(documents: DataFrame, n_ranges: int, longest: int) -> list[tuple[str, tuple[bytes, ...]]]:
    """Paths that cut the sample's paths into ``n_ranges`` equal parts; they steer the load, never the result."""
    if n_ranges < 2:
        return []
    ids = documents.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE).distinct()
    sample = _texts(documents.join(F.broadcast(ids), "doc_id", "left_semi").limit(2 * SAMPLE))

    def run(batches):
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                words = [p.split(b" ") for p in text.translate(FOLD).split(b"\n")]
                words = [[w for w in p if w] for p in words]
                paths = [(p, i) for p in words for i in range(len(p))]
                step = max(32, -(-len(paths) // SAMPLE_PATHS))
                found = [b" ".join(p[i : i + longest]) for p, i in paths[:: step]]
                yield pd.DataFrame({"lang": [lang] * len(found), "path": found}, dtype=object)

    paths = sorted((r.lang, tuple(bytes(r.path).split(b" "))) for r in sample.mapInPandas(run, "lang string, path binary").collect())
    return sorted({paths[len(paths) * i // n_ranges] for i in range(1, n_ranges)}) if paths else []


def _frozen(batches, bounds, longest: int) -> Iterator[pd.DataFrame]:
    """Transducers of a task's texts, one for each block, language and range."""
    langs = [lang for lang, _ in bounds]
    vocabulary, held, n_held = new_vocabulary(), defaultdict(list), 0

    def flush():
        names = sorted(w for w in vocabulary if w != b"\n")
        number = np.zeros(len(vocabulary), np.int32)
        for i, w in enumerate(names, 1):
            number[vocabulary[w]] = i
        rows = []
        for lang, parts in held.items():
            words = number[np.concatenate([p for p, _ in parts])]
            begins = np.concatenate([np.arange(len(p)) < n for p, n in parts])
            begins = np.flatnonzero(begins & (words > 0))
            cols = [words[begins]]
            for j in range(1, longest):
                cols.append(np.where(cols[-1] > 0, words[begins + j], 0))
            if not len(begins):
                continue
            cols, counts = united(cols, np.ones(len(begins), np.int64))
            first = bisect_left(langs, lang)
            cuts = [place(names, cols, path) for _, path in bounds[first : bisect_right(langs, lang)]]
            for i, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(counts)])):
                if a < b:
                    rows.append((first + i, lang, freeze(names, [c[a:b] for c in cols], counts[a:b])))
        return pd.DataFrame(rows, columns=["range", "lang", "paths"]).astype({"range": "int32"})

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            ids = word_ids(text, vocabulary)
            for at in range(0, len(ids), BLOCK):
                n = min(BLOCK, len(ids) - at)
                held[lang].append((np.concatenate([ids[at : at + n + longest - 1], np.zeros(longest, np.int32)]), n))
                n_held += n
                if n_held >= BLOCK:
                    yield flush()
                    held.clear()
                    n_held = 0
                    if at + n == len(ids):  # the rest of a very long text is still numbered by this vocabulary
                        vocabulary = new_vocabulary()
    if n_held:
        yield flush()


def _united(batches, least: int) -> Iterator[pd.DataFrame]:
    """Counts (lang, phrase, n) of a partition sorted by range and language; the empty phrase counts words."""
    key, parts, n_new = None, [], 0

    def close():
        if not parts:
            return
        names, cols, counts = union(parts)
        rows = [(b"", int(counts.sum())), *weights_of(names, cols, counts, least)]
        yield pd.DataFrame({"lang": key[1], "phrase": [p for p, _ in rows], "n": [n for _, n in rows]})

    for batch in batches:
        for at, lang, blob in zip(batch["range"], batch["lang"], batch["paths"]):
            if (at, lang) != key:
                yield from close()
                key, parts, n_new = (at, lang), [], 0
            parts.append(thaw(blob))
            n_new += len(parts[-1][0]) + len(parts[-1][2])
            if n_new > GATHERED:
                parts, n_new = [union(parts)], 0
    yield from close()


def counted(documents: DataFrame, longest: int = LONGEST, least: int = LEAST) -> DataFrame:
    """lang, phrase, n: phrases of 1 to ``longest`` words that occur ``least`` times, and each lang's words as ''.

    Every occurrence counts, overlapping ones too, within pieces between punctuation or line ends.
    """
    spark = documents.sparkSession
    small_batches(spark, 256)
    texts = _texts(documents)
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bounds = range_bounds(documents, max(shuffle_partitions(spark), -(-n_bytes // RANGE_BYTES)), longest)
    frozen = texts.mapInPandas(lambda b: _frozen(b, bounds, longest), "range int, lang string, paths binary")
    placed = frozen.repartition(len(bounds) + 1, "range").sortWithinPartitions("range", "lang")
    found = placed.mapInPandas(lambda b: _united(b, least), "lang string, phrase binary, n long")
    sums = found.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("n"))
    return sums.where((F.col("n") >= least) | (F.col("phrase") == ""))


# --------------------------------------------------------------------------- part lookup


def with_parts(counts: DataFrame, name: str, backwards: bool) -> DataFrame:
    """``counts`` (lang, phrase, n, ...) with the counts of the first 1, 2, ... words as ``name``; backwards, of the last.

    Phrases are sorted into ranges by their words, or their words from the last. A phrase's parts
    lie on the path to it; those that belong to a range before are its guests, at most a phrase's
    length of them, however many phrases share them.
    """
    spark = counts.sparkSession
    n_ranges = shuffle_partitions(spark)
    step = -1 if backwards else 1
    sample = counts.select("lang", "phrase").orderBy(F.xxhash64("lang", "phrase")).limit(PER_BOUND * n_ranges).collect()
    paths = sorted((r.lang, tuple(r.phrase.split(" ")[::step])) for r in sample)
    bounds = paths[PER_BOUND::PER_BOUND]
    guests: dict[tuple[str, tuple[str, ...]], list[int]] = defaultdict(list)
    for i, (lang, path) in enumerate(bounds, 1):
        for k in range(1, len(path)):
            guests[lang, path[:k]].append(i)
    columns = counts.columns
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in counts.schema)

    def deal(batches):
        for batch in batches:
            keys = [(lang, tuple(p.split(" ")[::step])) for lang, p in zip(batch["lang"], batch["phrase"])]
            home = batch.assign(_range=[bisect_right(bounds, k) for k in keys], _guest=False, _path=[list(k[1]) for k in keys])
            yield home
            also = [(i, at) for i, k in enumerate(keys) for at in guests.get(k, ())]
            if also:
                out = home.iloc[[i for i, _ in also]].copy()
                out["_range"], out["_guest"] = [at for _, at in also], True
                yield out

    def walk(batches):
        where, path = None, []  # counts of the prefixes on the way to the last phrase
        words: list[str] = []
        for batch in batches:
            found = []
            for at, lang, own, n in zip(batch["_range"], batch["lang"], batch["_path"], batch["n"]):
                own = list(own)
                if (at, lang) != where:
                    where, words, path = (at, lang), [], []
                k = 0
                while k < min(len(words), len(own)) and words[k] == own[k]:
                    k += 1
                words, path = own, path[:k]
                found.append(list(path))
                if len(path) != len(own) - 1:
                    raise ValueError("a phrase is counted and a part of it is not")
                path.append(n)
            out = batch[columns].assign(**{name: found})
            yield out[~batch["_guest"].to_numpy(bool)]

    dealt = counts.mapInPandas(deal, f"{fields}, _range int, _guest boolean, _path array<string>")
    placed = dealt.repartition(n_ranges, "_range").sortWithinPartitions("_range", "lang", "_path")
    return placed.mapInPandas(walk, f"{fields}, {name} array<long>")


def lowest_cut(a: int, n: int, firsts: list[int], lasts: list[int]) -> tuple[int, int, int]:
    """(l, r, score) of the cut of the lowest score, the first of equal ones; exact whole numbers."""
    size = len(firsts) + 1
    cuts = [(firsts[k - 1], lasts[size - k - 1]) for k in range(1, size)]
    scores = [1000 * a * n // (int(l) * int(r)) for l, r in cuts]
    k = scores.index(min(scores))
    return int(cuts[k][0]), int(cuts[k][1]), scores[k]


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of all phrases of two words or more, and the counts without the last and the first word."""
    totals = counts.where(F.col("phrase") == "").select("lang", F.col("n").alias("total"))
    parts = with_parts(counts.where(F.col("phrase") != ""), "firsts", False)
    parts = with_parts(parts, "lasts", True).where(F.size("firsts") > 0)
    both = attach(parts, totals, ["lang"], F.col("phrase"), totals.count())

    def run(batches):
        for batch in batches:
            cuts = [
                lowest_cut(int(a), int(n), list(x), list(y))
                for a, n, x, y in zip(batch["n"], batch["total"], batch["firsts"], batch["lasts"])
            ]
            yield pd.DataFrame({
                "lang": batch["lang"], "phrase": batch["phrase"], "a": batch["n"],
                "l": [c[0] for c in cuts], "r": [c[1] for c in cuts], "n": batch["total"], "score": [c[2] for c in cuts],
                "first": [x[-1] for x in batch["firsts"]], "last": [y[-1] for y in batch["lasts"]],
            })

    return both.mapInPandas(
        run, "lang string, phrase string, a long, l long, r long, n long, score long, first long, last long"
    )


def collocations(documents: DataFrame, longest: int = LONGEST, least: int = LEAST, listed: int = LISTED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``listed`` phrases by score.

    Phrases have 2 to ``longest`` words and a count ``a`` of at least ``least``. One that a longer
    phrase holds as often goes; it is enough to look one word further, as counts never rise with
    length. Null texts are empty, a null lang is ``und``; repeated rows count each; languages without
    such a phrase have no row. Other columns are not read.
    """
    spark = documents.sparkSession
    counts, counts_path = materialize_at(counted(documents, longest, least), "counts")
    every, every_path = materialize_at(scored(counts), "phrases")
    longer = every.where(F.size(F.split("phrase", " ")) > 2)
    without_last = F.expr("left(phrase, length(phrase) - length(substring_index(phrase, ' ', -1)) - 1)")
    without_first = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    held = longer.where(F.col("a") >= F.col("first")).select("lang", without_last.alias("phrase")).unionByName(
        longer.where(F.col("a") >= F.col("last")).select("lang", without_first.alias("phrase"))
    )
    kept = every.join(held.distinct(), ["lang", "phrase"], "left_anti")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = kept.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= listed)
    out = materialize(out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
    discard(spark, counts_path)
    discard(spark, every_path)
    return out
