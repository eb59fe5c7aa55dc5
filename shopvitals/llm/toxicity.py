"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A document's probability is the noisy-or of its sentences' and of a leak that stands for labels
no sentence explains, 1 - (1 - leak) prod(1 - p). Sentence weights are fitted so that these match
the document labels, and then point at the sentences that offend. Features of a sentence are its
distinct words and their beginnings, as far as they are tied to toxic labels. Sentences of over 40
words count as several.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shopvitals.llm.common import small_batches, whole_text

#: Bounds of the sample the model is fitted on: labelled documents of each class (those with the
#: least hashed ids), and the length up to which a document is taken into it.
SAMPLE_TOXIC, SAMPLE_CLEAN, SAMPLE_CHARS = 1500, 3000, 20_000
#: Documents that must have a feature, and the chi-square by which it must be tied to the label.
MIN_DOCS, MIN_TIE = 3, 12.0
MAX_WORDS = 40
CACHED_WORDS = 400_000
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")


def sentences(text: str):
    """(start, end, words) of the pieces that are scored; none for a text without words."""
    for m in SENTENCE.finditer(text):
        found = list(WORD.finditer(m[0].lower())) if m[0].isascii() else None
        if found is None:  # lower-casing may change a length
            words = [x[0].lower() for x in WORD.finditer(m[0])]
        else:
            words = [x[0] for x in found]
        for i in range(0, len(words), MAX_WORDS):
            yield m.start(), m.end(), words[i : i + MAX_WORDS]


def features(word: str) -> list[int]:
    return [zlib.crc32(b"%d " % n + word[:n].encode("utf-8", "replace")) for n in (3, 4, 5, 6) if n < len(word)] + [
        zlib.crc32(word.encode("utf-8", "replace"))
    ]


@dataclass
class Model:
    bias: float
    leak: float
    weights: dict[int, float]

    def word(self, word: str, cache: dict[str, float]) -> float:
        if (value := cache.get(word)) is None:
            if len(cache) > CACHED_WORDS:
                cache.clear()
            value = cache[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return value

    def score(self, text: str | None, cache: dict[str, float]) -> tuple[float, float, int, int]:
        """Document probability; the worst sentence's probability, start and end."""
        clean, worst, start, end = 0.0, -1e9, 0, 0
        get = cache.get
        logits = []
        for a, b, words in sentences(text or ""):
            z = self.bias
            for w in set(words):
                v = get(w)
                z += self.word(w, cache) if v is None else v
            logits.append(z)
            if z > worst:
                worst, start, end = z, a, b
        if not logits:
            return 0.0, 0.0, 0, 0
        clean = np.logaddexp(0.0, [self.leak, *logits]).sum()
        return float(-np.expm1(-clean)), float(1 / (1 + np.exp(-max(worst, -700.0)))), start, end


def fit(texts: list[str], labels: list[int], rounds: int = 200, penalty: float = 1e-4) -> Model:
    """Maximum likelihood of the document labels under the noisy-or, by scaled gradient steps.

    Features of fewer than MIN_DOCS documents, and ones that toxic documents do not have clearly
    more often, are left out. Without both classes, nothing is learnt and every score is near 0 (or
    near 1, if all are toxic).
    """
    y = np.asarray(labels, dtype=float)
    if len(y) == 0 or y.min() == y.max():
        return Model(8.0 if len(y) and y.max() == 1 else -12.0, -12.0, {})
    n_all, n_toxic = Counter(), Counter()
    for text, label in zip(texts, labels):
        words = {w for _, _, words in sentences(text or "") for w in words}
        seen = {f for w in words for f in features(w)}
        n_all.update(seen)
        if label:
            n_toxic.update(seen)
    rate, kept = y.mean(), {}
    for f, toxic in n_toxic.items():
        n = n_all[f]
        if n >= MIN_DOCS and toxic > rate * n:
            tie = (toxic - rate * n) ** 2 / (rate * (1 - rate) * n * (1 - n / (len(y) + 1)))
            if tie >= MIN_TIE:
                kept[f] = 0
    n_all.clear()
    for i, f in enumerate(sorted(kept)):
        kept[f] = i
    # sentences without a kept feature differ in nothing, so a document only counts them
    row, at, doc_of, plain, cache = [], [], [], np.zeros(len(y)), {}
    for d, text in enumerate(texts):
        for _, _, words in sentences(text or ""):
            known: set[int] = set()
            for w in set(words):
                if w not in cache:
                    cache[w] = [kept[f] for f in features(w) if f in kept]
                known.update(cache[w])
            if known:
                row += [len(doc_of)] * len(known)
                at += known
                doc_of.append(d)
            else:
                plain[d] += 1
    row, at, doc_of = (np.asarray(x, dtype=np.int64) for x in (row, at, doc_of))
    theta = np.concatenate([np.full(len(kept), 1.0), [-8.0, -4.0]])  # weights, bias, leak
    square = np.full(len(theta), 1e-3)
    sigmoid = lambda x: 1 / (1 + np.exp(-np.clip(x, -35, 35)))
    for _ in range(rounds):
        w, bias, leak = theta[:-2], theta[-2], theta[-1]
        z = bias + np.bincount(row, w[at], len(doc_of))
        clean = np.bincount(doc_of, np.logaddexp(0.0, z), len(y)) + plain * np.logaddexp(0.0, bias) + np.logaddexp(0.0, leak)
        pull = np.where(y > 0, np.exp(-clean) / np.clip(-np.expm1(-clean), 1e-9, 1.0), -1.0)
        g = sigmoid(z) * pull[doc_of]
        step = np.concatenate([
            np.bincount(at, g[row], len(kept)) - penalty * len(y) * w,
            [g.sum() + sigmoid(bias) * (plain * pull).sum(), sigmoid(leak) * pull.sum()],
        ])
        square += step * step
        theta += 0.5 * step / np.sqrt(square)
    return Model(float(theta[-2]), float(theta[-1]), {f: float(theta[i]) for f, i in kept.items()})


def held_out(doc_id):
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(5)) == 0


def learn(
    documents: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN,
    chars: int = SAMPLE_CHARS,
) -> Model:
    """Fit on at most ``toxic`` and ``clean`` labelled documents that are not held out.

    Only documents of up to ``chars`` code points are used to learn; all lengths are scored. Rows
    without a label or id teach nothing; of contradicting labels of a document the toxic one holds.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    texts = documents.where(F.length("text") <= chars).select("doc_id", "text")
    present = known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sample = present.where("toxic = 1").orderBy(*order).limit(toxic).unionByName(
        present.where("toxic = 0").orderBy(*order).limit(clean)
    )
    rows = texts.join(F.broadcast(sample), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text", "toxic").collect()
    rows.sort(key=lambda r: r.doc_id)
    return fit([r.text for r in rows], [r.toxic for r in rows])


def score(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of ``documents`` with score, predicted, worst_score, worst_start and worst_end.

    The last two are the code points of the worst sentence. Null, empty and wordless texts score 0.
    """
    spark = documents.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.bias, model.leak, model.weights))

    @F.pandas_udf("score double, predicted int, worst_score double, worst_start long, worst_end long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, cache = Model(*shared.value), {}
        for batch in batches:
            found = pd.DataFrame(
                [model.score(text, cache) for text in batch],
                columns=["score", "worst_score", "worst_start", "worst_end"],
            )
            found.insert(1, "predicted", (found["score"] >= 0.5).astype("int32"))
            yield found

    added = ["score", "predicted", "worst_score", "worst_start", "worst_end"]
    kept = [c for c in documents.columns if c not in (*added, "_found")]
    return documents.select(*kept, run(whole_text(F.col("text"))).alias("_found")).select(
        *kept, *[F.col(f"_found.{c}") for c in added]
    )


def without_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The documents that are not predicted toxic, with their own columns."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast((model.bias, model.leak, model.weights))

    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model, cache = Model(*shared.value), {}
        for batch in batches:
            yield pd.Series([model.score(text, cache)[0] < 0.5 for text in batch], dtype=bool)

    return documents.where(clean(whole_text(F.col("text"))))
