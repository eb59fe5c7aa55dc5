"""Byte-level BPE with the tiktoken library and a local rank file.

Long texts are cut at safe boundaries before they are encoded: in front of a space that follows a
letter or digit. The split pattern never joins such a character with the space after it, and what
follows a space decides only from there on, so the pieces' ids are those of the whole text.

Very long runs of white space are cut where the pattern itself cuts them: it takes all but the last
character of a run that something follows, and the whole of one that ends the text. Such a match is
encoded as one piece; the library's own search for it needs a stack as deep as the run.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shopvitals.llm.common import small_batches, whole_text

#: Code points after which a cut is looked for.
PIECE = 20_000
#: Code points of white space from which on a run is a piece of its own.
RUN = 20_000
#: What Unicode calls white space.
SPACE = "[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def encoding(path: str, pattern: str):
    """The encoding of a rank file; each task reads it once."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in order, cut at safe boundaries after at least ``size`` code points each."""
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        while cut > 0 and not text[cut - 1].isalnum():
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def encode(text: str, own, size: int = PIECE, run: int = RUN) -> list[int]:
    """Token ids of a whole text in the encoding ``own``."""
    if len(text) <= min(size, run):
        return own.encode_ordinary(text)
    ids, start = [], 0
    for m in re.finditer(f"{SPACE}{{{max(2, run)},}}", text):
        end = m.end() if m.end() == len(text) else m.end() - 1
        ids += [token for piece in pieces(text[start : m.start()], size) for token in own.encode_ordinary(piece)]
        ids += own._encode_single_piece(text[m.start() : end])
        start = end
    return ids + [token for piece in pieces(text[start:], size) for token in own.encode_ordinary(piece)]


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, encoded and decoded again.

    Null texts count as empty: no token and the digests of no bytes. Each row gives one row; other
    columns are dropped. ``path`` must exist on every executor.
    """
    small_batches(documents.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = encoding(path, pattern)
        for batch in batches:
            rows = []
            for text in batch:
                ids = encode(text, own)
                packed = np.array(ids, dtype="<u4").tobytes()
                rows.append((len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(own.decode_bytes(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", run(whole_text(F.col("text"))).alias("found")).select("doc_id", "found.*")


def encoded(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """All columns with ``ids``, the token ids of the whole text (none of a null one)."""
    small_batches(documents.sparkSession)

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoding(path, pattern)
        for batch in batches:
            yield pd.Series([encode(text, own) for text in batch])

    return documents.withColumn("ids", run(whole_text(F.col("text"))))


def decoded(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """All columns with ``bytes``, what the column ``ids`` stands for (nothing for null)."""

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = encoding(path, pattern)
        for batch in batches:
            yield pd.Series([b"" if x is None else own.decode_bytes(list(x)) for x in batch])

    return documents.withColumn("bytes", run("ids"))
