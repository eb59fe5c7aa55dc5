"""Secrets by sliding-window entropy, beside three fixed patterns.

Candidate strings are the long runs of characters that keys are written with. Each belongs to the
narrowest character class that holds all of it. A window slides over it and the Shannon entropy of
its characters follows from counts that change by one character in and one out; windows that reach
their class's entropy are joined to spans. An allow-list suppresses what is known to be no secret.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shopvitals.llm.common import small_batches, whole_text

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: Least lengths of the secret part of a match.
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: A text without any of these in lower case has no assignment.
CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")


@dataclass(frozen=True)
class CharacterClass:
    """Characters, the window's length, the bits a window must reach, and what a string must hold."""

    kind: str
    characters: re.Pattern
    window: int
    bits: float
    holds: tuple[re.Pattern, ...]


_DIGIT, _LOWER, _UPPER, _LETTER = (re.compile(p) for p in ("[0-9]", "[a-z]", "[A-Z]", "[A-Za-z]"))
#: From narrow to wide. Twenty random characters have about 3.5, 3.9 and 4.1 bits, twenty of a word 3.3.
CLASSES = (
    CharacterClass("entropy_hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 20, 3.0, (_DIGIT, _LETTER)),
    CharacterClass("entropy_base36", re.compile(r"[0-9a-z]+|[0-9A-Z]+"), 20, 3.6, (_DIGIT, _LETTER)),
    CharacterClass("entropy_base64", re.compile(r"[A-Za-z0-9+/_-]+"), 20, 3.8, (_DIGIT, _LOWER, _UPPER)),
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
#: The kinds in the order in which spans of equal start are listed; the first three are the base.
BASE = ("assign", "access", "hex")
KINDS = BASE + tuple(c.kind for c in CLASSES)
#: Candidates that are no secrets: identifiers, placeholders, counted-out alphabets and known digests.
ALLOWED = (
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    r"(?i).*(example|sample|dummy|placeholder|changeme|your[_-]|xxxx).*",
    r"(?i).*(abcdefghij|0123456789|1234567890|qwertyuiop).*",
    "da39a3ee5e6b4b0d3255bfef95601890afd80709",
    "d41d8cd98f00b204e9800998ecf8427e",
    "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
)
#: What stands before a digest that is published on purpose.
PUBLIC = re.compile(r"(?i)(?:sha-?(?:1|224|256|384|512)|md5|checksum|integrity|commit)[\"']?\s{0,3}[:=-]?\s{0,3}[\"']?$")

_ONE = 1 << 32  # entropies are kept as whole numbers of 2 ** -32 bits, so that a long slide does not drift


def _weight(count: int) -> int:
    """count * log2(count) in fixed point."""
    return round(count * math.log2(count) * _ONE) if count > 1 else 0


def hot_windows(text: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Maximal stretches of ``text`` covered by overlapping or touching windows of at least ``bits`` entropy."""
    if len(text) < window:
        return []
    weights = [_weight(n) for n in range(window + 2)]
    most = round((math.log2(window) - bits) * window * _ONE)  # H = log2 w - sum(n log2 n) / w
    counts: dict[str, int] = {}
    total, found = 0, []
    for i, new in enumerate(text):
        n = counts.get(new, 0)
        total += weights[n + 1] - weights[n]
        counts[new] = n + 1
        if i >= window:
            old = text[i - window]
            n = counts[old]
            total += weights[n - 1] - weights[n]
            counts[old] = n - 1
        if i >= window - 1 and total <= most:
            start = i - window + 1
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three fixed patterns."""
    found = []
    low = text.lower()
    if any(cue in low for cue in CUES):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(*m.span(), "hex") for m in _LONG_HEX.finditer(text)]
    return found


# A whole run of hexadecimal digits is one match of HEX; only those of the least length are looked for.
_LONG_HEX = re.compile(f"{HEX.pattern[:-1]}{{{LEAST['hex']},}}")


def entropy_spans(text: str, allowed: re.Pattern, classes=CLASSES) -> list[tuple[int, int, str]]:
    """(start, end, kind) of high-entropy stretches of candidates that the allow-list does not suppress."""
    found = []
    for m in CANDIDATE.finditer(text):
        string = m[0]
        own = next((c for c in classes if c.characters.fullmatch(string)), None)
        if own is None or not all(p.search(string) for p in own.holds):
            continue
        if allowed.fullmatch(string) or PUBLIC.search(text[max(0, m.start() - 24) : m.start()]):
            continue
        found += [(m.start() + a, m.start() + b, own.kind) for a, b in hot_windows(string, own.window, own.bits)]
    return found


def allow_list(patterns) -> re.Pattern:
    """One pattern of all that is allowed; with none, nothing is."""
    return re.compile("|".join(f"(?:{_local_flags(p)})" for p in patterns) or r"(?!)", re.S)


def _local_flags(pattern: str) -> str:
    return f"(?i:{pattern[4:]})" if pattern.startswith("(?i)") else pattern


def spans(text: str, allowed: re.Pattern | None = None) -> list[tuple[int, int, str]]:
    """All spans by start and kind; code points, end exclusive.

    The patterns' matches always stay. Entropy adds spans that no match covers whole.
    """
    base = base_spans(text)
    more = entropy_spans(text, allow_list(ALLOWED) if allowed is None else allowed)
    more = [s for s in more if not any(a <= s[0] and s[1] <= b for a, b, _ in base)] if base else more
    return sorted(base + more, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def find(documents: DataFrame, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """doc_id, the number of spans of each base kind and by entropy, base_sha256 and all spans of whole texts.

    ``allowed`` are patterns of whole candidates that entropy does not report. Null and empty texts
    have no span and the digest of the empty text. Each row gives one row, repeated ones too; other
    columns are dropped.
    """
    small_batches(documents.sparkSession)
    counts = ", ".join(f"n_{kind} long" for kind in BASE)

    @F.pandas_udf(f"{counts}, n_entropy long, base_sha256 string, spans string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = allow_list(allowed)
        for batch in batches:
            every = [spans(text, known) for text in batch]
            base = [[s for s in found if s[2] in BASE] for found in every]
            out = {f"n_{kind}": [sum(s[2] == kind for s in found) for found in base] for kind in BASE}
            out["n_entropy"] = [len(found) - len(own) for found, own in zip(every, base)]
            out["base_sha256"] = [hashlib.sha256(listed(found).encode()).hexdigest() for found in base]
            out["spans"] = [listed(found) for found in every]
            yield pd.DataFrame(out)

    return documents.select("doc_id", run(whole_text(F.col("text"))).alias("found")).select("doc_id", "found.*")
