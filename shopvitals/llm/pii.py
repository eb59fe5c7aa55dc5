"""Personal data by anchor expansion.

One Aho-Corasick pass finds anchors: at-signs, plus signs, digits, schemes and identifier cues.
At each anchor a deterministic local parser expands to the boundaries of an email, network address,
card, phone, url or account and validates it. Anchors inside a span that its kind has already
taken are passed over, so a text is read once per kind at most.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shopvitals.llm.common import small_batches, whole_text

#: The kinds in the order in which spans of equal start are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]
#: What the automaton looks for besides single characters.
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = ("iban", "account", "acct", "passport", "ssn", "konto", "compte", "cuenta")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
URL = re.compile(r"[^\s<>\"']+")
ACCOUNT = re.compile(r"[\s:#.]{0,3}(?:(?:no|number|nr)[\s:#.]{1,3})?([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?|[0-9](?:[ -]?[0-9]){5,17})", re.A | re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def iban(code: str) -> bool:
    code = code.replace(" ", "").upper()
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("+", ("phone", 1))
    for d in "0123456789":
        found.add_word(d, ("digit", 1))
    for kind, words in (("url", SCHEMES), ("account", CUES)):
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


LOWER = {i: i + 32 for i in range(65, 91)}


def _lower_ascii(text: str) -> str:
    return text.lower() if text.isascii() else text.translate(LOWER)


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def spans(text: str, anchors=None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all valid spans, by start and kind; code points, end exclusive."""
    found: list[tuple[int, int, str]] = []
    taken = dict.fromkeys(KINDS, 0)  # where the kind's last match ended, valid or not
    run = -2
    for last, (kind, size) in (anchors or automaton()).iter(_lower_ascii(text)):
        at = last - size + 1
        if kind == "digit":
            first_of_run, run = at != run + 1, at
            if at >= taken["card"]:
                if m := CARD.match(text, at):
                    taken["card"] = m.end()
                    number = _digits(m[0])
                    if 12 <= len(number) <= 19 and luhn(number):
                        found.append((at, m.end(), "card"))
            if first_of_run and at >= taken["ip"] and (m := IP.match(text, at)):
                taken["ip"] = m.end()
                if all(len(p) <= 3 and int(p or "0") <= 255 for p in (p.lstrip("0") for p in m[0].split("."))):
                    found.append((at, m.end(), "ip"))
        elif kind == "email":
            start = at
            while start > taken["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                taken["email"] = m.end()
                found.append((start, m.end(), "email"))
        elif kind == "phone":
            if at >= taken["phone"] and (m := PHONE.match(text, at)):
                taken["phone"] = m.end()
                if 9 <= len(_digits(m[0])) <= 15:
                    found.append((at, m.end(), "phone"))
        elif kind == "url":
            if at >= taken["url"] and (m := URL.match(text, last + 1)):
                end = m.start() + len(m[0].rstrip(".,;:!?)]}"))
                if end > m.start():
                    taken["url"] = end
                    found.append((at, end, "url"))
        elif at >= taken["account"] and not text[max(0, at - 1) : at].isalnum() and not text[last + 1 : last + 2].isalpha():
            if (m := ACCOUNT.match(text, last + 1)) and (m[1][0].isdigit() or iban(m[1])):
                taken["account"] = m.end(1)
                found.append((m.start(1), m.end(1), "account"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def listed(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def find(documents: DataFrame) -> DataFrame:
    """doc_id, the number of base spans of each kind, base_sha256 and all spans of every whole text.

    Null texts count as empty: no span and the digest of the empty text. Each row gives one row;
    other columns are dropped.
    """
    small_batches(documents.sparkSession)

    counts = ", ".join(f"n_{kind} long" for kind in BASE)

    @F.pandas_udf(f"{counts}, base_sha256 string, spans string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        anchors = automaton()
        for batch in batches:
            all_spans = [spans(text, anchors) for text in batch]
            base = [[s for s in found if s[2] in BASE] for found in all_spans]
            out = {f"n_{kind}": [sum(s[2] == kind for s in found) for found in base] for kind in BASE}
            out["base_sha256"] = [hashlib.sha256(listed(found).encode()).hexdigest() for found in base]
            out["spans"] = [listed(found) for found in all_spans]
            yield pd.DataFrame(out)

    return documents.select("doc_id", run(whole_text(F.col("text"))).alias("found")).select("doc_id", "found.*")
