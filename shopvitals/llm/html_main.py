"""Main text of web pages: the maximum-scoring run of words and tags.

A page becomes a sequence of tags and words. Words score by where they stand (the nearest
container and block), tags by name and container; tags never score above zero. The weights are
log-odds counted on labelled pages: those that mark up their article themselves. One linear scan
finds the contiguous run with the largest sum; inside it, words of places that score below zero
(scripts, adverts, forms, comments) are left out.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from shopvitals.llm.common import small_batches, whole_text

#: Labelled pages that the weights are counted on, those with the least hashed ids.
SAMPLE_PAGES = 512

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/)?(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^<>\"']+|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[/!?a-zA-Z][^<>]*(?:>|\Z|(?=<))"
    r"|(?P<text>[^<]+|<)",
    re.S,
)
#: HTML's own names: fixed values. What stands in the first is never text of the page, without its end tag up
#: to the end of the page; what stands in the second goes if it has an end tag.
UNREAD = frozenset("script style title textarea iframe".split())
FOREIGN = frozenset("template noscript svg math".split())
END = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in UNREAD | FOREIGN}
IN_HEAD = frozenset("head base link meta script style title template noscript".split())
FORM = frozenset("form select button".split())
CLASS = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
DIGITS, WORDS = re.compile(r"\d+"), re.compile(r"[a-z]+")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINER = frozenset("body nav header footer aside form article main section div dialog menu table figure select button".split())
BLOCK = frozenset(
    "p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre address figcaption caption tr td th tbody thead hr".split()
) | CONTAINER
CLOSED_BY_BLOCK = frozenset("p h1 h2 h3 h4 h5 h6".split())
#: Names of containers and classes that tell against a place no labelled page knows.
AGAINST = frozenset(
    "nav header footer aside form menu dialog select button ad ads advert advertisement promo sponsor sponsored banner "
    "sidebar comment comments reply replies cookie cookies consent notice alert popup modal share social related "
    "recommended breadcrumb breadcrumbs newsletter subscribe signup login search pagination toolbar widget copyright".split()
)
NAMED_ARTICLE = frozenset(("article", "main", "articlebody"))


def named(attrs: str) -> str:
    """The classes, id and role of a tag, digits made equal, as part of a place's name."""
    if "=" not in attrs:
        return ""
    names = " ".join(a or b or c for a, b, c in CLASS.findall(attrs)).lower()
    return "".join(f".{n}" for n in sorted(set(DIGITS.sub("0", names).split())))


def tokens(page: str) -> Iterator[tuple[str, str, str | None, int, bool]]:
    """(kind "tag" or "text", place, text, block, whether inside a marked article) in page order.

    A place is the innermost container, with its names, and the innermost block inside it. A form is
    left out, unless an article stands in it: then it wraps the page. The head ends with its end tag, or with the first tag or
    text that it can't hold. One pass: the places of open tags are kept by name, and an end tag that
    was looked for in vain is not looked for again.
    """
    stack = [("", "body", "body>", False)]  # tag, container, place, marked
    open_at: dict[str, list[int]] = {}  # where in the stack each tag, and each container, is open
    containers: list[int] = [0]
    form = 0  # depth from which on the stack is inside a form
    block, in_head, at, never = 0, False, 0, set()

    def leave(depth: int) -> None:
        nonlocal form
        while len(stack) > depth:
            open_at[stack.pop()[0]].pop()
            if containers[-1] == len(stack):
                containers.pop()
        form = 0 if form >= depth else form

    while m := TOKEN.match(page, at):
        at = m.end()
        last = m.lastgroup
        if last == "text":
            _, _, place, marked = stack[-1]
            in_head = in_head and not m["text"].strip()
            if not form:
                yield "text", place, m["text"], block, marked
            continue
        if last != "attrs":
            continue
        tag = m["tag"].lower()
        if not m["close"] and tag in END and tag not in never:
            end = END[tag].search(page, at)
            if end:
                at = end.end()
                continue
            if tag in UNREAD:
                return
            never.add(tag)
        if tag == "head":
            in_head = not m["close"]
            continue
        in_head = in_head and tag in IN_HEAD
        if in_head:
            continue
        is_block = tag in BLOCK
        if is_block:
            block += 1
        if m["close"]:
            if not form:
                yield "tag", "/" + tag, None, block, stack[-1][3]
            if is_block and (found := open_at.get(tag)) and (tag in CONTAINER or found[-1] > containers[-1]):
                leave(found[-1])
            continue
        if is_block:
            while stack[-1][0] in CLOSED_BY_BLOCK or tag == "li" == stack[-1][0]:
                leave(len(stack) - 1)
        names = named(m["attrs"])
        _, container, place, marked = stack[-1]
        article = tag in CONTAINER and not NAMED_ARTICLE.isdisjoint(WORDS.findall(tag + names))
        if article:
            form = 0
        elif tag in FORM and not form:
            form = len(stack)
        if not form:
            yield "tag", tag + names, None, block, marked
            if tag == "br":
                yield "text", place, " ", block, marked
        if is_block and tag not in VOID:
            open_at.setdefault(tag, []).append(len(stack))
            if tag in CONTAINER:
                containers.append(len(stack))
                stack.append((tag, tag + names, f"{tag}{names}>", marked or article))
            else:
                stack.append((tag, container, f"{container}>{tag}", marked))


def count_places(page: str) -> Counter:
    """(kind, place, inside) counts of a page; empty if it marks up no article."""
    found: Counter = Counter()
    for kind, place, text, _, inside in tokens(page):
        found[kind, place, inside] += len(text.split()) if kind == "text" else 1
    return found if any(k == "text" and i for k, _, i in found) else Counter()


def weights(counts: dict[tuple[str, str, bool], int]) -> dict[tuple[str, str], float]:
    """Log-odds of each place: words between -3 and 3, tags between -8 and -0.1."""
    out = {}
    for kind, place in {(k, p) for k, p, _ in counts}:
        odds = math.log((counts.get((kind, place, True), 0) + 0.5) / (counts.get((kind, place, False), 0) + 0.5))
        out[kind, place] = max(-3.0, min(3.0, odds)) if kind == "text" else max(-8.0, min(-0.1, odds))
    return out


def score(kind: str, place: str, known: dict[tuple[str, str], float]) -> float:
    """The learned weight, or for a place never seen one by its names."""
    if (kind, place) in known:
        return known[kind, place]
    against = not AGAINST.isdisjoint(WORDS.findall(place))
    if kind == "text":
        return -2.0 if against else 0.5 if place.endswith(">") else 1.0
    return -4.0 if against else -0.5


def best_run(weights: list[float]) -> tuple[int, int]:
    """(start, end) of the run with the largest sum, found in one pass: the shortest and first of equal ones."""
    best, start, end, total, since = 0.0, 0, 0, 0.0, 0
    for i, weight in enumerate(weights):
        if total <= 0:
            total, since = 0.0, i
        total += weight
        if total > best or total == best > 0 and i + 1 - since < end - start:
            best, start, end = total, since, i + 1
    return start, end


def main_text(page: str | None, known: dict[tuple[str, str], float]) -> str:
    """Text of the run with the largest sum, the shortest and first of equal ones."""
    seen: dict[tuple[str, str], float] = {}
    items = []
    for kind, place, text, block, _ in tokens(page or ""):
        if (weight := seen.get((kind, place))) is None:
            weight = seen[kind, place] = score(kind, place, known)
        items.append((block, text, weight))
    start, end = best_run([w * len(t.split()) if t is not None else w for _, t, w in items])
    blocks: dict[int, list[str]] = {}
    for block, text, weight in items[start:end]:
        if text is not None and weight > 0:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join(html.unescape("".join(parts)).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def learn(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> dict[tuple[str, str], float]:
    """Weights from at most ``sample_pages`` pages that mark up their article, counted on the executors.

    Pages without such markup give no counts; with none at all every place is scored by its names.
    """
    spark = pages.sparkSession
    small_batches(spark)
    ids = (
        pages.select("page_id").where(F.lower("html").rlike("<(article|main)[ >]")).distinct()
        .orderBy(F.xxhash64("page_id"), "page_id").limit(sample_pages)
    )
    sample = pages.join(F.broadcast(ids), "page_id", "left_semi").select("html")

    def count(batches):
        found: Counter = Counter()
        for batch in batches:
            for page in batch["html"]:
                found.update(count_places(page or ""))
        rows = [(k, p, i, n) for (k, p, i), n in found.items()]
        yield pd.DataFrame(rows, columns=["kind", "place", "inside", "n"])

    counts = sample.mapInPandas(count, "kind string, place string, inside boolean, n long")
    rows = counts.groupBy("kind", "place", "inside").agg(F.sum("n").alias("n")).collect()
    return weights({(r.kind, r.place, r.inside): r.n for r in rows})


def extract(pages: DataFrame, known: dict[tuple[str, str], float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars of every page; null html counts as empty and gives the empty text.

    Repeated rows give repeated results; other columns are dropped.
    """
    small_batches(pages.sparkSession)
    known = learn(pages) if known is None else known

    @F.pandas_udf("text string, n_chars long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [main_text(page, known) for page in batch]
            yield pd.DataFrame({"text": texts, "n_chars": [len(t) for t in texts]})

    found = pages.select("page_id", "url", run(whole_text(F.col("html"))).alias("found"))
    return found.select("page_id", "url", "found.text", "found.n_chars")
