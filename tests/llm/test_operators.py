"""The training-data operators against brute force on small tables."""

import base64
import hashlib
import html
import random
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from shopvitals.llm import byte_bpe, html_main, line_dedup, merkle, mixing, pii, simhash, toxicity, vector_join, warc
from shopvitals.llm.common import attach, components, forest
from shopvitals.llm.queries import RANKS, table
from tests.conftest import TESTDATA

DOCS = "doc_id bigint, text string, source string"


def collected(frame, key="doc_id"):
    return {r[key]: r for r in frame.collect()}


def classes_of(n, links):
    at = {i: i for i in range(n)}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            low = min(at[a], at[b])
            moved |= at[a] != low or at[b] != low
            at[a] = at[b] = low
    return [at[i] for i in range(n)]


# ------------------------------------------------------------------------- common


@given(st.integers(2, 30), st.lists(st.tuples(st.integers(0, 29), st.integers(0, 29)), max_size=40))
def test_forest_gives_the_least_member(n, pairs):
    pairs = [(a % n, b % n) for a, b in pairs]
    u, v = (np.array(x, dtype=int) for x in zip(*pairs)) if pairs else (np.array([], int),) * 2
    assert forest(n, u, v).tolist() == classes_of(n, pairs)


def test_components_of_a_chain_a_star_and_a_ring(spark, rows):
    links = [(i, i + 1) for i in range(1, 30)] + [(100, i) for i in range(101, 130)]
    links += [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(7, 7)]
    got = {r.node: r.component for r in components(rows(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, **{i: 100 for i in range(100, 130)}, **{i: 200 for i in range(200, 209)}}


def test_components_of_nothing(rows):
    assert components(rows([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("limit", [0, 100])
def test_attach_broadcasts_or_salts(rows, limit):
    frame = rows([(1, "a"), (2, None), (3, "c"), (4, "a")], "id bigint, k string")
    other = rows([("a", 10), (None, 20)], "k string, v bigint")
    got = attach(frame, other, ["k"], F.col("id"), 2, limit).select("id", "v").collect()
    assert sorted(map(tuple, got)) == [(1, 10), (2, 20), (3, None), (4, 10)] or {tuple(r) for r in got} == {
        (1, 10), (2, 20), (3, None), (4, 10)
    }


# ------------------------------------------------------------------------- merkle


def tree(text):
    """root, section, paragraph and leaf hashes, written without Spark."""
    h = lambda x: hashlib.sha256(x.encode()).hexdigest()
    space = " \t\r\n"
    leaves = []
    for line in text.split("\n"):
        own, at = [], 0
        while at < len(line):
            m = re.compile(f"[{space}]*(?:[^{space}]{{0,199}}[^{space}.!?][{space}]+){{0,2}}[^{space}]{{1,200}}[{space}]*|[{space}]+").match(line, at)
            own.append(m[0])
            at = m.end()
        assert "".join(own) == line
        leaves.append([h(x) for x in own])
    paragraphs = ["#" if not x else h("".join(x)) for x in leaves]
    sections = [h(x) for x in re.findall("[^#]+#*|#+", "".join(paragraphs))]
    return h("".join(sections)), sections, paragraphs, leaves


TEXTS = ["", "one", "One two three four. Five six!\nseven\n\n\nnext section\n", " lead  and\ttrail ", "x" * 450, "ä ö ü 語 𝒳 a.b.c d", "\n\n", "a\r\nb c"]


def test_merkle_trees_match_plain_hashing(rows):
    frame = rows(list(enumerate(TEXTS)), "doc_id bigint, text string")
    for r in merkle.with_fingerprint(frame, "text", "fp").collect():
        root, sections, paragraphs, leaves = tree(r.text)
        assert r.fp == ";".join([
            root, ",".join(x[:16] for x in sections), ",".join("-" if x == "#" else x[:16] for x in paragraphs),
            ",".join(" ".join(y[:8] for y in x) for x in leaves),
        ])


def test_equal_roots_mean_equal_texts(rows):
    texts = sorted({"".join(p) for p in __import__("itertools").product(["a", " ", "\n", "."], repeat=4)})
    frame = rows(list(enumerate(texts)), "doc_id bigint, text string")
    assert merkle.with_fingerprint(frame, "text", "fp").select("fp").distinct().count() == len(texts)


def test_next_document_wraps_and_skips_rows_without_id(rows):
    frame = rows([(5, "e"), (1, "aaaa"), (None, "nnnn"), (3, "cccc"), (3, "cccb")], "doc_id bigint, text string")
    got = {(r.doc_id, r.text): r.next_text for r in merkle.with_next(frame, "doc_id", ["text"], ["text"]).collect()}
    assert got == {(1, "aaaa"): "cccb", (3, "cccb"): "cccc", (3, "cccc"): "e", (5, "e"): "aaaa", (None, "nnnn"): None}


def test_next_document_across_many_ranges(spark):
    frame = spark.range(0, 3000, 3).select((F.col("id") * F.col("id")).alias("doc_id"), F.col("id").cast("string").alias("text"))
    got = {int(r.text): int(r.next_text) for r in merkle.with_next(frame, "doc_id", ["text"], ["text"]).collect()}
    assert got == {i: (i + 3) % 3000 for i in range(0, 3000, 3)}


def test_edits_are_located(rows):
    text = "\n".join(f"paragraph {i} has some words of its own" for i in range(8))
    frame = rows([(1, text, text.replace("paragraph 6", "something 6"))], "doc_id bigint, a string, b string")
    frame = merkle.with_fingerprint(merkle.with_fingerprint(frame, "a", "x"), "b", "y")
    assert frame.select(merkle.edited_paragraphs(F.col("x"), F.col("y")).alias("at")).first().at == [7]


# --------------------------------------------------------------------------- html


def article(page):
    inner = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*$", "", inner))
    lines = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def test_articles_of_all_pages(spark):
    pages = table(spark, TESTDATA, "pages")
    wanted = {r.page_id: article(r.html) for r in pages.collect()}
    got = collected(html_main.extract(pages), "page_id")
    assert {i: r.text for i, r in got.items()} == wanted
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_unseen_layouts_are_scored_by_their_names():
    page = """<html><head><title>T</title></head><body><header><h1>Site</h1></header>
      <div class="menu"><a href="/">Home</a> <a href="/x">Other things here</a></div>
      <div id="cookie-notice">We use cookies to make this site work better for you all</div>
      <div class="content"><h2>Title of it</h2><p>First &amp; long   paragraph of the text with several words.</p>
      <script>var x = "<p>no</p>";</script><!-- <p>no</p> --><p>Second one, with <b>bold</b><i>face</i> words and more.</p></div>
      <div class="comments"><p>First!!! I like this very much and say so</p></div>
      <form><p>Name please</p></form><aside><p>Related text</p></aside><footer>The end</footer></body></html>"""
    assert html_main.main_text(page, {}) == (
        "Title of it\nFirst & long paragraph of the text with several words.\nSecond one, with boldface words and more."
    )


@pytest.mark.parametrize("page", [None, "", "<", "<p", "&am", "<article", "</p></div>", "<p>" * 2000, '<a href="x'])
def test_broken_pages_do_not_fail(page):
    assert isinstance(html_main.main_text(page, {}), str)


# ----------------------------------------------------------------------- toxicity


def test_toxicity_ranks_held_out_documents(spark):
    sf = TESTDATA.replace("0.001", "0.1")
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    scored = toxicity.score(documents, toxicity.learn(documents, labels)).join(labels, "doc_id")
    held = scored.where(toxicity.held_out(F.col("doc_id"))).select("score", "predicted", "toxic").collect()
    good = [r.score for r in held if r.toxic == 1]
    bad = [r.score for r in held if r.toxic == 0]
    assert sum(g > b for g in good for b in bad) / (len(good) * len(bad)) > 0.95
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.95


def test_the_offending_sentence_is_located():
    random.seed(1)
    plain = "the cat sat on a mat and saw many other things there today".split()
    def doc(bad):
        lines = [" ".join(random.sample(plain, 6)) for _ in range(5)]
        if bad:
            lines[random.randrange(5)] += " you grotten fool"
        return ". ".join(lines) + "."
    texts, labels = zip(*[(doc(i % 3 == 0), int(i % 3 == 0)) for i in range(300)])
    model = toxicity.fit(list(texts), list(labels))
    text = "The cat sat on a mat. It saw you grotten fool there. Many other things."
    score, worst, start, end = model.score(text, {})
    assert score > 0.5 and "grotten" in text[start:end] and "sat" not in text[start:end]
    assert model.score("The cat sat on a mat.", {})[0] < 0.5


def test_a_model_of_one_class_or_none():
    assert toxicity.fit([], []).score("some words", {})[0] < 0.5
    assert toxicity.fit(["a b"] * 9, [0] * 9).score("a b", {})[0] < 0.5
    assert toxicity.fit(["a b"] * 9, [1] * 9).score("a b", {})[0] > 0.5


# --------------------------------------------------------------------- line dedup


@pytest.mark.parametrize("limit", [0, 1000])
def test_lines_above_the_ratio_go_on_their_host_only(rows, limit):
    docs = [(i, f"own {i}\nMENU\nMENU\n\nown {i}", "a") for i in range(10)] + [(20, "MENU\nrare", "b"), (21, "x", "b")]
    docs += [(30, "MENU", None), (31, None, None), (32, "MENU", None), (33, "MENU\n", None)]
    got = collected(line_dedup.without_boilerplate(rows(docs, DOCS), "source", 0.3, 3, limit))
    assert got[3].text == "own 3\n\nown 3" and (got[3].n_lines, got[3].n_dropped) == (5, 2)
    assert got[20].text == "MENU\nrare" and got[20].n_dropped == 0
    assert got[30].text == "" and got[31].text is None and got[33].text == ""
    assert len(got) == len(docs)


def test_the_pipeline_drops_a_line_on_every_source_alike(spark, rows):
    docs = []
    for source, carriers in (("a", 6), ("b", 10), ("c", 12)):  # 6, 10 and 12 of 100 pages
        for i in range(100):
            lines = [f"own {source} {i}"] + ["MENU"] * (i < carriers) + ["chance"] * (i >= 96)
            docs.append((len(docs), "\n".join(lines), "en", source, 1))
    frame = rows(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.drop_boilerplate(spark, frame, "").collect()
    assert not any("MENU" in r.text for r in kept)
    assert sum("chance" in r.text for r in kept) == 12


# ---------------------------------------------------------------------------- pii


def base_spans(text):
    digits = lambda x: re.sub("[^0-9]", "", x)
    luhn = lambda n: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(n[::-1])) % 10 == 0
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda x: 12 <= len(digits(x)) <= 19 and luhn(digits(x))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 9 <= len(digits(x)) <= 15),
    ]
    found = [(m.start(), m.end(), kind) for kind, rule, ok in rules for m in re.finditer(rule, text) if ok(m[0])]
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="0123456789ab.@+- ()Aä\n%", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert [s for s in pii.spans(text) if s[2] in pii.BASE] == base_spans(text)


@pytest.mark.parametrize(
    "text",
    ["a@b.c@d.e a@b@c.d +1 (555) 123-4567 +123 4111 1111 1111 1111 1.2.3.4.5.6.7.8 999.1.1.1",
     "4111111111111111 " * 500, "1.1.1.1" * 300, "9" * 30_000, "+" * 500 + "1" * 12, "x@" * 400 + "y.z", "0001.0255.3.4"],
)
def test_base_spans_of_dense_texts(text):
    assert [s for s in pii.spans(text) if s[2] in pii.BASE] == base_spans(text)


def test_cues_and_schemes_add_spans():
    text = "IBAN: DE89 3704 0044 0532 0130 00, account no. 12345678; see https://example.org/a?b=1. IBAN DE00 3704 0044 0532 0130 00"
    found = [(text[a:b], kind) for a, b, kind in pii.spans(text) if kind not in pii.BASE]
    assert found == [("DE89 3704 0044 0532 0130 00", "account"), ("12345678", "account"), ("https://example.org/a?b=1", "url")]


# ------------------------------------------------------------------------ simhash


def plain_simhash(text, n=3):
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", text.encode().lower()) if w]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + n]), 42) for i in range(max(1, len(words) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_bit_by_bit(rows):
    texts = [None, "", " \t\n", "Ab c", "ab C", "a b c d e f g h", "ÄB äb ab\x0bc\x0cd", "x " * 300, "word\xa0same y z"]
    got = collected(simhash.classes(rows([(i, t, "s") for i, t in enumerate(texts)], DOCS)))
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{plain_simhash(t or ''):016x}" for i, t in enumerate(texts)}
    assert [got[i].component_id for i in range(5)] == [0, 0, 0, 3, 3]


def fingerprints(seed, n_random=150, n_near=150, spread=4):
    draw = random.Random(seed)
    centre = draw.getrandbits(64)
    near = {centre ^ sum({1 << draw.randrange(64) for _ in range(draw.randrange(spread + 1))}) for _ in range(n_near)}
    return sorted(near | {draw.getrandbits(64) for _ in range(n_random)})


@pytest.mark.parametrize("seed,max_bits,cell", [(1, 2, 4096), (2, 2, 8), (3, 0, 4096), (4, 5, 4096), (5, 5, 16), (6, 3, 16)])
def test_links_lose_no_pair(spark, rows, seed, max_bits, cell):
    fps = fingerprints(seed)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = rows([(f, f) for f in signed], "node bigint, fp bigint")
    got = [(r.a, r.b) for r in simhash.links(frame, max_bits, cell=cell, sample=64).collect()]
    at = {f: i for i, f in enumerate(signed)}
    every = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= max_bits]
    assert classes_of(len(fps), [(at[a], at[b]) for a, b in got]) == classes_of(len(fps), every)


@pytest.mark.parametrize("max_bits,n", [(2, 1000), (2, 10**10), (10, 10**5)])
def test_thresholds_satisfy_the_pigeonhole(max_bits, n):
    sample = np.array(fingerprints(9), dtype=np.uint64)
    blocks = simhash.plan(sample, n, max_bits)
    assert sum(b.radius + 1 for b in blocks) == max_bits + 1
    bits = [x for b in blocks for x in b.bits]
    assert len(bits) == len(set(bits))


# ------------------------------------------------------------------------- mixing


def test_targets_are_reshared_until_none_is_above(rows):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 2000, None: 50}
    frame = rows([(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())], DOCS)
    got = {r.source: r.target for r in mixing.targets(mixing.sizes(frame)).collect()}
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(["a", "b", "c", "d", None])}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = [s for s in sizes if s not in capped]
        want = {s: 3 * sizes[s] if s in capped else rest * weight[s] / sum(weight[f] for f in free) for s in sizes}
        above = {s for s in free if want[s] > 3 * sizes[s]}
        if not above:
            break
        capped |= above
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(total)


@pytest.mark.parametrize("block", [4096, 7])
def test_mixes_meet_their_targets_and_agree(spark, block):
    documents = table(spark, TESTDATA.replace("0.001", "0.01"), "documents")
    one = mixing.copies(documents, block=block).collect()
    other = mixing.copies(documents.repartition(5), block=block).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, other))
    assert len(one) == documents.count()
    taken, target, largest = {}, {}, {}
    for r in one:
        assert 0 <= r.copies <= 3
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        target[r.source], largest[r.source] = r.target, max(r.size, largest.get(r.source, 0))
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1e-6 for s in taken)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 50), st.floats(0, 1)), max_size=30), st.integers(0, 10**6))
def test_pivoting_keeps_words_and_leaves_one_open(items, seed):
    size = np.array([s for s, _ in items], dtype=float)
    part = np.array([p for _, p in items], dtype=float)
    out = mixing.pivot(size, part, np.random.default_rng(seed))
    assert ((out >= 0) & (out <= 1)).all() and ((out > 0) & (out < 1)).sum() <= 1
    assert (size * out).sum() == pytest.approx((size * part).sum(), abs=1e-5)


def test_pivoting_keeps_expectations():
    size, part = np.array([3.0, 8, 5, 20, 1]), np.array([0.2, 0.5, 0.7, 0.4, 0.9])
    mean = np.mean([mixing.pivot(size, part, np.random.default_rng(i)) for i in range(20_000)], axis=0)
    assert mean == pytest.approx(part, abs=0.02)


# --------------------------------------------------------------------------- warc

PAGES = [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, None, None), (4, "http://c/", ""), (5, "u", "ünï"), (None, "n", "<p>x</p>")]


def test_archives_give_back_pages_and_records(spark, rows, tmp_path):
    warc.write(rows(PAGES, "page_id bigint, url string, html string"), str(tmp_path / "one"))
    root = str(tmp_path / "one")
    back = {r.page_id: (r.url, r.html) for r in warc.pages(spark, root).collect()}
    assert back == {i: (u or "", h or "") for i, u, h in PAGES}
    assert spark.read.parquet(f"{root}/payloads").count() == 3
    for r in warc.records(spark, root).collect():
        head, _, block = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and len(block) - 4 == int(fields["Content-Length"])
        payload = block[:-4].partition(b"\r\n\r\n")[2]
        full = (dict((i, h) for i, _, h in PAGES)[r.page_id] or "").encode()
        assert payload == (b"" if fields["WARC-Type"] == "revisit" else full)
        assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(full).digest()).decode()


@pytest.mark.parametrize("least", [0, 5])
def test_the_largest_page_is_the_response(rows, least):
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.archive_and_read(rows(PAGES, "page_id bigint, url string, html string"), least).collect()}
    empty = {3: ("revisit", 4), 4: ("response", None)} if not least else {3: ("response", None), 4: ("response", None)}
    assert got == {1: ("revisit", 2), 2: ("response", None), **empty, 5: ("response", None), None: ("revisit", 2)}


def test_a_damaged_payload_is_an_error(spark, rows, tmp_path):
    warc.write(rows(PAGES, "page_id bigint, url string, html string"), str(tmp_path / "a"))
    stored = spark.read.parquet(str(tmp_path / "a/payloads")).withColumn("payload", F.lit(b"other")).collect()
    spark.createDataFrame(stored, "digest binary, payload binary").write.mode("overwrite").parquet(str(tmp_path / "a/payloads"))
    with pytest.raises(Exception, match="payload damaged"):
        warc.index(spark, str(tmp_path / "a")).collect()


# ------------------------------------------------------------------------ vectors


@pytest.mark.parametrize("cell,n_near", [(4096, 40), (16, 40), (8, 60)])
def test_vector_links_are_those_of_all_pairs(spark, cell, n_near):
    draw = np.random.default_rng(cell)
    centre = draw.normal(size=12)
    points = np.vstack([draw.normal(size=(120, 12)), centre + 0.12 * draw.normal(size=(n_near, 12)), draw.normal(size=(60, 3)) @ draw.normal(size=(3, 12))])
    frame = spark.createDataFrame([(i, [float(np.float32(x)) for x in p]) for i, p in enumerate(points)], "vec_id long, embedding array<float>")
    points = np.float32(points).astype(float)
    norm = np.sqrt((points**2).sum(axis=1))
    close = points @ points.T / np.outer(norm, norm) >= 0.9
    np.fill_diagonal(close, False)
    got = collected(vector_join.classes(frame, cell=cell), "vec_id")
    assert [got[i].n_links for i in range(len(points))] == close.sum(axis=1).tolist()
    assert [got[i].component_id for i in range(len(points))] == classes_of(len(points), list(zip(*np.nonzero(close))))


def test_unusable_vectors_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    data = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 0), (4, [0.0, 0.0], 0), (5, [1.0, None], 0), (6, [nan, 1.0], 0),
            (7, [inf, 1.0], 0), (8, [], 0), (9, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (10, [1e-30, 0.0], 0)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, n_links int")
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id, r.kept) for r in vector_join.classes(frame).collect())
    assert got == [(0, 0, None, False), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False)] + [
        (i, 0, i, True) for i in range(3, 10)
    ] + [(10, 2, 1, False)]


# ---------------------------------------------------------------------------- bpe


@pytest.fixture(scope="module")
def own():
    return byte_bpe.encoding(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab1 '.sé\n\t\xa0 語!"), max_size=200), st.integers(1, 20))
def test_pieces_encode_as_the_whole(own, text, size):
    assert "".join(byte_bpe.pieces(text, size)) == text
    assert byte_bpe.encode(text, own, size) == own.encode_ordinary(text)


@pytest.mark.parametrize("text", ["word " * 30_000, "x" * 3000, " " * 5000 + "a", "<|endoftext|>", "a'll 12's  \n b"])
def test_long_texts_round_trip(own, text):
    ids = byte_bpe.encode(text, own)
    assert ids == own.encode_ordinary(text) and own.decode_bytes(ids) == text.encode()


def test_ids_and_bytes_of_a_table(rows, own):
    frame = rows([(1, "Hello wörld", "s"), (2, None, "s"), (3, "", "s")], DOCS)
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    back = collected(byte_bpe.decoded(byte_bpe.encoded(frame, path, pattern), path, pattern))
    assert bytes(back[1].bytes).decode() == "Hello wörld" and list(back[2].ids) == [] and bytes(back[3].bytes) == b""
    assert list(back[1].ids) == own.encode_ordinary("Hello wörld")
