"""Texts and values at the edge of what operators take, and plain recomputations of learned parts."""

import base64
import hashlib
import math
import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st

from shopvitals.llm import byte_bpe, html_main, line_dedup, pii, toxicity, vector_join, warc
from shopvitals.llm.common import small_batches
from shopvitals.llm.queries import RANKS
from tests.llm.test_operators import DOCS, collected

# ------------------------------------------------------------------------------ bpe


@pytest.fixture(scope="module")
def own():
    return byte_bpe.encoding(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


runs = st.lists(
    st.tuples(st.sampled_from([" ", "\t", "\n", "\x85", "　", "\xa0", "\x1c", "a", "1", "'", "."]), st.integers(1, 8)), max_size=20
).map(lambda parts: "".join(x * n for x, n in parts))


@settings(max_examples=500, deadline=None)
@given(runs, st.integers(1, 10), st.integers(2, 6))
def test_runs_of_white_space_encode_as_the_library_does(own, text, size, run):
    assert byte_bpe.encode(text, own, size, run) == own.encode_ordinary(text)


@pytest.mark.parametrize("space", [" ", "\n", "\t \r\n"])
@pytest.mark.parametrize("end", ["", "x", "\né"])
def test_very_long_runs_of_white_space(own, space, end):
    below = "a" + space * (300_000 // len(space)) + end
    assert byte_bpe.encode(below, own) == own.encode_ordinary(below)
    above = "a" + space * (5_000_000 // len(space)) + end
    assert own.decode_bytes(byte_bpe.encode(above, own)) == above.encode()


# ------------------------------------------------------------------------------ pii


@pytest.mark.parametrize("text, want", [
    ("0" * 5000 + ".1.1.1", [(0, 5006, "ip")]), ("9" * 5000 + ".1.1.1", []), ("1.1.1." + "0" * 9000 + "255", [(0, 9009, "ip")]),
    ("0.0.0." + "0" * 6000, [(0, 6006, "ip")]), ("1.2.3.256", []), ("+" + "1" * 9000, []),
])
def test_numbers_of_any_length_are_validated(text, want):
    assert [s for s in pii.spans(text) if s[2] == "ip"] == want


# ----------------------------------------------------------------------------- html


@pytest.mark.parametrize("page, want", [
    ("<article><p>x<br>y</p></article>", "x y"), ("<p>one<br/>two <b>thr</b>ee</p>", "one two three"),
    ("<article><p>Some words stand here</p><textarea>type here</textarea><p>and more of them</p></article>",
     "Some words stand here\nand more of them"),
    ("<article><p>Some words stand here</p><form><div><p>your name and mail please</p></div></form><p>and more of them</p></article>",
     "Some words stand here\nand more of them"),
    ("<html><head><title>T</title><meta charset=x><body><p>A body without the end of a head</p>", "A body without the end of a head"),
    ("<html><head><title>T</title><p>A body of its own accord</p>", "A body of its own accord"),
    ("<form id=page><article><p>An article in a form that wraps the page</p></article></form>", "An article in a form that wraps the page"),
    ("<head><script>var a = '<p>no</p>'</script></head><p>After the head</p>", "After the head"),
    ("<p>before words</p><script>never closed <p>no</p>", "before words"), ("<svg><p>An open drawing with words</p>", "An open drawing with words"),
])
def test_breaks_forms_and_heads(page, want):
    assert html_main.main_text(page, {}) == want


@given(st.lists(st.integers(-4, 4), max_size=30))
def test_the_best_run_is_the_best_of_all_intervals(scores):
    every = [(-sum(scores[i:j]), j - i, i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)]
    least = min(every, default=(0, 0, 0))
    start, end = html_main.best_run([float(s) for s in scores])
    assert sum(scores[start:end]) == max(0, -least[0])
    if least[0] < 0:
        assert end - start == min(n for s, n, _ in every if s == least[0])


MADE = [
    lambda n: "<div>" * n + "</p>" * n, lambda n: "<script " * n, lambda n: "<svg>" * n, lambda n: "<p><b>" * n, lambda n: "<li>" * n + "</ul>" * n,
    lambda n: "<a '" * n, lambda n: '<a "' * n, lambda n: "<form><p>a" * n, lambda n: "<noscript>x" * n, lambda n: "<head><meta>" * n,
]


@pytest.mark.parametrize("made", MADE)
def test_time_follows_the_length_of_a_page(made):
    def seconds(n):
        page, start = made(n), time.process_time()
        html_main.main_text(page, {})
        return time.process_time() - start

    seconds(1000)
    short, long = min(seconds(10_000) for _ in range(3)), min(seconds(40_000) for _ in range(2))
    assert long < 9 * short + 0.05  # a square would be 16 times


# ----------------------------------------------------------------------------- warc


def test_urls_stay_within_their_header(spark, rows, tmp_path):
    bad = ["a\r\nContent-Length: 5\r\nx", "b\r\nRefers-To-Page: 77\r\n", "tab\there", "", None, "ünï/€", "%0D%0A"]
    pages = [(i, u, "<p>same</p>") for i, u in enumerate(bad)] + [(50, "z", "<p>same</p>")]
    frame = rows(pages, "page_id bigint, url string, html string")
    got = collected(warc.archive_and_read(frame), "page_id")
    digest = base64.b32encode(hashlib.sha1(b"<p>same</p>").digest()).decode()
    assert {i: tuple(r) for i, r in got.items()} == {
        **{i: (i, 11, digest, "revisit", 50) for i in range(len(bad))}, 50: (50, 11, digest, "response", None)}
    root = str(tmp_path / "w")
    warc.write(frame, root)
    assert {r.page_id: r.url for r in warc.pages(spark, root).collect()} == {i: u or "" for i, u, _ in pages}
    common = ["WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "WARC-Payload-Digest"]
    revisit = ["WARC-Profile", "WARC-Refers-To", "Refers-To-Page"]
    for r in warc.records(spark, root).collect():
        lines = bytes(r.record).partition(b"\r\n\r\n")[0].decode().split("\r\n")[1:]
        assert [x.split(": ")[0] for x in lines] == common + (revisit if r.page_id != 50 else []) + ["Content-Type", "Content-Length"]


def test_a_record_of_another_length_is_an_error(spark, rows, tmp_path):
    warc.write(rows([(1, "u", "some text")], "page_id bigint, url string, html string"), str(tmp_path / "a"))
    found = warc.records(spark, str(tmp_path / "a")).selectExpr("page_id", "substring(record, 1, octet_length(record) - 5) AS record")
    with pytest.raises(Exception, match="header and payload differ"):
        warc.parsed(found).collect()


# -------------------------------------------------------------------------- vectors


def test_tiny_and_huge_vectors_link_by_their_direction(spark):
    data = [(1, [1e-200, 0.0]), (2, [0.0, 1e-200]), (3, [1e200, 0.0]), (4, [1e200, 1e200]), (5, [1.0, 1.0]), (6, [5e-324, 0.0]), (7, [1e308, 1e-308])]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vector_join.classes(frame).collect()}
    assert got == {1: (3, 1), 2: (0, 2), 3: (3, 1), 4: (1, 4), 5: (1, 4), 6: (3, 1), 7: (3, 1)}


@given(st.lists(st.lists(st.floats(-1e3, 1e3, width=32), min_size=3, max_size=3).filter(lambda v: any(abs(x) > 1e-3 for x in v)), min_size=2, max_size=9))
def test_scaling_keeps_the_bits_of_ordinary_vectors(vectors):
    plain = np.array(vectors, float)
    norm = np.sqrt((plain * plain).sum(axis=1))
    close = plain @ plain.T >= 0.9 * (norm[:, None] * norm[None])
    u, v = vector_join.compare(vector_join.scaled(plain), vector_join.scaled(plain), 0.9, True)
    assert set(zip(u.tolist(), v.tolist())) == {(i, j) for i in range(len(plain)) for j in range(i + 1, len(plain)) if close[i, j]}


# ------------------------------------------------------------------------ line dedup


def test_white_lines_stay_and_two_pages_make_a_repeat(rows):
    docs = [(1, "same\n\t\n \nown one", "h"), (2, "same\n\t\n\x0b\nown two", "h"), (3, "alone\n\t", "single"), (4, "alone\n\t", "single2")]
    got = collected(line_dedup.without_boilerplate(rows(docs, DOCS), "source"))
    assert {i: r.text for i, r in got.items()} == {1: "\t\n \nown one", 2: "\t\n\x0b\nown two", 3: "alone\n\t", 4: "alone\n\t"}
    assert got[1].n_lines == 4 and got[1].n_dropped == 1


# -------------------------------------------------------------------------- toxicity


def made_documents(n, seed):
    draw = random.Random(seed)
    words = ["alpha", "beta", "gamma", "delta", "kind", "words", "vile", "viles", "idiot"]
    texts, labels = [], []
    for _ in range(n):
        found = [" ".join(draw.choices(words[:6], k=draw.randrange(2, 9))) for _ in range(draw.randrange(1, 5))]
        label = int(draw.random() < 0.3)
        if label and draw.random() < 0.95:
            found[draw.randrange(len(found))] += " " + draw.choice(words[6:])
        texts.append(". ".join(found))
        labels.append(label)
    return texts, labels


def plain_probability(text, weights, bias, leak):
    """Noisy-or, written out: what is left clean by the leak and by every sentence."""
    clean = 1 - 1 / (1 + math.exp(-leak))
    for _, _, words in toxicity.sentences(text):
        z = bias + sum(weights.get(f, 0.0) for w in set(words) for f in toxicity.features(w))
        clean *= 1 - 1 / (1 + math.exp(-z))
    return 1 - clean


def test_documents_are_the_noisy_or_of_their_sentences():
    texts, labels = made_documents(120, 1)
    model = toxicity.fit(texts, labels)
    for text in texts:
        score, worst, start, end = model.score(text, {})
        assert score == pytest.approx(plain_probability(text, model.weights, model.bias, model.leak), abs=1e-9)
        each = [plain_probability(text[a:b], model.weights, model.bias, -700.0) for a, b, _ in toxicity.sentences(text)]
        assert worst == pytest.approx(max(each), abs=1e-9) and plain_probability(text[start:end], model.weights, model.bias, -700.0) == pytest.approx(worst)


def test_kept_features_are_those_tied_to_toxic_labels():
    texts, labels = made_documents(200, 2)
    model = toxicity.fit(texts, labels)
    rate, kept = sum(labels) / len(labels), set()
    seen = [{f for _, _, words in toxicity.sentences(t) for w in words for f in toxicity.features(w)} for t in texts]
    for f in set().union(*seen):
        n, toxic = sum(f in s for s in seen), sum(f in s and y for s, y in zip(seen, labels))
        expected = rate * n
        if n >= toxicity.MIN_DOCS and toxic > expected:
            if (toxic - expected) ** 2 / (rate * (1 - rate) * n * (1 - n / (len(texts) + 1))) >= toxicity.MIN_TIE:
                kept.add(f)
    assert kept and set(model.weights) == kept


def test_the_fit_is_a_maximum_of_the_plain_likelihood():
    texts, labels = made_documents(150, 3)
    model = toxicity.fit(texts, labels, rounds=4000, penalty=1e-2)
    names = sorted(model.weights)

    # features of one word that always come together have a shared slope; known ones are summed as in a sentence's set
    def likelihood(theta):
        weights, total = dict(zip(names, theta)), 0.0
        for text, y in zip(texts, labels):
            clean = -math.log1p(math.exp(theta[-1]))
            for _, _, words in toxicity.sentences(text):
                known = {f for w in set(words) for f in toxicity.features(w)}
                clean -= math.log1p(math.exp(theta[-2] + sum(weights.get(f, 0.0) for f in known)))
            total += math.log(max(1e-12, -math.expm1(clean))) if y else clean
        return total - 1e-2 * len(texts) / 2 * sum(w * w for w in theta[:-2])

    best = [model.weights[f] for f in names] + [model.bias, model.leak]
    at = likelihood(best)
    start = likelihood([1.0] * len(names) + [-8.0, -4.0])
    assert at > start
    for i in range(len(best)):
        up, down = (likelihood([x + d * (i == j) for j, x in enumerate(best)]) for d in (1e-3, -1e-3))
        assert abs(up - down) / 2e-3 < 0.15, names[i] if i < len(names) else i


# --------------------------------------------------------------------------- batches


def test_batches_are_bound_by_rows_and_bytes(spark):
    rows, size = ("spark.sql.execution.arrow." + x for x in ("maxRecordsPerBatch", "maxBytesPerBatch"))
    before = spark.conf.get(rows), spark.conf.get(size)
    try:
        spark.conf.set(rows, "10000")
        spark.conf.set(size, str(64 << 20))
        small_batches(spark)
        assert spark.conf.get(rows) == "512" and spark.conf.get(size).removesuffix("b") == str(32 << 20)
        spark.conf.set(rows, "100")
        small_batches(spark)
        assert spark.conf.get(rows) == "100"  # a smaller one that a user chose
    finally:
        spark.conf.set(rows, before[0])
        spark.conf.set(size, before[1].removesuffix("b"))


def test_counts_of_a_plain_word_list():
    assert Counter(len(toxicity.features(w)) for w in ("ab", "abcd", "abcdefgh")) == {1: 1, 2: 1, 5: 1}
