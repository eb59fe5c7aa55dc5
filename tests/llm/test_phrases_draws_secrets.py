"""Collocations, importance resampling and secret scans against brute force on small tables."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shopvitals.llm import collocations, importance, secret_scan

DOCS = "doc_id bigint, text string, lang string"

# -------------------------------------------------------------------------- collocations

paths = st.lists(st.lists(st.sampled_from([b"a", b"b", b"ab", "ü".encode(), b"z"]), min_size=1, max_size=5), max_size=40)


def transducer(found):
    names = sorted({w for p in found for w in p})
    at = {w: i for i, w in enumerate(names, 1)}
    table = np.array([[*(at[w] for w in p), *[0] * (5 - len(p))] for p in found], np.int32).reshape(-1, 5)
    return names, *collocations.united(list(table.T), np.ones(len(found), np.int64))


def accepted(names, cols, counts):
    return {tuple(names[c[i] - 1] for c in cols if c[i]): int(n) for i, n in enumerate(counts)}


@given(paths.filter(bool))
def test_a_frozen_transducer_accepts_the_paths_it_was_built_from(found):
    whole = transducer(found)
    assert accepted(*whole) == Counter(map(tuple, found))
    assert accepted(*collocations.thaw(collocations.freeze(*whole))) == Counter(map(tuple, found))
    assert [tuple(p) for p in accepted(*whole)] == sorted(set(map(tuple, found)))


@given(st.lists(paths.filter(bool), min_size=1, max_size=4), paths.filter(bool))
def test_union_sums_and_places_cut_in_order(many, bounds):
    names, cols, counts = collocations.union([transducer(f) for f in many])
    every = Counter(tuple(p) for f in many for p in f)
    assert accepted(names, cols, counts) == every
    for bound in bounds:
        assert collocations.place(names, cols, tuple(bound)) == sum(p < tuple(bound) for p in every)
    prefixes = Counter(p[:k] for p in every.elements() for k in range(1, len(p) + 1))
    assert dict(collocations.weights_of(names, cols, counts, 1)) == {b" ".join(p): n for p, n in prefixes.items()}


@given(st.integers(1, 2**20), st.integers(1, 60))
def test_wide_vocabularies_keep_their_order(vocabulary, n):
    rng = np.random.default_rng(n)
    cols = [rng.integers(0, vocabulary + 1, n).astype(np.int32) for _ in range(5)]
    got, counts = collocations.united(cols, np.ones(n, np.int64))
    want = Counter(zip(*[c.tolist() for c in cols]))
    assert list(zip(*[c.tolist() for c in got])) == sorted(want) and counts.sum() == n


def brute_collocations(docs, least, listed):
    f, n = Counter(), Counter()
    for _, text, lang in docs:
        text = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
        for piece in re.split("[.,;:!?\x0A-\x0D]", text):
            words = [w for w in re.split("[ \t]", piece) if w]
            n[lang or "und"] += len(words)
            for k in range(1, 6):
                f.update((lang or "und", tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    rows = []
    kept = {p: a for p, a in f.items() if a >= least and len(p[1]) >= 2}
    for (lang, words), a in kept.items():
        if any(
            lang == other and len(longer) > len(words) and 100 * b >= 100 * a
            and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), b in kept.items()
        ):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        rows.append((lang, " ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], n[lang], score))
    rows.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    out, place = [], Counter()
    for r in rows:
        place[r[0]] += 1
        if place[r[0]] <= listed:
            out.append((r[0], place[r[0]], *r[1:]))
    return out


def made_texts(n, seed):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "a", "über", "x-y", "\x01odd", "time", "\U0001d4b3", "%"]
    out = []
    for i in range(n):
        text = "".join(
            rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "\r\n"]) for _ in range(rng.randrange(60))
        )
        out.append((i, text, rng.choice(["en", "en", "en", "de", None])))
    return out + [(n, "", "en"), (n + 1, None, "de"), (n + 2, "the " * 300, "en"), (n + 2, "the " * 300, "en"), (None, " .\n ", None)]


@pytest.mark.parametrize("block, gathered, range_bytes", [(1 << 20, 1 << 21, 24 << 20), (70, 100, 500)])
def test_collocations_match_brute_force(spark, rows, monkeypatch, block, gathered, range_bytes):
    monkeypatch.setattr(collocations, "BLOCK", block)
    monkeypatch.setattr(collocations, "GATHERED", gathered)
    monkeypatch.setattr(collocations, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(collocations, "PER_BOUND", 2)
    docs = made_texts(120, 5)
    got = collocations.collocations(rows(docs, DOCS), least=5, listed=40).collect()
    want = brute_collocations(docs, 5, 40)
    assert sorted(map(tuple, got)) == sorted(want) and len({w[0] for w in want}) == 3


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 7)
    text = "Ab cd, ef\tgh\n" * 50 + "x" * 100
    vocabulary = collocations.new_vocabulary()
    ids = collocations.word_ids(text.encode(), vocabulary)
    names = {i: w for w, i in vocabulary.items()}
    assert [names[i] for i in ids.tolist() if i] == [b"ab", b"cd", b"ef", b"gh"] * 50 + [b"x" * 100]


def test_scores_are_exact_beyond_64_bits():
    a, n, l, r = 10**12 + 7, 10**13 + 1, 10**12 + 9, 10**12 + 11
    assert collocations.lowest_cut(a, n, [l], [r]) == (l, r, 1000 * a * n // (l * r))
    assert collocations.lowest_cut(100, 1000, [500, 200], [200, 500]) == (500, 500, 400)  # ties: the first cut


def test_no_phrases(rows):
    assert collocations.collocations(rows([], DOCS)).count() == 0
    assert collocations.collocations(rows([(1, None, None), (2, "", "en"), (3, "a b", "en")], DOCS)).count() == 0


# -------------------------------------------------------------------------- resampling


def plain_features(text, longest):
    low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    words = [w.encode() for w in re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)]
    return len(words), [crc32(b" ".join(words[i : i + k])) % 50 for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_resampling_matches_brute_force(spark, rows, longest):
    rng = random.Random(longest)
    words = ["Alpha", "beta", "it's", "9", "été", "\n", "\n\n", "gamma", "--"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(40)))) for i in range(150)] + [(7, "beta " * 30), (150, None), (None, "gamma " * 25)]
    docs += [(200 + i, "one line\nthe same line\nend " + "w " * 20) for i in range(30)]
    target = [("beta gamma\nbeta",), (None,), ("alpha\n9",)]
    corpus, wanted = Counter(), Counter()
    for _, text in docs:
        corpus.update(plain_features(text, longest)[1])
    for text, in target:
        wanted.update(plain_features(text, longest)[1])
    s_all, t_all = sum(corpus.values()), sum(wanted.values())
    gain = {b: math.floor(1000 * math.log((wanted[b] + 1) * (s_all + 50) / ((corpus[b] + 1) * (t_all + 50)))) for b in range(50)}
    want = []
    for doc_id, text in docs:
        n_words, found = plain_features(text, longest)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        want.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    enough = sorted((r for r in want if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    place = {id(r): i for i, r in enumerate(enough[: len(enough) * 10 // 100], 1)}
    want = [(*r[:4], place.get(id(r))) for r in want]
    got = importance.resampled(rows(docs, "doc_id bigint, text string"), rows(target, "text string"), longest, 50)
    got = [tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and any(r[4] == 1 for r in got)


def test_crossing_runs_are_what_lines_do_not_have():
    lines = [b"a b".split(), [], b"c".split(), b"d e f".split()]
    inner = Counter(b for line in lines for b in importance.features(line, 3, 1000).tolist())
    every = Counter(importance.features(b"a b c d e f".split(), 3, 1000).tolist())
    assert inner + Counter(importance.crossing(lines, 3, 1000).tolist()) == every


def test_ranks_run_through_all_ranges(rows):
    values = [(i % 7, i) for i in range(500)]
    got = importance.ranked(rows(values, "a bigint, b bigint"), [F.desc("a"), F.asc("b")]).collect()
    assert {(r.a, r.b): r["rank"] for r in got} == {v: i for i, v in enumerate(sorted(values, key=lambda v: (-v[0], v[1])), 1)}


def test_long_texts_are_cut_between_words_too(monkeypatch):
    monkeypatch.setattr(importance, "CHUNK", 5)
    text = b"Abc def-gh 12 " * 20
    assert [w for part in importance.chunks(text) for w in part.split()] == importance.words_of(text)
    assert list(importance.chunks(b"")) == [b""]


def test_drawn_documents_keep_their_columns(rows):
    docs = rows([(i, "some words here " * 8, "x") for i in range(40)], "doc_id bigint, text string, rank string")
    got = importance.drawn_documents(docs, rows([("some",)], "text string"), percent=25).collect()
    assert len(got) == 10 and sorted(r["rank"] for r in got) == list(range(1, 11)) and got[0].text.startswith("some")


# ----------------------------------------------------------------------------- secrets

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def plain_base(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(ASSIGN, text, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(s, e, secret_scan.KINDS[k]) for s, k, e in sorted(found)]


secret_texts = st.lists(
    st.sampled_from(
        ["token", "Token", "PASSWORD", "passwd", "api_key", "apikey", "secret", "toKen", "ſecret", "\"", "'", " ", "  ", ":", "=",
         "AKIA", "AKIAQ7ZP2", "ABCDEFGH12345", "deadbeef", "0123456789abcdef", "f" * 24, "x.y/z+", "-", "\n", "\U0001d4b3", "Zq9Lm2Xv8Tb4Rk7Wd1Ns"]
    ), max_size=25,
).map("".join)


@settings(max_examples=300)
@given(secret_texts)
def test_base_spans_match_plain_patterns(text):
    found = secret_scan.spans(text)
    assert [s for s in found if s[2] in secret_scan.BASE] == plain_base(text)
    assert found == sorted(found, key=lambda s: (s[0], secret_scan.KINDS.index(s[2])))


@given(st.text("ab01XY", max_size=60), st.sampled_from([4, 7, 20]), st.sampled_from([0.9, 1.5, 1.9, 2.2]))
def test_sliding_entropy_matches_each_window_counted_anew(text, window, bits):
    covered = set()
    for i in range(len(text) - window + 1):
        counts = Counter(text[i : i + window])
        entropy = -sum(n / window * math.log2(n / window) for n in counts.values())
        if abs(entropy - bits) < 1e-6:
            return  # a tie is decided by rounding
        if entropy >= bits:
            covered.update(range(i, i + window))
    got = secret_scan.hot_windows(text, window, bits)
    assert {i for a, b in got for i in range(a, b)} == covered
    assert all(x[1] < y[0] for x, y in zip(got, got[1:]))


KEY, HEXES = "Zq9Lm2Xv8Tb4Rk7Wd1NsG5hJ", "9F3A7C41D0B82E65F7A1"


def test_entropy_adds_spans_and_the_allow_list_suppresses():
    of = lambda text: [(k, text[a:b]) for a, b, k in secret_scan.spans(text)]
    assert of(f"use {KEY} here") == [("entropy_base64", KEY)]
    assert of(f"\U0001d4b3 {HEXES}.") == [("entropy_hex", HEXES)]
    assert of("k3f9zq7w2m8x4t1v6y0p") == [("entropy_base36", "k3f9zq7w2m8x4t1v6y0p")]
    assert of("123e4567-e89b-12d3-a456-426614174000") == []
    assert of("EXAMPLE" + KEY) == [] and of(f"sha256: {HEXES}") == [] and of("abcdefghijKLMN0123456789") == []
    assert of("internationalization-of-words") == [] and of("q" * 100_000 + "1B") == []
    assert of(f"token={KEY}") == [("assign", f"token={KEY}")]  # the match holds the stretch
    assert secret_scan.spans(f"use {KEY} here", secret_scan.allow_list([KEY])) == []
    assert secret_scan.spans("EXAMPLE" + KEY, secret_scan.allow_list([])) != []
    hexes = "da39a3ee5e6b4b0d3255bfef95601890afd80709"
    assert of(hexes) == [("hex", hexes)]  # patterns stay whatever is allowed


def test_find_counts_and_digests(rows):
    text = f"\U0001d4b3 token = abcdef1 AKIA{'Q' * 16} {'0a' * 12} {KEY}"
    got = {r.doc_id: r for r in secret_scan.find(rows([(1, text), (2, None), (3, ""), (1, text)], "doc_id bigint, text string")).collect()}
    base = ",".join(f"{k}:{a}:{b}" for a, b, k in plain_base(text))
    assert (got[1].n_assign, got[1].n_access, got[1].n_hex, got[1].n_entropy) == (1, 1, 1, 1)
    assert got[1].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and got[1].spans.startswith(base)
    assert got[2].spans == got[3].spans == "" and got[2].base_sha256 == hashlib.sha256(b"").hexdigest()
