"""Near copies by SimHash, bands and shingle sets, against all pairs."""

import random

import numpy as np
import pytest

from shopvitals.llm import near_copies
from tests.llm.test_operators import DOCS, classes_of


def test_near_copies_leave_one_and_others_stay(spark, rows):
    draw = random.Random(5)
    words = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(4000)]
    texts, wanted = {}, set()
    for g in range(25):
        base = draw.sample(words, 200)
        wanted.add(10 * g)
        for k in range(4):
            copy = list(base)
            if k:
                copy[draw.randrange(200)] = f"edit{k}"
            texts[10 * g + k] = " ".join(copy)
    docs = [(i, t, "s") for i, t in texts.items()] + [(0, texts[0], "s"), (None, texts[0], "s"), (900, None, "s"), (901, "", "s")]
    kept = near_copies.without_near_copies(rows(docs, DOCS)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(wanted | {900})
    assert sum(r.doc_id is None for r in kept) == 1


@pytest.mark.parametrize("low,high,gone", [(0.80, 0.85, True), (0.70, 0.7999, False)])
def test_near_copies_are_those_of_the_shingle_sets(rows, low, high, gone):
    draw = random.Random(11)
    word = lambda: "".join(draw.choices("abcdefghij", k=7))
    shingles = lambda x: {tuple(x[i : i + 5]) for i in range(len(x) - 4)}
    docs, n_pairs = [], 0
    while n_pairs < 80:
        base = [word() for _ in range(draw.randrange(60, 300))]
        copy, wanted = list(base), draw.uniform(low, high)
        likeness = 1.0
        while likeness > wanted:
            copy[draw.randrange(len(copy))] = word()
            a, b = shingles(base), shingles(copy)
            likeness = len(a & b) / len(a | b)
        if low <= likeness <= high:
            docs += [(2 * n_pairs, " ".join(base), "s"), (2 * n_pairs + 1, " ".join(copy), "s")]
            n_pairs += 1
    kept = sorted(r.doc_id for r in near_copies.without_near_copies(rows(docs, DOCS)).collect())
    assert kept == [d[0] for d in docs if not (gone and d[0] % 2)]


def drifting(n, groups, seed=3):
    """Sets of which only neighbours are alike, so that far members link through others."""
    draw = random.Random(seed)
    sets, base = {}, []
    for i in range(n):
        if i % (n // groups) == 0:
            base = [draw.getrandbits(60) for _ in range(100)]
        base = (base[draw.randrange(4, 14) :] + [draw.getrandbits(60) for _ in range(100)])[:100]
        sets[i] = np.unique(np.array(base, np.uint64))
    return sets


def same(a, b):
    a, b = set(a.tolist()), set(b.tolist())
    return 10 * len(a & b) >= 8 * len(a | b)


@pytest.mark.parametrize("cell, size", [(4096, 32 << 20), (16, 32 << 20), (4096, 10_000)])
def test_cells_connect_what_all_pairs_do(spark, rows, monkeypatch, cell, size):
    monkeypatch.setattr(near_copies, "CELL", cell)
    monkeypatch.setattr(near_copies, "CELL_BYTES", size)
    sets = drifting(60, 5)
    cells = rows([(k, i) for i in sets for k in (0, 1 + i % 2)], "key bigint, node bigint")
    nodes = spark.createDataFrame(
        [(i, len(x), bytearray(near_copies.sketch(near_copies.minima(x)))) for i, x in sets.items()], "node long, n_set long, sketch binary")
    frame = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in sets.items()], "node long, shingles binary")
    known = rows([(1, 0)] if same(sets[0], sets[1]) else [], "node bigint, component bigint")
    got = [(r.a, r.b) for r in near_copies.cell_links(cells, nodes, frame, known, 8)[0].collect()]
    every = [(i, j) for i in sets for j in range(i) if same(sets[i], sets[j])]
    assert every and all(same(sets[a], sets[b]) for a, b in got) and len(got) <= 3 * 60
    given = [(r.node, r.component) for r in known.collect()]
    assert classes_of(60, got + given) == classes_of(60, every)


def test_neighbours_of_a_class_are_checked_across_batches():
    import pandas as pd

    sets = drifting(40, 2, seed=8)
    frame = pd.DataFrame({"block": [i // 20 for i in sets], "node": list(sets), "shingles": [x.tobytes() for x in sets.values()]})
    got = [tuple(map(int, r)) for part in near_copies.chained([frame[:7], frame[7:25], frame[25:]], 8) for r in part.to_numpy()]
    assert got and all(same(sets[a], sets[b]) and a // 20 == b // 20 for a, b in got)
    assert {a for a, _ in got} == {i for i in sets if any(same(sets[i], sets[j]) for j in range(max(i - 4, i // 20 * 20), i))}


def test_cells_are_whole_across_batches():
    import pandas as pd

    frame = pd.DataFrame({"key": [1, 1, 2, 3, 3, 3, 3, 4], "node": range(8)})
    parts = [frame[:1], frame[1:1], frame[1:5], frame[5:6], frame[6:]]
    assert [c["node"].tolist() for c in near_copies.whole_cells(parts)] == [[0, 1], [2], [3, 4, 5, 6], [7]]


def test_a_repeated_id_with_other_texts_is_two_documents(rows):
    a, b = ("one two three four five six seven", "eight nine ten eleven twelve thirteen")
    kept = near_copies.without_near_copies(rows([(0, a, "s"), (1, a, "s"), (1, b, "s"), (1, b, "s")], DOCS)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(0, a), (1, b)]


@pytest.mark.parametrize("n", [150, 300])
def test_texts_below_the_similarity_cost_no_pairs_of_rows(spark, rows, n):
    """Texts that share three words of four and are not alike: rows between the steps follow the texts, not their pairs."""
    draw = random.Random(n)
    base = [f"w{draw.getrandbits(30)}" for _ in range(200)]
    docs = []
    for i in range(n):
        at = draw.randrange(150)
        text = base[:at] + [f"x{draw.getrandbits(30)}" for _ in range(50)] + base[at + 50 :]
        docs.append((i, " ".join(text), "s"))
    frame = rows(docs, DOCS)
    shingles = [near_copies.shingle_set(t, 5) for _, t, _ in docs]
    alike = [(i, j) for i in range(n) for j in range(i) if near_copies.alike(shingles[i], shingles[j], 8)]
    kept = near_copies.without_near_copies(frame)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(classes_of(n, alike)))


def test_no_documents(rows):
    assert near_copies.without_near_copies(rows([], DOCS)).count() == 0
    assert near_copies.without_near_copies(rows([(None, "a", "s"), (3, None, "s")], DOCS)).count() == 2


def test_the_map_of_bits_never_misses(rows):
    from pyspark.sql import functions as F

    from shopvitals.llm.common import may_be_in

    table = rows([(i, f"t{i}") for i in range(0, 300, 3)] + [(None, "n")], "a bigint, b string")
    every = rows([(i, f"t{i}") for i in range(300)] + [(None, "n"), (5, None)], "x bigint, y string")
    for bits in (1 << 26, 1 << 15):
        got = {r.x for r in every.where(may_be_in([F.col("x"), F.col("y")], table, ["a", "b"], bits)).collect()}
        assert {*range(0, 300, 3), None} <= got and len(got) < 130
    assert every.where(may_be_in([F.col("x")], table.limit(0), ["a"])).count() == 0
