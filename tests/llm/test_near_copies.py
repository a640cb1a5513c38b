from __future__ import annotations

import random
import re

import numpy as np
import pytest
from llm.conftest import rows_by_id

from stayrate.llm.compact import compact
from stayrate.llm.near_copies import Banding, between_neighbours, half_keys, near_copies


def brute(rows, width):
    """doc_id -> (set size, component) by comparing all sets."""
    lower = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})
    sets = {}
    for doc_id, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(lower))
        sets[doc_id] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in sets}


def corpus():
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(4000)]
    rows, next_id = [], 0
    for _ in range(25):
        base = [draw.choice(vocabulary) for _ in range(draw.randint(30, 300))]
        family = [base]
        for _ in range(draw.choice([0, 1, 3, 12])):
            # Edits pile up, so that a family is a chain whose ends may be unlike each other.
            text = list(draw.choice(family))
            for _ in range(max(1, len(text) * draw.choice([1, 2, 4, 6, 8]) // 100)):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
            family.append(text)
        for text in family:
            rows.append((next_id, " ".join(text)))
            next_id += 1
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_groups_are_those_of_all_pairs(documents_of, width):
    rows = corpus()
    out = rows_by_id(near_copies(documents_of(rows), width=width))
    want = brute(rows, width)
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in out.items()} == want
    assert all(r["kept"] == (r["component_id"] == d) for d, r in out.items())


def test_nulls_empty_texts_copies_and_repeats(documents_of):
    rows = [(5, "A b C d"), (3, "a  B\tc d"), (9, None), (8, ""), (7, "  \n"), (4, "x"), (2, "X"), (None, "a b c d"), (3, "a b c d")]
    found = sorted(near_copies(documents_of(rows), width=2).collect(), key=str)
    by_id = {(r["doc_id"], r["component_id"], r["kept"]) for r in found}
    assert len(found) == len(rows)
    assert by_id == {(5, 3, False), (3, 3, True), (9, 9, True), (8, 8, True), (7, 7, True), (4, 2, False), (2, 2, True), (None, 3, False)}


def test_empty_table(documents_of):
    assert near_copies(documents_of([])).count() == 0


def test_similar_sets_miss_every_table_as_rarely_as_said():
    draw = np.random.default_rng(1)
    banding, n = Banding(), 400
    left, right = [], []
    for _ in range(n):
        words = draw.integers(0, 2**63, size=110, dtype=np.uint64)
        left.append(np.unique(words[:99]))
        right.append(np.unique(np.concatenate([words[:88], words[99:]])))
    a, b = half_keys(left, banding), half_keys(right, banding)
    shared = [(x == y).sum(axis=1) for x, y in zip(a, b)]
    assert ((shared[0] > 0) & (shared[1] > 0)).all()
    similarity = 88 / 110
    assert abs(np.mean(shared) / banding.bands - similarity**banding.rows) < 0.03


@pytest.mark.parametrize("sizes", [(1, 2, 2), (2, 1, 3), (3, 2, 1), (1, 1, 1)])
def test_groups_that_met_only_a_hub_are_compared(spark, documents_of, sizes):
    """A link between two groups, each of which met nothing but the hub of a third, whichever is larger."""
    draw = random.Random(4)
    words = lambda n: [f"x{draw.randrange(10**6)}" for _ in range(n)]
    base, rows, parts = words(100), [], []
    hub_part, left, right = sizes
    texts = [[*base[:20], *words(80)]] + [words(100) for _ in range(hub_part - 1)]
    texts += [base] + [words(100) for _ in range(left - 1)] + [[*base[:95], *words(5)]] + [words(100) for _ in range(right - 1)]
    firsts = [0, hub_part, hub_part + left]
    for k, text in enumerate(texts):
        rows.append((k, " ".join(text)))
        parts.append((k, max(f for f in firsts if f <= k)))
    _, x, y = firsts
    sketch = [1] * 26
    given = compact(documents_of(rows).select("doc_id", "text")).toDF("vertex", "data")
    given = given.selectExpr("vertex", "data", f"cast(array({', '.join(map(str, sketch))}) as array<tinyint>) sketch")
    met = spark.createDataFrame([(0, x, True, False), (0, y, True, False)], "a long, b long, a_hub boolean, b_hub boolean")
    found = between_neighbours(met, given, spark.createDataFrame(parts, "vertex long, part long"), 2, 0.8, 3)
    assert [tuple(r) for r in found.collect()] == [(x, y)]
