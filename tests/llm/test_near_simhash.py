from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from llm.conftest import rows_by_id

from stayrate.llm.near_simhash import Grid, fingerprint, near_groups, near_links


def vote(text: str | None) -> int:
    """The fingerprint, bit by bit."""
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups_of(prints: list[int], radius: int = 3) -> list[int]:
    """For each fingerprint the first one in its component."""
    array, of = np.array(prints, dtype=np.uint64), list(range(len(prints)))
    stack, seen = [], set()
    for i in range(len(prints)):
        if i in seen:
            continue
        stack, seen = [i], seen | {i}
        while stack:
            k = stack.pop()
            of[k] = i
            for n in np.flatnonzero(np.bitwise_count(array ^ array[k]) <= radius).tolist():
                if n not in seen:
                    seen.add(n)
                    stack.append(n)
    return of


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints_bit_by_bit(spark):
    from pyspark.sql import functions as F

    draw = random.Random(1)
    texts = ["", " \n", "One", "one TWO", "a b c", "É é x y z \x1c w", "a b c " * 400]
    texts += [" ".join(draw.choice(["Ab", "cd", "é", "x1"]) for _ in range(draw.randrange(60))) for _ in range(80)]
    assert [fingerprint(t.encode()) for t in texts] == [vote(t) for t in texts]
    # Spark's own hash of a single shingle is the fingerprint of that shingle.
    own = spark.createDataFrame([("alpha beta gamma",)], "t string").select(F.xxhash64("t")).first()[0]
    assert own == signed(fingerprint(b"alpha Beta gamma"))


def test_counting_in_pieces_changes_nothing(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(5000)).encode()
    whole = fingerprint(text)
    monkeypatch.setattr("stayrate.llm.near_simhash.VOTES_AT_ONCE", 64)
    assert fingerprint(text) == whole


def crowd(seed: int, alone: int, hubs: int, around: int) -> list[int]:
    draw = random.Random(seed)
    prints = {draw.getrandbits(64) for _ in range(alone)} | {0, (1 << 64) - 1, 1 << 63}
    for _ in range(hubs):
        centre = draw.getrandbits(64)
        for _ in range(around):
            one = centre
            for bit in draw.sample(range(64), draw.randrange(7)):
                one ^= 1 << bit
            prints.add(one)
    return sorted(prints)


@pytest.mark.parametrize("grid", [Grid(), Grid(chunk=16), Grid(segments=16), Grid(radius=1, segments=32), Grid(radius=5, segments=64, parts=4)])
def test_links_join_what_is_within_the_radius(spark, grid):
    prints = crowd(2, 300, 6, 150)
    rows = near_links(spark.createDataFrame([(signed(p),) for p in prints], "print long"), grid).collect()
    of, place = groups_of(prints, grid.radius), {signed(p): i for i, p in enumerate(prints)}
    assert all(r["a"] < r["b"] and (r["a"] ^ r["b"]) % (1 << 64) != 0 for r in rows)
    assert all(((r["a"] ^ r["b"]) % (1 << 64)).bit_count() <= grid.radius for r in rows)
    joined = list(range(len(prints)))
    for _ in range(len(prints)):
        before = list(joined)
        for r in rows:
            a, b = place[r["a"]], place[r["b"]]
            joined[a] = joined[b] = min(joined[a], joined[b])
        if joined == before:
            break
    assert joined == of


def test_a_crowded_cell_gives_few_links(spark):
    draw = random.Random(5)
    low = {0}
    while len(low) < 400:
        low.add(sum(1 << (32 + b) for b in draw.sample(range(32), 2)))
    rows = near_links(spark.createDataFrame([(signed(p),) for p in sorted(low)], "print long"), Grid(segments=32))
    assert rows.count() < 20 * len(low)


def test_groups_by_brute_force(documents_of):
    draw = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    rows, texts = [], []
    for _ in range(60):
        base = [draw.choice(words) for _ in range(draw.randrange(3, 300))]
        texts.append(base)
        for _ in range(4):
            near = list(base)
            for _ in range(draw.randrange(3)):
                near[draw.randrange(len(near))] = draw.choice(words)
            texts.append(near)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rows += [(1000, ""), (1001, None), (1002, " \t"), (1003, "one"), (1004, "ONE"), (None, "one"), (None, "nobody else says"), (1005, "one"), (1005, "one")]
    found = near_groups(documents_of(rows)).collect()
    prints = [vote(t) for _, t in rows]
    of = groups_of(prints)
    least = {}
    for (doc_id, _), g in zip(rows, of):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    expected = [(d, f"{p:016x}", least.get(g)) for (d, _), p, g in zip(rows, prints, of)]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert len(set(of)) < len(set(prints)) < len(rows)


def test_empty_table_and_a_very_long_text(documents_of):
    assert near_groups(documents_of([])).count() == 0
    long = " ".join(f"w{i}" for i in range(150_000))
    out = rows_by_id(near_groups(documents_of([(4, long), (2, long), (9, "short")])))
    assert (out[4]["component_id"], out[2]["component_id"], out[9]["component_id"]) == (2, 2, 9)
    assert int(out[4]["fingerprint"], 16) == fingerprint(long.encode())
