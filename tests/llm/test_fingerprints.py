from __future__ import annotations

import hashlib
import random

from llm.conftest import rows_by_id

from stayrate.llm.fingerprints import compared_with_next, edit, fingerprinted, fingerprints, likeness, near_fingerprints


def test_fingerprints_follow_the_text():
    draw = random.Random(2)
    words = [f"w{draw.randrange(500)}" for _ in range(400)]
    text, other = " ".join(words), " ".join(f"v{draw.randrange(500)}" for _ in range(400))
    near = " ".join(words[:390] + ["new"] * 10)
    a, b, c, d = fingerprints([t.encode() for t in (text, near, other, text)])
    assert a == d
    assert likeness(a, b) > 0.85 > 0.65 > likeness(a, c)
    assert fingerprints([b"", None, b" \n"]) == ["0" * 32] * 3


def test_edits_and_successors_by_brute_force(documents_of):
    draw = random.Random(4)
    rows = [(draw.randrange(10**6), "é" * draw.randrange(3) + " ".join(f"w{draw.randrange(99)}" for _ in range(draw.randrange(60)))) for _ in range(400)]
    rows = list({d: (d, t) for d, t in rows}.values()) + [(-5, None), (10**7, "last one here")]
    out = rows_by_id(compared_with_next(documents_of(rows), rows_each=50))
    ordered = sorted(rows)
    assert len(out) == len(rows)
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        text, after = text or "", after or ""
        changed = text[: len(text) - len(text) // 4] + after[: len(text) // 4]
        r = out[doc_id]
        mine, theirs, edited = fingerprints([text.encode(), after.encode(), changed.encode()])
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (mine, edited)
        assert (r["near_edited"], r["near_next"]) == (likeness(mine, edited), likeness(mine, theirs))


def test_one_document_none_and_repeats(documents_of):
    one = compared_with_next(documents_of([(1, "abcd efgh")])).collect()
    assert [r["near_next"] for r in one] == [1.0]
    assert compared_with_next(documents_of([])).count() == 0
    rows = [(1, "b b"), (1, "a a"), (1, "a a"), (None, "x y"), (2, "")]
    assert compared_with_next(documents_of(rows)).count() == 5


def test_edit_replaces_a_quarter():
    assert edit("abcdefgh", "XYZ") == "abcdefXY"
    assert edit("abcdefgh", "X") == "abcdefX"
    assert edit("abc", "XYZ") == "abc"


def test_all_pairs_within_the_radius(spark):
    draw = random.Random(8)
    prints = [f"{draw.getrandbits(128):032x}" for _ in range(150)]
    for _ in range(150):
        value = int(draw.choice(prints), 16)
        for bit in draw.sample(range(128), draw.randrange(0, 12)):
            value ^= 1 << bit
        prints.append(f"{value:032x}")
    df = spark.createDataFrame([*enumerate(prints), (999, None)], "doc_id long, fingerprint string")
    pairs, members = near_fingerprints(df, radius=6)
    distinct = sorted(set(prints))
    want = {
        (a, b, n)
        for i, a in enumerate(distinct)
        for b in distinct[i + 1 :]
        if (n := (int(a, 16) ^ int(b, 16)).bit_count()) <= 6
    }
    found = [tuple(r) for r in pairs.collect()]
    assert len(found) == len(set(found))
    assert set(found) == want and len(want) > 20
    assert members.count() == len(prints)


def test_fingerprinted_documents(documents_of):
    out = rows_by_id(fingerprinted(documents_of([(1, "a b c"), (2, None), (3, "a b c")])))
    assert out[1]["fingerprint"] == out[3]["fingerprint"] != out[2]["fingerprint"]
