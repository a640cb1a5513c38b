from __future__ import annotations

import random
import re
import time

from llm.conftest import rows_by_id

from stayrate.llm.repeats import Anchors, Phrases, without_repeats


def brute(rows, window):
    seen, out = {}, {}
    for doc_id, text in sorted(rows):
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        hit = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if seen.setdefault(key, doc_id) < doc_id:
                hit[i : i + window] = [True] * window
        out[doc_id] = (len(words), sum(hit), " ".join(w for w, h in zip(words, hit) if not h))
    return out


def corpus(window):
    draw = random.Random(7)
    new = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    passages = [new(draw.randint(window // 2, 4 * window)) for _ in range(12)]
    rows = []
    for i in range(120):
        words = new(draw.randrange(0, 3 * window))
        for _ in range(draw.randrange(0, 4)):
            p = draw.choice(passages)
            a = draw.randrange(len(p))
            b = draw.randrange(a, len(p)) + 1
            at = draw.randrange(len(words) + 1)
            words[at:at] = p[a:b] if draw.random() < 0.7 else p
        rows.append((i * 3, " \n"[draw.randrange(2)].join(words)))
    rows += [(1, rows[5][1]), (4, rows[5][1]), (700, rows[40][1]), (701, "same " * (3 * window)), (702, "same " * (2 * window))]
    rows += [(703, "ends " + "same " * window + "here"), (704, None), (705, ""), (706, " ".join(new(window - 1)))]
    rows += [(707, rows[-1][1]), (708, "É " * window), (709, "É " * window + "é"), (710, "\x1c\x1c " * window), (711, "\x1c\x1c " * window)]
    draw.shuffle(rows)
    return rows


def test_words_removed_are_those_of_brute_force(documents_of):
    for window in (8, 50):
        rows = corpus(window)
        want = brute(rows, window)
        out = rows_by_id(without_repeats(documents_of(rows), window=window, block_bytes=4000))
        assert {d: (r["n_words"], r["n_removed"], r["kept"]) for d, r in out.items()} == want
        assert sum(n for _, n, _ in want.values()) > 500
        for r in out.values():
            assert sum(x["end"] - x["start"] for x in r["removed"]) == r["n_removed"]


def test_passage_shared_by_two_that_the_first_holder_of_its_middle_lacks(documents_of):
    middle = [f"m{i}" for i in range(30)]
    a, b = [f"a{i}" for i in range(15)], [f"b{i}" for i in range(15)]
    rows = [(1, " ".join(["x", *middle, "y"])), (2, " ".join([*a, *middle, *b])), (3, " ".join(["z", *a, *middle, *b, "z"]))]
    out = rows_by_id(without_repeats(documents_of(rows), window=50))
    assert [out[k]["n_removed"] for k in (1, 2, 3)] == [0, 0, 60]


def test_rows_without_id_and_empty_table(documents_of):
    text = " ".join(f"w{i}" for i in range(60))
    out = without_repeats(documents_of([(None, text), (None, text), (1, text)])).collect()
    assert [r["n_removed"] for r in out] == [0, 0, 0]
    assert without_repeats(documents_of([])).count() == 0


def _held(words, passages, window):
    """Words in a window that some passage holds, by looking at every window."""
    every = {tuple(p[i : i + window]) for p in passages for i in range(len(p) - window + 1)}
    hit = [False] * len(words)
    for i in range(len(words) - window + 1):
        if tuple(words[i : i + window]) in every:
            hit[i : i + window] = [True] * window
    return hit


def test_coverage_is_that_of_all_windows():
    draw = random.Random(12)
    for trial in range(300):
        window = draw.choice([2, 3, 5, 6, 9])
        phrase = [draw.choice([b"a", b"b"]) for _ in range(draw.randint(1, 4))]
        some = lambda n: draw.choice([[draw.choice([b"a", b"b"]) for _ in range(n)], (phrase * n)[:n], [b"a"] * n])
        passages = [some(draw.randint(window, 40)) for _ in range(draw.randint(1, 4))]
        phrases = Phrases(Anchors(window))
        numbers = [phrases.add(p) for p in passages]
        allowed = {n for n in numbers if draw.random() < 0.8}
        words = sum((draw.choice([some(draw.randint(0, 20)), draw.choice(passages)[draw.randint(0, 5) :]]) for _ in range(draw.randint(0, 5))), [])
        want = _held(words, [passages[n] for n in allowed], window)
        assert phrases.covered(words, allowed).tolist() == want, (trial, window, passages, words)


def test_one_word_repeated_takes_linear_time():
    for text, passage, covered in (
        ([b"w"] * 100_000, [b"w"] * 50_000, 100_000),
        (([b"w"] * 49 + [b"x"]) * 2_000, [b"w"] * 50_000, 0),
        ([b"w", b"x"] * 50_000, [b"w", b"x"] * 25_000, 100_000),
    ):
        phrases = Phrases(Anchors(50))
        start = time.process_time()
        assert phrases.covered(text, {phrases.add(passage)}).sum() == covered
        assert time.process_time() - start < 20
