from __future__ import annotations

import random
from itertools import product

import numpy as np
import pytest
from llm.conftest import rows_by_id

from stayrate.llm import toxicity
from stayrate.llm.toxicity import Training, fitted, forward_backward, scored, without_toxic

BAD = ["idiot", "moron", "scum"]


def corpus(n, seed):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 8)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(draw.randint(5, 80))]
        toxic = i % 5 == 0
        for _ in range(draw.randint(1, 4) if toxic else 0):
            bad = draw.choice(BAD) if draw.random() < 0.5 else "grunz" + word()
            words[draw.randrange(len(words))] = draw.choice([bad, bad.upper(), f"“{bad}!”"])
        rows.append((i + seed * 10_000, " ".join(words)))
        labels.append((i + seed * 10_000, int(toxic)))
    return rows, labels


def test_marginals_are_those_of_all_paths():
    draw = np.random.default_rng(0)
    emission, moves, start = draw.normal(size=(4, 5)), draw.normal(size=(2, 2)), 0.3
    lengths = [5, 3, 1, 2]
    present = np.arange(5)[None, :] < np.array(lengths)[:, None]
    chance, expected = forward_backward(np.where(present, emission, 0.0), present, start, moves)
    pairs = np.zeros((2, 2))
    for i, n in enumerate(lengths):
        weights, tagged, joint = 0.0, np.zeros(n), np.zeros((2, 2))
        for path in product((0, 1), repeat=n):
            w = np.exp(start * path[0] + sum(emission[i, t] * s for t, s in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:])))
            weights += w
            tagged += w * np.array(path)
            for a, b in zip(path, path[1:]):
                joint[a, b] += w
        assert np.allclose(chance[i, :n], tagged / weights) and not chance[i, n:].any()
        pairs += joint / weights
    assert np.allclose(expected, pairs)


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = corpus(1500, 1)
    labels += [(1, None), (None, 1), (10**9, 1)]
    return fitted(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), Training(buckets=1 << 16)
    )


def test_unseen_documents_are_told_apart_and_spans_point_at_the_words(documents_of, model):
    rows, labels = corpus(400, 2)
    out = rows_by_id(scored(documents_of(rows), model))
    truth, text = dict(labels), dict(rows)
    right = sum(out[d]["predicted"] == t for d, t in truth.items())
    assert right / len(truth) > 0.97
    marked = [text[d][s["start"] : s["end"]].lower() for d, r in out.items() for s in r["spans"]]
    assert len(marked) >= sum(truth.values())
    assert sum(any(b in m for b in [*BAD, "grunz"]) for m in marked) / len(marked) > 0.97
    kept = {r["doc_id"] for r in without_toxic(documents_of(rows), model).collect()}
    assert kept == {d for d, r in out.items() if not r["predicted"]}


def test_nulls_empty_and_long_texts_repeats(documents_of, model):
    rows = [(1, None), (2, ""), (3, " ... "), (4, "abc " * 100_000 + "Idiot"), (5, "é — idiot"), (5, "é — idiot"), (None, "idiot")]
    out = scored(documents_of(rows), model).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[1]["score"] == by_id[2]["score"] == by_id[3]["score"] < 0.5
    assert all(0 <= r["score"] <= 1 for r in out)
    assert [tuple(s) for s in by_id[5]["spans"]] == [(4, 9)]
    assert [tuple(s) for s in by_id[4]["spans"]] == [(400_000, 400_005)]
    assert scored(documents_of([]), model).count() == 0


@pytest.mark.parametrize(("labels", "score"), [([], 0.0), ([(1, 0), (2, 0)], 0.0), ([(1, 1)], 1.0), ([(77, 1), (78, 0), (79, 0), (80, 0)], 0.25)])
def test_labels_of_one_kind_or_of_no_document(spark, documents_of, labels, score):
    documents = documents_of([(1, "a b"), (2, None)])
    model = fitted(documents, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r["score"] for r in scored(documents, model).collect()} == {score}


def test_plain_keeps_byte_places():
    assert toxicity.plain("Ab-É1") == "ab É1".encode()


def test_a_much_copied_toxic_text_does_not_make_its_words_toxic(spark, documents_of):
    rows, labels = corpus(800, 3)
    draw = random.Random(5)
    words = [f"rare{draw.randrange(10**6)}x{i}" for i in range(60)]
    for i in range(40):
        text = list(words)
        text[draw.randrange(60)] = "idiot"
        text[draw.randrange(60)] = f"edit{i}"
        rows.append((90_000 + i, " ".join(text)))
        labels.append((90_000 + i, 1))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = fitted(frame, spark.createDataFrame(labels, "doc_id long, toxic int"), Training(buckets=1 << 16))
    out = rows_by_id(scored(documents_of([(1, " ".join(words[:30])), (2, " ".join([*words[:30], "idiot"]))]), model))
    assert (out[1]["predicted"], out[2]["predicted"]) == (0, 1)


def test_the_sample_is_bounded_in_bytes_and_takes_a_row_for_each_id(spark, documents_of, monkeypatch):
    rows, labels = corpus(200, 3)
    draw = random.Random(7)
    rows += [(90_000 + i, " ".join(draw.choice(["calm", "river", "stone"]) for _ in range(20_000))) for i in range(30)]
    rows += [(90_100, "w " * 300_000), (30_001, "zz " * 1000), (30_001, "zz " * 1000), (None, "no id")]
    labels += [(90_000 + i, i % 2) for i in range(30)] + [(90_100, 1)]
    sizes = {}
    kept = lambda texts, toxic, share, how: sizes.update(
        {"toxic": sum(len(t) for t, x in zip(texts, toxic) if x), "clean": sum(len(t) for t, x in zip(texts, toxic) if not x), "n": len(texts)}
    )
    seen = []
    real = toxicity.Model

    def recorded(*args):
        kept(*args)
        return real(float(sizes["n"]), None, float(sizes["toxic"]), np.array([sizes["clean"]]))

    monkeypatch.setattr(toxicity, "fit", recorded)
    df, table = documents_of(rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    for most in (200_000, 32_000_000):
        model = fitted(df, table, Training(most_bytes=most))
        seen.append((model.prior, model.start, model.moves[0]))
    assert seen[0][1] <= 200_000 and seen[0][2] <= 200_000 and seen[0][0] < seen[1][0]
    assert seen[1][0] == len(labels)
    assert seen[1][1] + seen[1][2] == sum(min(len(t.encode()) for d, t in rows if d == i) for i, _ in labels)
