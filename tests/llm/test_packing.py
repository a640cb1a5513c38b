from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stayrate.llm.packing import encoder, packed, packed_documents, packing_patterns, pieces, sequences
from stayrate.llm.scratch import written

TEXTS = [
    "", "a", "Hello world", "  spaces \n\n\t tabs ", "naïve Ünïcödé 中文 🙂", "x" * 5000, "12345 don't I'll",
    "<|endoftext|> said", "  ​  ", "ab " * 3000,
]


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizer_file(reference):
    draw = random.Random(5)
    alphabet = "ab Z9.,'\n\té🙂中 "
    texts = TEXTS + ["".join(draw.choice(alphabet) for _ in range(60)) for _ in range(300)]
    encode = encoder("byte_bpe_50k")
    assert all(list(encode(t)) == reference(t) for t in texts)


@pytest.mark.parametrize("histogram", [{}, {1024: 3}, {1: 5000}, {300: 1700, 5: 3, 1024: 10}, {513: 10, 511: 3, 2: 100}])
def test_patterns_hold_every_piece_once_and_fit(histogram):
    held = Counter()
    for lengths, count in packing_patterns(histogram, 1024):
        assert sum(lengths) <= 1024
        for length in lengths:
            held[length] += count
    assert held == Counter(histogram)


def test_patterns_of_a_wide_histogram_leave_little_room():
    draw = random.Random(1)
    histogram = Counter(draw.randint(1, 1024) for _ in range(20_000))
    patterns = packing_patterns(histogram, 1024)
    tokens = sum(k * n for k, n in histogram.items())
    assert tokens / (1024 * sum(n for _, n in patterns)) > 0.98


def test_pieces_and_sequences_give_back_every_document(documents_of, reference):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (51, "a"), (51, "a"), (None, "b")]
    rows += [(100 + i, "copy of a text") for i in range(60)]
    cut = written(pieces(documents_of(rows), with_ids=True), "pieces")
    placed = packed(cut)
    found = placed.toPandas()
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert (group["length"].cumsum() - group["length"] == group["offset"]).all()
        assert group["length"].sum() <= 1024
    assert sorted(set(found["sequence_id"])) == list(range(found["sequence_id"].nunique()))
    whole = {r["sequence_id"]: r for r in sequences(placed).collect()}
    for r in found.itertuples():
        ids = np.array(whole[r.sequence_id]["ids"][r.offset : r.offset + r.length], dtype="<u4")
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
    for s in whole.values():
        assert len(s["ids"]) == (s["n_ids"] if s["n_ids"].bit_count() == 1 else 1024)
    for doc_id, text in rows:
        if doc_id in (None, 51):
            continue
        parts = sorted((r.start, r.sequence_id, r.offset, r.length) for r in found[found["doc_id"] == doc_id].itertuples())
        ids = [i for _, s, o, n in parts for i in whole[s]["ids"][o : o + n]]
        assert ids == [*reference(text or ""), 0]
    assert len(found[found["doc_id"] == 51]) == 2


def test_no_documents_no_sequences(documents_of):
    assert packed(written(pieces(documents_of([])), "pieces")).count() == 0


def test_queries_give_the_ids_of_the_unmodified_tokenizer(documents_of):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [*TEXTS, "hi <|endoftext|> there", "a  <|endoftext|>  \n<|endoftext|><|endoftext|>", "<|endoftext", "x<|endoftext|>'s"]
    want = {i: [*plain.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert all([*encoder("byte_bpe_50k", added=True)(t), 0] == want[i] for i, t in enumerate(texts))
    found = packed_documents(documents_of(list(enumerate(texts)))).collect()
    assert {r["doc_id"] for r in found} == set(want)
    for r in found:
        part = np.array(want[r["doc_id"]][r["start"] : r["start"] + r["length"]], dtype="<u4")
        assert (r["doc_tokens"], r["ids_crc32"]) == (len(want[r["doc_id"]]), zlib.crc32(part.tobytes()))
