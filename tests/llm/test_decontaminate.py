from __future__ import annotations

import random
import re

import pytest
from llm.conftest import rows_by_id

from stayrate.llm.decontaminate import benchmark_hits, stored_windows, without_hits

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(documents, items, width):
    windows = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        for i in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + width]), set()).add(str(item))
    out = {}
    for doc_id, text in documents:
        lowered = (text or "").translate(LOWER)
        words = WORD.findall(lowered)
        hit, found = [False] * len(words), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if names := windows.get(tuple(words[i : i + size])):
                    hit[i : i + size] = [True] * size
                    found |= names
        out[doc_id] = (len(words), sum(hit), sorted(found))
    return out


@pytest.mark.parametrize("most_bytes", [8_000_000, 300])
def test_hits_are_those_of_brute_force(spark, documents_of, most_bytes):
    draw = random.Random(6)
    text = lambda n: " ".join(draw.choice(["a", "B", "c1", "d", "é", "Z"]) for _ in range(n))
    items = [(i, text(draw.randint(1, 14))) for i in range(40)] + [(90, None), (91, ""), (92, "..."), (None, "zz yy"), (10, "q q q")]
    rows = [(i, re.sub(" ", lambda m: draw.choice([" ", ", ", "-\n", "\x7f"]), text(draw.randint(0, 60)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, items[0][1]), (73, f"xx {items[3][1]}zz"), (74, "zz\tYY"), (75, "q q q q")]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as runs", "2 as items")
    out = rows_by_id(benchmark_hits(documents_of(rows), bench, width=5, most_bytes=most_bytes))
    want = brute(rows, items, 5)
    assert {d: (r["n_words"], r["n_hit"], r["items"]) for d, r in out.items()} == want
    assert 0 < sum(1 for _, n, _ in want.values() if n) < len(want)
    originals = dict(rows)
    for d, r in out.items():
        inside = [WORD.findall(originals[d].translate(LOWER)[s["start"] : s["end"]]) for s in r["spans"]]
        assert sum(map(len, inside)) == r["n_hit"]


def test_no_items_and_no_documents(spark, documents_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["n_hit"] for r in benchmark_hits(documents_of([(1, "a b")]), none).collect()] == [0]
    assert benchmark_hits(documents_of([]), none).count() == 0


def test_windows_in_parts_are_read_by_tasks(spark, documents_of):
    draw = random.Random(8)
    text = lambda n: " ".join(draw.choice(["a", "b", "c1", "d"]) for _ in range(n))
    items = [(i, text(draw.randint(1, 12))) for i in range(30)]
    rows = [(draw.choice([None, 1, i]), text(draw.randint(0, 30))) for i in range(50)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    stored = stored_windows(bench, 5, 600)
    assert stored.parts > 1
    made = [w for k in range(stored.parts) for w in zip(*(lambda x: (x.texts, x.sizes, map(sorted, x.items)))(stored.windows(k)))]
    want = {}
    for item, t in items:
        w = t.split()
        for i in range(max(1, len(w) - 4)):
            want.setdefault((f" {' '.join(w[i : i + 5])} ", len(w[i : i + 5])), set()).add(str(item))
    assert {(t, n): i for t, n, i in made} == {k: sorted(v) for k, v in want.items()} and len(made) == len(want)
    documents = documents_of(rows)
    clean = without_hits(documents, bench, 5, 600)
    assert clean.columns == documents.columns
    hit = {t: brute([(0, t)], items, 5)[0][1] for _, t in rows}
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == sorted(((d, t) for d, t in rows if not hit[t]), key=str)
    assert 0 < sum(1 for _, t in rows if hit[t]) < len(rows)


def test_repeated_and_very_long_documents(spark, documents_of):
    item = "one two three four five six"
    long = "word " * 300_000 + item
    bench = spark.createDataFrame([(1, item), (2, item)], "item_id long, text string")
    out = benchmark_hits(documents_of([(1, long), (4, item), (4, item)]), bench, width=5).collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in out) == [(1, 300_006, 6, ["1", "2"]), (4, 6, 6, ["1", "2"]), (4, 6, 6, ["1", "2"])]
