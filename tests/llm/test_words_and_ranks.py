from __future__ import annotations

import re

import numpy as np
from pyspark.sql import functions as F

from stayrate.llm.components import connected_components
from stayrate.llm.ranks import cells_for, hash_cell, numbered
from stayrate.llm.words import Words, blocks, grams

TEXTS = ["", "one", "  two  words\n", "a\tb\x0bc\x0cd\re", "naïve Ünïcödé x", "same same same", "\x1c not\x1ca space"]


def test_words_are_those_of_the_pattern():
    words = Words([t.encode() for t in TEXTS])
    for k, text in enumerate(TEXTS):
        span = range(words.first[k], words.first[k + 1])
        found = [words.data[words.starts[i] : words.ends[i]].decode() for i in span]
        assert found == re.findall(r"[^\x20\x09-\x0D]+", text)


def test_equal_words_have_equal_hashes_in_any_block():
    words = Words([t.encode() for t in TEXTS])
    by_word = {}
    for i, h in enumerate(words.hashes.tolist()):
        by_word.setdefault(words.data[words.starts[i] : words.ends[i]], set()).add(h)
    assert all(len(x) == 1 for x in by_word.values())
    assert len({next(iter(x)) for x in by_word.values()}) == len(by_word)
    assert Words([b"same"]).hashes[0] in by_word[b"same"]


def test_grams_depend_on_order():
    ab, ba = (grams(Words([t]).hashes, 2)[0] for t in (b"a b", b"b a"))
    assert ab != ba
    assert len(grams(Words([b"a"]).hashes, 2)) == 0


def test_blocks_cover_every_item_once():
    sizes = [5, 0, 7, 100, 1, 1]
    spans = list(blocks(sizes, 10))
    assert [i for a, b in spans for i in range(a, b)] == list(range(len(sizes)))
    assert list(blocks([], 10)) == []


def test_numbered_is_row_number_with_a_hot_group(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
        F.md5(F.col("id").cast("string")).alias("h"),
    )
    cells = cells_for(3000)
    out = numbered(rows.withColumn("cell", hash_cell(F.col("h"), cells)), "g", "cell", ["h"], "rank", "of").toPandas()
    for _, group in out.groupby("g"):
        group = group.sort_values("h")
        assert group["rank"].tolist() == list(range(len(group)))
        assert set(group["of"]) == {len(group)}


def test_components_of_paths_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(500, 501), (500, 501)]
    out = {r["vertex"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {out[k] for k in range(100, 161)} == {100}
    assert {out[k] for k in range(1, 40)} == {1}
    assert out[501] == 500
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert np.all([c <= v for v, c in out.items()])
