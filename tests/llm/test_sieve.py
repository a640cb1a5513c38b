from __future__ import annotations

import random

import corpus_pipeline
from llm.conftest import rows_by_id

from stayrate.llm import near_copies as module
from stayrate.llm.sieve import sifted


def unrelated(n, seed=5):
    draw = random.Random(seed)
    return [" ".join(f"x{draw.randrange(10**6)}" for _ in range(30)) for _ in range(n)]


def test_no_wanted_row_is_missed_and_few_others_are_taken_for_wanted(spark):
    rows = [(k, f"t{k}") for k in range(-5000, 5000)] + [(97, "again"), (None, "null")]
    wanted = {*range(-4999, 5000, 97), 97, 2**40}
    given = spark.createDataFrame(rows, "id long, text string")
    out = sifted(given, "id", spark.createDataFrame([(k,) for k in wanted], "vertex long"), "vertex")
    assert out.columns == ["id", "text", "maybe"]
    found = out.collect()
    assert sorted((r["id"], r["text"]) for r in found if r["id"] is not None) == sorted(rows[:-1])
    assert len(found) == len(rows) and all(r["maybe"] for r in found if r["id"] in wanted)
    assert sum(r["maybe"] for r in found if r["id"] not in wanted) < 20


def test_nothing_wanted(spark):
    out = sifted(spark.range(100), "id", spark.range(0), "id")
    assert out.count() == 100 and out.where("maybe").count() == 0


def test_only_texts_that_met_others_are_moved(documents_of, monkeypatch):
    base = unrelated(1)[0].split()
    rows = list(enumerate([*unrelated(300, 6), " ".join(base), " ".join([*base[:-1], "other"])]))
    moved = []
    compact = module.compact
    monkeypatch.setattr(module, "compact", lambda given: moved.append(given.count()) or compact(given))
    out = rows_by_id(module.near_copies(documents_of(rows), width=2))
    assert [d for d, r in out.items() if not r["kept"]] == [301] and out[301]["component_id"] == 300
    assert len(moved) == 1 and 2 <= moved[0] < 30


def test_texts_that_surely_stay_are_not_moved(spark, monkeypatch):
    texts = [*unrelated(200), *unrelated(1)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    moved = []

    def counted(*given):
        out = sifted(*given)
        moved.append(out.where("maybe").count())
        return out

    monkeypatch.setattr(corpus_pipeline, "sifted", counted)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(200))
    assert len(moved) == 1 and 1 <= moved[0] < 10


def test_a_text_goes_to_a_block_once(spark, monkeypatch):
    """Three members of one group, ten guests: thirteen texts, though the guests are hosts as well."""

    def rows_of(*_):
        def over(batches):
            n = 0
            for batch in batches:
                yield batch.assign(a=batch["vertex"], b=range(n, n + len(batch)))[["a", "b"]]
                n += len(batch)

        return over

    monkeypatch.setattr(module, "_compare", rows_of)
    met = spark.createDataFrame([(0, k, True, False) for k in range(3, 13)], "a long, b long, a_hub boolean, b_hub boolean")
    parts = spark.createDataFrame([(k, 0 if k < 3 else k) for k in range(13)], "vertex long, part long")
    texts = parts.selectExpr("vertex", "cast('x' as binary) data", "array(cast(1 as tinyint)) sketch")
    found = module.between_neighbours(met, texts, parts, 2, 0.8, 3)
    assert sorted(r["a"] for r in found.collect()) == list(range(13))


def test_each_guest_meets_each_host_in_some_block(spark, monkeypatch):
    monkeypatch.setattr(module, "HOSTS", 4)
    monkeypatch.setattr(module, "GUESTS", 3)
    parts = spark.createDataFrame([(k, 0 if k < 5 else k) for k in range(20)], "vertex long, part long")
    visits = spark.createDataFrame([(0, k) for k in range(5, 20)] + [(7, 8)], "host long, vertex long")
    rows = module.block_rows(visits, parts).collect()
    assert len({(r["block"], r["vertex"]) for r in rows}) == len(rows)
    pairs = {(x["vertex"], y["vertex"]) for x in rows for y in rows if x["block"] == y["block"] and x["is_guest"] and y["is_host"]}
    assert {(g, h) for g in range(5, 20) for h in range(20)} <= pairs
