from __future__ import annotations

import random

import corpus_pipeline
import pytest

from stayrate.llm import queries


def test_stages_keep_what_they_should(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, small_dir), name)
        assert docs.columns == corpus_pipeline.COLUMNS
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[-1] > kept[0] // 2
    assert kept[-1] == kept[-2]
    assert docs.where("n_chars <> length(text)").count() == 0
    packed = corpus_pipeline.pack(spark, docs, small_dir)
    assert packed.select("doc_id").distinct().count() == kept[-1]


def test_the_run_equals_its_stages_on_what_survives(spark, small_dir):
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, small_dir).select("doc_id").distinct().collect()}
    documents = queries.table(spark, small_dir, "documents")
    toxic = {r["doc_id"] for r in queries.op9_crf_toxicity(spark, small_dir).where("predicted = 1").collect()}
    dirty = {r["doc_id"] for r in queries.op7_benchmark_windows(spark, small_dir).where("contaminated").collect()}
    every = {r["doc_id"] for r in documents.select("doc_id").collect()}
    left = every - toxic - dirty
    assert not ids & (toxic | dirty)
    copies = corpus_pipeline.near_copies(documents.where(~documents["doc_id"].isin(list(toxic))))
    assert ids == left - {r["doc_id"] for r in copies.where("not kept").collect()}


def test_registered_with_contract_columns():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near-dedup", "decontamination", "secrets", "packing"]
    assert sorted(int(q[2:].split("_")[0]) for q in queries.QUERIES) == list(range(1, 14))


# op12 returns a row for each negative, not for each row of its table.
@pytest.mark.parametrize("name", sorted(q for q in queries.QUERIES if not q.startswith("op12_")))
def test_one_row_for_each_row_of_the_table(spark, small_dir, name):
    out = queries.QUERIES[name](spark, small_dir)
    n = out.count()
    if name.startswith("op1_"):
        assert n >= queries.table(spark, small_dir, "documents").count()
    elif name.startswith("op3_"):
        assert n == 1 + queries.table(spark, small_dir, "conversations").select("conv_id").distinct().count()
    else:
        assert n == queries.table(spark, small_dir, "pages" if name.startswith("op8_") else "documents").count()


def test_secrets_with_slashes_are_masked(spark):
    draw = random.Random(2)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    strings = ["".join(draw.choice(letters) for _ in range(256)) for _ in range(20)]
    strings = [x for x in strings if x.count("/") >= 3]
    strings.append("com/services/T01ABCD23/B04EFGH56/aZ3kQ9xW7mP2vL8sT4bN6cRy")
    paths = ["src/test/resources/test1/cases"]
    rows = [(i, f"see {x} here", "en", "s", 0) for i, x in enumerate(strings + paths)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    text = {r["doc_id"]: r["text"] for r in corpus_pipeline.mask_secrets(spark, docs, "").collect()}
    assert all("[secret]" in text[i] and x[-24:] not in text[i] for i, x in enumerate(strings))
    assert all(x in text[len(strings) + i] for i, x in enumerate(paths))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in pairs], SCHEMA)


def _left(df):
    assert df.columns == corpus_pipeline.COLUMNS
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def test_near_copies_of_null_and_repeated_ids_go(spark):
    draw = random.Random(3)
    words = lambda n: " ".join("".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    one, two, three = words(60), words(60), words(60)
    near = one + " tail"
    pairs = [(5, one), (None, near), (2, near), (7, two), (7, three), (7, two), (None, three), (None, words(60)), (8, None), (None, ""), (8, "")]
    out = _left(corpus_pipeline.drop_near_copies(spark, _rows(spark, pairs), ""))
    assert out == sorted([(2, near), (7, two), (7, three), pairs[7], (8, None), (None, ""), (8, "")], key=str)


def test_benchmark_passages_are_judged_row_by_row(spark, tmp_path):
    item = "what is the name of the tallest tower in the old town"
    spark.createDataFrame([(1, item), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    pairs = [(None, f"so: {item}!"), (3, item.upper()), (3, "clean"), (4, None), (None, "clean too"), (2**60 + 1, "x " * 100_000)]
    out = _left(corpus_pipeline.drop_contaminated(spark, _rows(spark, pairs), str(tmp_path)))
    assert out == sorted(pairs[2:], key=str)


def test_stages_take_an_empty_table(spark, small_dir):
    for _, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, _rows(spark, []), small_dir).count() == 0
