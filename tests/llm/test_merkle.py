from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from stayrate.llm.merkle import lowered, manifest, proofs, verified


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row) -> str:
    fields = [None if v is None else str(v) for v in row]
    return h(*["-" if f is None else f"{len(f.encode())}:{f}" for f in fields])


def climb(nodes: list[str]) -> tuple[str, list[list[str]]]:
    """The last node, and for each first node the siblings level by level, as one string a level."""
    paths, spans = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, above_spans = [], []
        for i in range(0, len(nodes), 8):
            run = nodes[i : i + 8]
            for k in range(len(run)):
                for leaf in spans[i + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(h(*run))
            above_spans.append([x for s in spans[i : i + 8] for x in s])
        nodes, spans = above, above_spans
    return nodes[0], paths


def brute(rows, claimed):
    """Expected rows: (doc_id, leaf, subroot, root, proof, folded, verified)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[lang] = (own, *climb([leaf_of(r) for r in own]))
    root, upper = climb([trees[x][1] for x in langs])
    out = []
    for lang, above in zip(langs, upper):
        own, top, paths = trees[lang]
        for r, path in zip(own, paths):
            digest = leaf_of((*r[:4], claimed(r)))
            for left, right in path + above:
                digest = h(left, digest, right)
            out.append((r[0], leaf_of(r), top, root, h(*[a + b for a, b in path + above]), digest, digest == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("tree", "pos", "digest", "leaf", "path", "nodes", "children", "claimed", "other", "place"):
        df = df.withColumn(name, F.lit("extra"))
    return df


def some_rows(seed: int, n: int, langs: list):
    draw = random.Random(seed)
    texts = ["", None, "Ünï Code", "ABC def", "plain", "x" * 50_000 + "Y"]
    return [
        (i, draw.choice(["s", None, "web:1"]), draw.choice(langs), draw.choice([None, 0, 12]), draw.choice(texts))
        for i in draw.sample(range(10 * n), n)
    ]


def test_proofs_and_tampering_by_brute_force(spark):
    rows = some_rows(1, 700, ["en", "en", "en", "de", None, "zz"]) + [(99_999, "only", "alone", 1, "Alone")]
    tampered = lambda r: r[0] % 3 == 0
    claimed = lambda r: r[4] and "".join(c.lower() if c.isascii() else c for c in r[4]) if tampered(r) else r[4]
    out = verified(frame(spark, rows), F.when(F.col("doc_id") % 3 == 0, lowered(F.col("text"))).otherwise(F.col("text")))
    found = sorted(map(tuple, out.collect()), key=str)
    assert found == brute(rows, claimed)
    assert {r[-1] for r in found} == {True, False}


def test_many_languages_repeated_rows_and_null_ids(spark):
    rows = some_rows(2, 150, [f"l{i}" for i in range(70)])
    rows += [(None, "s", "l1", 3, "abc")] * 20 + [(None, "s", "l1", 3, "abd"), (5, "s", "l2", 3, "q")] + [(5, "s", "l2", 3, "r")] * 9
    found = sorted(map(tuple, verified(frame(spark, rows), F.col("text")).collect()), key=str)
    assert found == brute(rows, lambda r: r[4])
    assert all(r[-1] for r in found)


def test_one_row_and_none(spark):
    row = (7, "s", "en", 1, "A")
    (one,) = verified(frame(spark, [row]), lowered(F.col("text"))).collect()
    assert one["leaf"] == one["subroot"] == one["root"] == leaf_of(row)
    assert one["proof_sha256"] == h() and one["folded_root"] == leaf_of((7, "s", "en", 1, "a")) and not one["verified"]
    assert verified(frame(spark, []), F.col("text")).count() == 0


def test_some_leaves_only(spark):
    rows = some_rows(3, 300, ["en", "de"])
    graph = manifest(frame(spark, rows))
    wanted = [r[0] for r in rows[:5]]
    found = proofs(graph, graph.leaves.where(F.col("doc_id").isin(wanted))).collect()
    expected = {r[0]: r for r in brute(rows, lambda r: r[4])}
    assert sorted(r["doc_id"] for r in found) == sorted(wanted)
    for r in found:
        assert (r["leaf"], r["subroot"], r["root"]) == expected[r["doc_id"]][1:4]
        assert h(*[s["left"] + s["right"] for s in r["path"]]) == expected[r["doc_id"]][4]


def test_equal_subtrees_are_one_record(spark):
    graph = manifest(frame(spark, [(1, "s", "en", 1, "same")] * 64))
    assert graph.by_lang.store.count() == 2
    assert graph.by_lang.height == 2
