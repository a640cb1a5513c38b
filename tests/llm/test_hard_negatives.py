from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayrate.llm.hard_negatives import Bucket, Mining, hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int"
ANCHOR = lambda: F.col("vec_id") % 10 == 0


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "bucket", "score", "rank", "target", "vector", "length", "block", "anchor", "number"):
        df = df.withColumn(name, F.lit("extra"))
    return df


def product(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute(rows, how=Mining()):
    known = []
    for k, (vec_id, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not np.isfinite(x) or abs(x) > 2**16 for x in vector):
            continue
        known.append((k, vec_id, [int(np.floor(256 * float(np.float32(x)))) for x in vector], label))
    order = lambda a: lambda o: (-product(a[2], o[2]), o[1] is None, o[1] or 0)
    out = []
    for a in known:
        if a[1] is None or a[1] % 10:
            continue
        others = sorted((o for o in known if o[0] != a[0]), key=order(a))
        for p in [o for o in others if o[3] == a[3]][: how.positives]:
            s = product(a[2], p[2])
            near = [o for o in others if o[3] != a[3] and how.least * s <= 100 * product(a[2], o[2]) <= how.most * s]
            out += [(a[1], p[1], r + 1, o[1], s, product(a[2], o[2])) for r, o in enumerate(near[: how.negatives])]
    return sorted(out, key=str)


def clustered(seed: int, n: int, width: int, labels: int):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(labels, width))
    rows = []
    for i in range(n):
        at = int(draw.integers(labels))
        vector = (centres[at] + draw.normal(size=width)) * draw.choice([0.05, 0.1, 0.4])
        rows.append((i, [float(x) for x in vector], int(draw.integers(labels)) if i % 5 == 0 else at))
    return rows


@pytest.mark.parametrize("how", [Mining(bucket_rows=16, block_anchors=4), Mining(positives=2, negatives=9, least=50, most=95)])
def test_by_brute_force(spark, how):
    rows = clustered(1, 260, 12, 4)
    found = sorted(map(tuple, hard_negatives(frame(spark, rows), F.col("label"), ANCHOR(), how).collect()), key=str)
    assert found == brute(rows, how) and len(found) > 50


def test_odd_rows(spark):
    draw = random.Random(3)
    rows = clustered(4, 60, 6, 2)
    rows += [
        (70, None, 1), (80, [0.1] * 6, None), (90, [0.1, None, 0.2], 1), (100, [0.1, float("nan")], 0), (110, [float("inf")] * 6, 0),
        (120, [], 1), (130, [0.0] * 6, 0), (140, [70_000.0] * 6, 0), (None, [0.3] * 6, 1), (150, [0.2, 0.1], 1), (160, [-0.2] * 9, 0),
        (170, [60_000.0] * 6, 0), (171, [60_000.0] * 6, 1), (172, [50_000.0] * 6, 0),
    ]
    rows += [(200, [0.25] * 6, 0)] * 3 + [(210, [0.25] * 6, 1)] * 3 + [(draw.randrange(300, 400), [0.25] * 6, i % 2) for i in range(30)]
    how = Mining(bucket_rows=8, block_anchors=4)
    found = sorted(map(tuple, hard_negatives(frame(spark, rows), F.col("label"), ANCHOR(), how).collect()), key=str)
    assert found == brute(rows, how)


def test_empty_and_single_label(spark):
    assert hard_negatives(frame(spark, []), F.col("label"), ANCHOR()).count() == 0
    one_label = [(v, x, 0) for v, x, _ in clustered(5, 20, 4, 2)]
    assert hard_negatives(frame(spark, one_label), F.col("label"), ANCHOR()).count() == 0
    assert hard_negatives(frame(spark, [(0, [1.0], 0)]), F.col("label"), ANCHOR()).count() == 0


def test_feasible_ranges_lose_nothing_and_leave_out_much():
    draw = np.random.default_rng(7)
    vectors = draw.normal(size=(3000, 16))
    vectors = np.floor(256 * vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.int64)
    bucket, looked_at = Bucket(vectors), {0.5: 0, 0.8: 0, 0.95: 0}
    for anchor in vectors[:40]:
        scores = vectors @ anchor
        for share in looked_at:
            theta = share * 256 * 256
            found = bucket.candidates(anchor, theta, 4)
            assert set(np.flatnonzero(scores >= theta)) <= set(found.tolist())
            looked_at[share] += len(found)
    assert looked_at[0.5] < 40 * 3000 and looked_at[0.8] < 40 * 3000 * 0.5 and looked_at[0.95] < 40 * 3000 * 0.1
