from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from stayrate.llm.sharding import interleaved_shards


def by_hand(rows, shards, seed):
    """(doc_id, shard, slot) by plain sorting."""
    import hashlib

    groups = {}
    for d, s, t in rows:
        h = hashlib.md5(f"{seed}:{'' if d is None else d}".encode()).hexdigest()
        groups.setdefault("-" if s is None else f"+{s}", []).append((h, d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())))
    mixed = []
    for g, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1] is not None, m[1] or 0, *m[2:]))
        mixed += [((2 * r + 1) / (2 * len(members)), g, *m) for r, m in enumerate(members)]
    mixed.sort(key=lambda m: (*m[:3], m[3] is not None, m[3] or 0, *m[4:]))
    n = len(mixed)
    return Counter((m[3], i * shards // n, i - -(-(i * shards // n) * n // shards)) for i, m in enumerate(mixed))


def test_equals_plain_sorting_and_keeps_the_mixture(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 11}", f"text {i}" * (i % 5)) for i in range(2000)]
    rows += [(5000, None, None), (5001, None, ""), (None, "s1", "x"), (7, "s1", "again"), (7, "s1", "again")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("shard", F.lit("x")).withColumn("cell", F.lit(1))
    out = interleaved_shards(df, 8, "seed").collect()
    assert Counter((r["doc_id"], r["shard"], r["slot"]) for r in out) == by_hand(rows, 8, "seed")
    sizes = Counter(r["shard"] for r in out)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for source, total in Counter(r["source"] for r in out).items():
        for shard in range(8):
            here = sum(1 for r in out if r["source"] == source and r["shard"] == shard)
            assert abs(here - total / 8) <= 2
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(n))


def test_few_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], "doc_id long, source string, text string")
    assert sorted(r["slot"] for r in interleaved_shards(df, 8).collect()) == [0, 0]
    assert interleaved_shards(df.limit(0), 8).count() == 0
