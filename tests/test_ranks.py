"""Rank primitives against native windows and plain Python, with hot values and copies."""

from __future__ import annotations

import hashlib
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stayrate.functions.ranks import counted, quantiles, rank_index, tie_key, value_positions, with_cell, with_ntile


def _charges(spark, n=3000):
    """A third of the rows share one value, and some values are unknown."""
    value = (
        F.when(F.col("id") % 3 == 0, F.lit(50))
        .when(F.col("id") % 101 == 0, None)
        .otherwise(F.pmod(F.xxhash64("id"), F.lit(900)) / 10)
    )
    return spark.range(n).select(F.concat(F.lit("C"), "id").alias("customer_id"), value.cast("decimal(8,2)").alias("v"))


@pytest.mark.parametrize("tiles", [1, 2, 4, 7, 10])
def test_ntile_equals_native(spark, tiles):
    rows = with_ntile(_charges(spark), tiles, "v", "customer_id", "tile")
    order = Window.orderBy(F.col("v").asc_nulls_last(), tie_key(F.col("customer_id")))
    assert rows.withColumn("expected", F.ntile(tiles).over(order)).where("tile != expected").count() == 0


def test_ntile_of_fewer_rows_than_tiles(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "customer_id string, v int")
    tiles = with_ntile(rows, 4, "v", "customer_id", "tile").collect()
    assert {r["customer_id"]: r["tile"] for r in tiles} == {"a": 1, "b": 2}


def test_ntile_of_nothing(spark):
    rows = spark.createDataFrame([], "customer_id string, v int")
    assert with_ntile(rows, 4, "v", "customer_id", "tile").count() == 0


def test_ntile_sizes_differ_by_one_at_most(spark):
    sizes = [r["count"] for r in with_ntile(_charges(spark, 1003), 4, "v", "customer_id", "t").groupBy("t").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_copies_of_one_row_stay_together(spark):
    copies = spark.range(90).select(F.lit("same").alias("customer_id"), F.lit(Decimal("5.00")).alias("v"))
    others = spark.range(10).select(F.concat(F.lit("o"), "id").alias("customer_id"), F.lit(Decimal("9.00")).alias("v"))
    tiles = with_ntile(copies.union(others), 4, "v", "customer_id", "tile").groupBy("customer_id").agg(F.countDistinct("tile").alias("n"))
    assert tiles.where("n > 1").count() == 0


def test_positions_count_rows_before(spark):
    values = [r["v"] for r in _charges(spark, 500).collect()]
    counts = Counter(values)
    order = sorted((v for v in counts if v is not None)) + [None]
    starts, seen = {}, 0
    for v in order:
        starts[v] = seen
        seen += counts[v]
    for row in value_positions(_charges(spark, 500), "v").collect():
        assert (row["start"], row["n"], row["total"]) == (starts[row["v"]], counts[row["v"]], 500)


@pytest.mark.parametrize("n", [1, 2, 10, 500])
def test_quantiles_equal_numpy(spark, n):
    points = {"a": 0.0, "b": 1 / 3, "c": 0.5, "d": 2 / 3, "e": 0.9, "f": 1.0}
    rows = _charges(spark, n)
    known = [float(r["v"]) for r in rows.collect() if r["v"] is not None]
    found = quantiles(rows, "v", points).first()
    assert [found[k] for k in points] == pytest.approx(list(np.quantile(known, list(points.values()))))


def test_quantiles_by_group(spark):
    rows = _charges(spark, 400).withColumn("g", F.length("customer_id"))
    for row in quantiles(rows, "v", {"m": 0.5}, by=["g"]).collect():
        known = [float(r["v"]) for r in rows.where(F.col("g") == row["g"]).collect() if r["v"] is not None]
        assert row["m"] == pytest.approx(np.median(known))


def test_tie_key_is_md5_then_text(spark):
    key = spark.range(1).select(tie_key(F.lit("C1"), "42").alias("k")).first()["k"]
    assert key == hashlib.md5(b"42|C1").hexdigest() + "C1"


def test_cells_follow_the_values_and_are_even(spark):
    """Distinct values in [0, 1), a third of the rows on one of them, and values of other sizes beside them."""
    values = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0.25)).when(F.col("id") % 7 == 0, F.col("id") * 1e6).otherwise(F.col("id") / 6e4).alias("v")
    )
    cells = with_cell(counted(values, "v"), "v")
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("cell").collect()
    assert len(sizes) > 900 and max(r["n"] for r in sizes) < 40 * 40_000 / 1024
    assert all(a["high"] < b["low"] for a, b in zip(sizes, sizes[1:]))
    assert len([r for r in sizes if r["high"] < 1]) > 700


def test_few_cells_many_groups_and_unknown_values(spark):
    rows = [(g, v) for g in "abc" for v in (None, 1e-12, 2e-12, 3.0, 3.0, float("inf"), -5.5, float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    for row in rank_index(counted(df, "v", ["g"]), "v", ["g"], cuts=3).collect():
        order = [-5.5, 1e-12, 2e-12, 3.0, 3.0, float("inf"), "nan", None]
        place = order.index("nan" if row["v"] != row["v"] else row["v"])
        assert (row["start"], row["total"]) == (place, 8)
    none = spark.createDataFrame([(None,)], "v double")
    assert [tuple(r) for r in value_positions(none, "v").collect()] == [(None, 1, 0, 1)]


def test_cells_are_the_same_however_rows_lie(spark):
    counts = counted(_charges(spark, 5000), "v")
    one, two = with_cell(counts, "v", cuts=31), with_cell(counts.repartition(7, "n").orderBy("n"), "v", cuts=31)
    assert one.exceptAll(two).count() == 0
