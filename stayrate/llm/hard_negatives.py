"""Hard negatives by exact search with coordinate pruning over buckets of vectors of like length."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.llm.scratch import written

#: Larger components could give scores beyond 64 bits.
LARGEST = 1 << 24
#: Added to both ends of a feasible range, against rounding of single floats.
SLACK = 1e-5

FOUND = "anchor long, target int, vec_id long, score long"


@dataclass(frozen=True)
class Mining:
    """How many positives of an anchor and negatives of a positive, and the window of a negative's score in percent of the positive's.

    focus: coordinates of an anchor that are looked at before vectors are multiplied; bucket_rows and block_anchors bound
    what one task compares.
    """

    positives: int = 5
    negatives: int = 5
    least: int = 80
    most: int = 100
    focus: int = 4
    bucket_rows: int = 8192
    block_anchors: int = 1024


class Bucket:
    """Vectors of like length with sorted lists of their coordinates, each divided by the length.

    Two vectors whose product reaches theta have an angle of at most alpha = acos(theta / (their lengths)). With
    beta the anchor's angle to an axis, the other's coordinate on that axis lies within
    cos(beta + alpha) and cos(beta - alpha): a stretch of the coordinate's sorted list. The candidates are
    what the stretches of the anchor's largest coordinates have in common.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.longest = float(lengths.max(initial=0.0))
        self.unit = (vectors / np.where(lengths > 0, lengths, 1)[:, None]).astype(np.float32)
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        #: Whether products are exact in double floats.
        self.small = float(np.abs(vectors).max(initial=0)) ** 2 * vectors.shape[1] < 2**52

    def _list(self, axis: int) -> tuple[np.ndarray, np.ndarray]:
        if axis not in self._lists:
            order = np.argsort(self.unit[:, axis], kind="stable").astype(np.int32)
            self._lists[axis] = order, self.unit[order, axis]
        return self._lists[axis]

    def candidates(self, anchor: np.ndarray, theta: float, focus: int) -> np.ndarray:
        """Ascending rows that may have a product of theta or more with the anchor."""
        every = np.arange(len(self.vectors))
        length = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
        if theta <= 0:
            return every
        if length * self.longest * (1 + 1e-9) < theta:
            return every[:0]
        alpha = np.arccos(min(1.0, theta / (length * self.longest)))
        unit = anchor / length
        stretches = []
        for axis in np.argsort(-np.abs(unit), kind="stable")[:focus].tolist():
            beta = np.arccos(np.clip(unit[axis], -1, 1))
            low, high = np.cos(min(np.pi, beta + alpha)) - SLACK, np.cos(max(0.0, beta - alpha)) + SLACK
            values = self._list(axis)[1]
            lo, hi = np.searchsorted(values, low), np.searchsorted(values, high, side="right")
            stretches.append((int(hi - lo), axis, low, high, lo, hi))
        if not stretches:
            return every
        stretches.sort()
        _, axis, _, _, lo, hi = stretches[0]
        rows = np.sort(self._list(axis)[0][lo:hi])
        for _, axis, low, high, _, _ in stretches[1:]:
            values = self.unit[rows, axis]
            rows = rows[(values >= low) & (values <= high)]
        return rows

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact products of some rows with the anchor."""
        if self.small and float(np.abs(anchor).max(initial=0)) ** 2 * len(anchor) < 2**52:
            return (self.vectors[rows].astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ anchor


def whole_numbers(embedding: Column) -> Column:
    """floor(256 * x) of every component, null if the vector can't take part."""
    scaled = F.transform(embedding, lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    known = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) <= LARGEST / 256))
    return F.when(known, F.transform(scaled, lambda x: x.cast("int")))


def bucketed(embeddings: DataFrame, label: Column, bucket_rows: int) -> DataFrame:
    """row, vec_id, label, vector, length and bucket of every row of embeddings that takes part.

    Buckets hold up to bucket_rows rows that follow each other by (label, length, vec_id), of one label each. They are
    cut from ranges of that order, so a label of any size is many buckets.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("int").alias("label"),
        whole_numbers(F.col("embedding")).alias("vector"),
    ).where("label is not null and vector is not null")
    rows = rows.withColumn("length", F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))
    parts = int(embeddings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("label"), F.col("length").desc(), F.xxhash64("vec_id", "vector")]
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
    # A range begins anew with each partition, and a bucket with each label and each bucket_rows rows of a range.
    return written(placed, "vectors").withColumn("bucket", F.concat_ws(":", "label", F.floor(F.col("row") / bucket_rows)))


def _summary(rows: DataFrame) -> DataFrame:
    """number (from 0), label, longest and rows of each bucket; a bucket_rows-th of the rows, so one task orders them."""
    return written(
        rows.groupBy("label", "bucket")
        .agg(F.max("length").alias("longest"), F.count(F.lit(1)).alias("rows"))
        .select((F.row_number().over(Window.orderBy("bucket")) - 1).alias("number"), "bucket", "label", "longest", "rows"),
        "buckets",
    )


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows of whole numbers, missing components 0."""
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, one in enumerate(vectors):
        out[i, : len(one)] = one
    return out


def _compared(keep: int, focus: int, other_row: bool):
    """For each anchor and each of its targets (low, high): the first rows of a bucket whose score lies within."""

    def over(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(rows):
            # By ascending id, null last, so that among equal scores the first found is the first asked for.
            rows = rows.sort_values("vec_id", na_position="last", kind="stable")
            width = max(max(map(len, anchors["vector"])), max(map(len, rows["vector"])))
            bucket, vectors = Bucket(_matrix(rows["vector"], width)), _matrix(anchors["vector"], width)
            ids, own = rows["vec_id"].array, rows["row"].to_numpy()
            for k, (anchor, targets) in enumerate(zip(anchors["row"], anchors["targets"])):
                lows = [float("-inf") if t["low"] is None else t["low"] for t in targets]
                found = bucket.candidates(vectors[k], min(lows), focus)
                if other_row:
                    found = found[own[found] != anchor]
                scores = bucket.scores(found, vectors[k])
                for t, low in zip(targets, lows):
                    fit = scores >= low
                    if t["high"] is not None:
                        fit &= scores <= t["high"]
                    places, values = found[fit], scores[fit]
                    for i in np.argsort(-values, kind="stable")[:keep].tolist():
                        one = ids[int(places[i])]
                        out.append((anchor, t["target"], None if pd.isna(one) else int(one), int(values[i])))
        names = [c.split()[0] for c in FOUND.split(", ")]
        return pd.DataFrame(out, columns=names).astype({"vec_id": "Int64"})

    return over


TARGET = "array<struct<target:int,low:long,high:long>>"


def _searched(visits: DataFrame, rows: DataFrame, keep: int, focus: int, other_row: bool) -> DataFrame:
    """anchor, target, vec_id, score: for each visit of an anchor to a bucket the first `keep` rows of each target.

    visits: row, vector, targets, block, bucket. A task compares one block of anchors with one bucket; buckets go only
    to the blocks that visit them.
    """
    met = visits.select(F.col("block").alias("visitors"), F.col("bucket").alias("visited")).distinct()
    sides = met.join(rows.select(F.col("bucket").alias("visited"), "row", "vec_id", "vector"), "visited")
    left = visits.select("block", "bucket", "row", "vector", "targets").groupBy("block", "bucket")
    return left.cogroup(sides.groupBy("visitors", "visited")).applyInPandas(_compared(keep, focus, other_row), FOUND)


def _first(found: DataFrame, keep: int) -> DataFrame:
    """Of all that was found for an anchor's target the first `keep`, with their rank from 1."""
    place = Window.partitionBy("anchor", "target").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= keep)


def _targets(low: Column, high: Column) -> Column:
    return F.array(F.struct(F.lit(0).alias("target"), low.cast("long").alias("low"), high.cast("long").alias("high"))).cast(TARGET)


def positives_of(anchors: DataFrame, rows: DataFrame, buckets: DataFrame, how: Mining) -> DataFrame:
    """anchor, rank, vec_id, score: the first other rows of an anchor's label, all of them compared or ruled out.

    The fullest bucket of the label gives every anchor a first lot; the least of their scores is the bound for
    all other buckets of that label, of which only those with long enough vectors are visited.
    """
    seed = Window.partitionBy("label").orderBy(F.desc("rows"), F.desc("longest"), "number")
    ranked = buckets.withColumn("seed", F.row_number().over(seed) == 1).select("label", "bucket", "longest", "seed")
    places = anchors.join(ranked, "label")
    none = F.lit(None)
    first = places.where("seed").withColumn("targets", _targets(none, none))
    begun = written(_searched(first, rows, how.positives, how.focus, True), "seeds")
    bounds = begun.groupBy("anchor").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n"))
    bounds = bounds.where(F.col("n") >= how.positives).select(F.col("anchor").alias("row"), "bound")
    rest = (
        places.where("not seed")
        .join(bounds, "row", "left")
        .where(F.col("bound").isNull() | (F.col("length") * F.col("longest") * (1 + 1e-9) >= F.col("bound")))
        .withColumn("targets", _targets(F.col("bound"), none))
    )
    found = begun.unionByName(_searched(rest, rows, how.positives, how.focus, True))
    return written(_first(found, how.positives), "positives")


def hard_negatives(embeddings: DataFrame, label: Column, is_anchor: Column, how: Mining = Mining()) -> DataFrame:
    """For each anchor and each of its positives the rows of other labels that score nearly as high.

    embeddings: vec_id, embedding, label; `label` and `is_anchor` are taken of these columns. Returns anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score, as `Mining` says; an anchor without positives, or a
    positive without such rows, has no row.

    Scores are products of whole vectors, floor(256 * x). Blocks of anchors visit the buckets of all rows whose
    lengths could reach the least score asked for; there, the feasible ranges of the anchor's largest coordinates
    leave candidates, which are multiplied out. What is left out can't reach the score, so nothing is lost.

    Rows with a null label, vector or component, or one that is not finite or beyond 2 ** 16, take no part. Components missing in the
    shorter of two vectors count as 0; a vector without components scores 0 with all. Null ids are never anchors unless
    `is_anchor` says so, and come last among equal scores. Rows that repeat an id or a whole row are rows
    of their own. Labels or vectors of any number of rows are cut into buckets. An empty table gives no rows. Other columns are not read.
    """
    rows = bucketed(embeddings, label, how.bucket_rows)
    buckets = _summary(rows)
    chosen = rows.where(F.coalesce(is_anchor, F.lit(False)))
    blocks = max(1, -(-chosen.count() // how.block_anchors))
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block")
    anchors = written(chosen.select("row", "vec_id", "label", "vector", "length", block), "anchors")
    positives = positives_of(anchors, rows, buckets, how)

    target = F.struct(
        F.col("rank").alias("target"),
        F.expr(f"(cast(score as decimal(20, 0)) * {how.least} + 99) div 100").alias("low"),
        F.expr(f"(cast(score as decimal(20, 0)) * {how.most}) div 100").alias("high"),
    )
    # Below zero no score lies between four fifths of a score and the score.
    asked = positives.where("score >= 0").groupBy(F.col("anchor").alias("row")).agg(F.collect_list(target).cast(TARGET).alias("targets"))
    least = F.array_min(F.transform("targets", lambda t: t["low"]))
    visits = (
        anchors.join(asked, "row")
        .withColumn("number", F.explode(F.sequence(F.lit(0), F.lit(max(0, buckets.count() - 1)))))
        .join(buckets.select("number", "bucket", "longest", F.col("label").alias("other")), "number")
        .where((F.col("label") != F.col("other")) & (F.col("length") * F.col("longest") * (1 + 1e-9) >= least))
    )
    found = _first(_searched(visits, rows, how.negatives, how.focus, False), how.negatives)
    named = positives.select(
        "anchor", F.col("rank").alias("target"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return (
        found.join(named, ["anchor", "target"])
        .join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
    )
