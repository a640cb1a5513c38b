"""A Merkle manifest of a dataset as a content-addressed graph, and proofs by descent from its root.

H is the lower-case hexadecimal SHA-256 of its inputs written one after the other, digests as hexadecimal
text. The store of the graph holds one record for each digest that has children; equal subtrees
are one record.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.llm.scratch import written

#: Children of a node: three bits of a position are one digit.
DIGIT_BITS = 3
ARITY = 1 << DIGIT_BITS
#: The low bits of monotonically_increasing_id count rows within a partition.
ROW_BITS = 33

PATH = "array<struct<left:string,right:string>>"


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and itself; null as `-`."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(*values: Column) -> Column:
    """H of the fields of a row."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def lowered(text: Column) -> Column:
    """The text with A-Z lower-cased and nothing else changed."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def positioned(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds `pos`, from 0 within each tree by `order`, and `nodes`, the rows of the tree.

    Rows are sorted by ranges of (tree, *order), so a tree of any size is spread over all tasks;
    counts per tree and range say where a range begins. `order` tells the rows of a tree apart.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = written(
        rows.repartitionByRange(parts, "tree", *order)
        .sortWithinPartitions("tree", *order)
        .withColumn("place", F.monotonically_increasing_id()),
        "merkle-places",
    ).withColumn("part", F.shiftright("place", ROW_BITS))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("tree", "part")
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
        .select(
            "tree", "part",
            (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("shift"),
            F.sum("rows").over(Window.partitionBy("tree")).alias("nodes"),
        )
    )
    return (
        placed.join(starts, ["tree", "part"])
        .withColumn("pos", F.col("place") + F.col("shift"))
        .drop("place", "part", "shift")
    )


def _parent(pos: str = "pos") -> Column:
    return F.shiftright(pos, DIGIT_BITS)


def _digit(pos: Column) -> Column:
    """Which child of its parent a position is, from 0."""
    return pos.bitwiseAND(F.lit(ARITY - 1)).cast("int")


@dataclass(frozen=True)
class Forest:
    """Trees over numbered nodes.

    store: digest, children (digests in order), a record for each inner node; tops: tree, digest, height,
    one row for each tree. A tree of a single node has no record, and that node is its top. height is
    that of the highest tree.
    """

    store: DataFrame
    tops: DataFrame
    height: int


def grown(nodes: DataFrame) -> Forest:
    """Joins every ARITY consecutive nodes of a tree (the last ones: fewer) until one remains.

    nodes: tree, pos (gapless from 0), digest, nodes (the tree's number of nodes). A round has an
    eighth of the rows of the round before, and no group has more than ARITY rows.
    """
    level = nodes.select("tree", "pos", "digest", "nodes")
    most = level.agg(F.max("nodes")).first()[0] or 0
    single = lambda at, height: at.where("nodes = 1").select("tree", "digest", F.lit(height).alias("height"))
    tops, height = single(level, 0), 0
    records = level.select("digest", F.array("digest").alias("children")).limit(0)
    while most > 1:
        height, most = height + 1, -(-most // ARITY)
        joined = (
            level.where("nodes > 1")
            .groupBy("tree", _parent().alias("pos"))
            .agg(
                F.transform(F.sort_array(F.collect_list(F.struct("pos", "digest"))), lambda c: c["digest"]).alias("children"),
                F.ceil(F.max("nodes") / ARITY).alias("nodes"),
            )
            .withColumn("digest", F.sha2(F.array_join("children", ""), 256))
        )
        level = written(joined, "merkle-level")
        records = records.unionByName(level.select("digest", "children"))
        tops = tops.unionByName(single(level, height))
    # Repeated rows can make equal subtrees: one record has to answer for them.
    store = written(records.groupBy("digest").agg(F.first("children").alias("children")), "merkle-store")
    return Forest(store, written(tops, "merkle-tops"), height)


def descended(forest: Forest, cursors: DataFrame, requests: DataFrame, carried: list[str], asked: list[str]) -> DataFrame:
    """Walks from the tops of trees down to the nodes that are asked for.

    cursors: tree, digest (of the top), height, path (the segments from the root to there) and the columns `carried`;
    requests: tree, pos and the columns `asked`. One row for each request: carried, asked, digest (found at that
    position) and path.

    At a node of level k the digit pos / ARITY ** (k - 1) of the rank says which child is next. The other
    children are the next segment of the path, those to its left and those to its right. Requests that
    pass the same node share one cursor, so no node is a hot key, and those of one run share one path until the end.
    """
    runs = written(
        requests.groupBy("tree", _parent().alias("pos")).agg(F.collect_list(F.struct("pos", *asked)).alias("wanted")), "merkle-runs"
    )
    wanted, below = {1: runs}, runs.select("tree", "pos")
    for k in range(2, forest.height + 1):
        wanted[k] = below.groupBy("tree", _parent().alias("pos")).agg(F.collect_set("pos").alias("wanted"))
        below = wanted[k].select("tree", "pos")

    tops = cursors.select("tree", F.lit(0).cast("long").alias("pos"), "digest", "path", "height", *carried)
    segment = F.struct(
        F.array_join(F.slice("children", 1, F.col("digit")), "").alias("left"),
        F.array_join(F.slice("children", F.col("digit") + 2, ARITY), "").alias("right"),
    )

    def down(at: DataFrame, child: Column) -> DataFrame:
        """at, with digest and path of the child in its column `next`."""
        return (
            at.withColumn("digit", _digit(child))
            .withColumn("path", F.concat("path", F.array(segment)))
            .withColumn("digest", F.element_at("children", F.col("digit") + 1))
        )

    now = tops.where(F.col("height") == forest.height)
    for k in range(forest.height, 1, -1):
        met = now.join(forest.store, "digest").join(wanted[k], ["tree", "pos"]).withColumn("next", F.explode("wanted"))
        walked = down(met, F.col("next")).withColumn("pos", F.col("next")).select(*tops.columns)
        now = walked.unionByName(tops.where(F.col("height") == k - 1))
    out = [*carried, *[f"next.{c}" for c in asked], "digest", "path"]
    # A tree of one node is entered at its only leaf.
    alone = tops.where("height = 0").join(runs, ["tree", "pos"]).withColumn("next", F.explode("wanted")).select(*out)
    if not forest.height:
        return alone
    met = now.join(forest.store, "digest").join(runs, ["tree", "pos"]).withColumn("next", F.explode("wanted"))
    return down(met, F.col("next.pos")).select(*out).unionByName(alone)


@dataclass(frozen=True)
class Manifest:
    """leaves: tree, pos, doc_id, leaf, claimed; by_lang: a tree for each language; whole: one tree over their tops.

    tree_pos: tree, pos, the place of a language's tree among the leaves of `whole`.
    """

    leaves: DataFrame
    by_lang: Forest
    whole: Forest
    tree_pos: DataFrame


def leaves(documents: DataFrame, claimed_text: Column | None = None) -> DataFrame:
    """tree, doc_id, leaf and claimed of every row of documents (doc_id, source, lang, n_chars, text).

    claimed is the digest of the row with `claimed_text` for its text (null where that adds nothing to leaf).
    The tree is named by the language so that names are never null and sort as languages do, null first.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *[F.col(c).cast("string").alias(c) for c in ("source", "lang", "n_chars", "text")],
        (F.col("text") if claimed_text is None else claimed_text).cast("string").alias("other"),
    )
    digest = lambda text: digest_of(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", text)])
    return rows.select(
        F.coalesce(F.concat(F.lit("+"), "lang"), F.lit("")).alias("tree"),
        "doc_id",
        digest("text").alias("leaf"),
        F.when(~F.col("text").eqNullSafe(F.col("other")), digest("other")).alias("claimed"),
    )


def manifest(documents: DataFrame, claimed_text: Column | None = None) -> Manifest:
    """The Merkle graph of documents: a tree for each language by ascending doc_id, and one over their tops.

    Rows of one doc_id (null ids first) follow their digests; rows that are alike in all five columns are
    numbered, so that they are told apart and no range of the sort grows with them.
    """
    alike = leaves(documents, claimed_text).groupBy("leaf").agg(
        *[F.first(c).alias(c) for c in ("tree", "doc_id", "claimed")], F.count(F.lit(1)).alias("times")
    )
    copies = alike.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")
    numbered = positioned(copies, ["doc_id", "leaf", "copy"])
    by_lang = grown(numbered.withColumn("digest", F.col("leaf")))
    tops = by_lang.tops.select(F.lit("").alias("tree"), F.col("tree").alias("lang_tree"), "digest")
    places = positioned(tops, ["lang_tree"])
    return Manifest(numbered.drop("copy", "nodes"), by_lang, grown(places), places.select(F.col("lang_tree").alias("tree"), "pos"))


def proofs(of: Manifest, requests: DataFrame) -> DataFrame:
    """The way from the root to the leaves that are asked for.

    requests: tree, pos, doc_id, claimed (rows of `of.leaves`, all or some). Returns doc_id, claimed, leaf, subroot,
    root and path: the siblings' digests, left and right, from the leaf up to the root.
    """
    start = of.whole.tops.withColumn("path", F.array().cast(PATH)).withColumn("root", F.col("digest"))
    trees = of.tree_pos.join(of.by_lang.tops.select("tree", "height"), "tree")
    asked = trees.join(requests.select("tree").distinct(), "tree", "left_semi").select(
        F.lit("").alias("tree"), "pos", F.col("tree").alias("lang_tree"), F.col("height").alias("lang_height")
    )
    at_tops = descended(of.whole, start, asked, ["root"], ["lang_tree", "lang_height"])
    cursors = written(
        at_tops.select(
            F.col("lang_tree").alias("tree"), F.col("lang_height").alias("height"), "digest", "path", "root",
            F.col("digest").alias("subroot"),
        ),
        "merkle-tops",
    )
    found = descended(of.by_lang, cursors, requests, ["root", "subroot"], ["doc_id", "claimed"])
    return found.select("doc_id", "claimed", F.col("digest").alias("leaf"), "subroot", "root", F.reverse("path").alias("path"))


def siblings_digest(path: Column) -> Column:
    """H of all siblings on a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path come to."""
    return F.aggregate(path, leaf, lambda digest, s: F.sha2(F.concat(s["left"], digest, s["right"]), 256))


def verified(documents: DataFrame, claimed_text: Column) -> DataFrame:
    """Every row of documents with its place in the manifest, and whether its claimed text still leads to the root.

    Returns doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; a row for each row of documents.
    Nulls are digested as `-`, also null ids, which come first; an empty text differs from a null one.
    Rows alike in all columns have each its leaf. A text of any length is digested whole. An empty table gives no rows.
    Other columns are not read.
    """
    graph = manifest(documents, claimed_text)
    found = proofs(graph, graph.leaves)
    return found.select(
        "doc_id", "leaf", "subroot", "root",
        siblings_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("claimed", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
