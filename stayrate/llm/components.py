"""Connected components of a graph given as links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.scratch import written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex is linked with the smallest of the vertex and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("m").alias("a"), "b").where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are linked with the smallest of these."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    near = links.join(least, "b").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    own = least.select(F.col("m").alias("a"), "b")
    return near.unionByName(own).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(vertex, component) for every vertex of links (a, b) with a < b; the component is its smallest vertex.

    Large and small stars take turns until nothing changes, in about log2 of the number of
    vertices rounds, each a few joins of tables no larger than the links. What a round has is
    written to the shared folder. Hubs are no harm: their smallest neighbour is found with partial
    aggregation and joined back as one row.
    """
    now = written(links.select("a", "b").where("a < b").distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        now = written(_small_star(_large_star(now)), "links")
    roots = now.select("a").distinct().select(F.col("a").alias("vertex"), F.col("a").alias("component"))
    return now.select(F.col("b").alias("vertex"), F.col("a").alias("component")).unionByName(roots)
