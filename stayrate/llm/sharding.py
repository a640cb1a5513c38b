"""Shards that all have the mixture of the whole: proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.ranks import cells_for, hash_cell, numbered
from stayrate.llm.scratch import written


def interleaved_shards(rows: DataFrame, shards: int = 8, seed: str = "0") -> DataFrame:
    """Deals rows (doc_id, source, text) to `shards` shards with equal mixtures of sources.

    Rows are shuffled within their source by a seeded hash of the id and ranked; the row with
    rank r of n gets the fraction (2 r + 1) / 2 n; rows are ordered by fraction, then source,
    then hash, and the order is cut into shards whose row counts differ by one at most. Of every
    source, each shard gets its share up to about one row.

    Returns doc_id, source, size (UTF-8 bytes of the text plus 1), text_crc32, shard and slot (the
    place in the shard, from 0). Other columns are not read, whatever their names.

    A null source is a source of its own. A null text has no bytes. Null ids hash like the empty
    string. Repeated rows are dealt one by one; which of two equal rows comes first is immaterial
    as they have the same values. An empty table gives no rows; shards stay empty if there are
    fewer rows than shards.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = written(
        rows.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("source"))).alias("stratum"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
            F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("shuffled"),
        ),
        "shard-rows",
    )
    n = plain.count()
    cells = cells_for(n)
    ranked = numbered(
        plain.withColumn("cell", hash_cell(F.col("shuffled"), cells)),
        "stratum", "cell", ["shuffled", "doc_id", "size", "text_crc32"], "rank", "of",
    )
    fraction = (F.lit(2) * F.col("rank") + 1) / (F.lit(2) * F.col("of"))
    mixed = ranked.drop("cell").withColumn("fraction", fraction.cast("double"))
    # Every source spreads its fractions evenly over 0 to 1, and so does their union.
    mixed = mixed.withColumn("cell", F.floor(F.col("fraction") * cells).cast("long")).withColumn("all", F.lit(0))
    placed = numbered(
        mixed.drop("rank", "of"),
        "all", "cell", ["fraction", "stratum", "shuffled", "doc_id", "size", "text_crc32"], "place", "of",
    )
    placed = placed.withColumn("shard", F.expr(f"place * {shards}L div {max(n, 1)}L").cast("int"))
    first = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    return placed.select(
        "doc_id", "source", "size", "text_crc32", "shard", (F.col("place") - first).cast("long").alias("slot")
    )
