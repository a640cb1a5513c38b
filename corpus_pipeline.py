"""A corpus made ready for training: toxic documents out, near copies out, benchmark passages out,
secrets out, and what is left packed into sequences.

Each stage takes (spark, docs, sf_dir) and gives the rows that the next one gets, written to Parquet in
between; all but the last give the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm import queries, toxicity
from stayrate.llm.decontaminate import without_hits
from stayrate.llm.near_copies import near_copies
from stayrate.llm.packing import packed_documents
from stayrate.llm.scratch import written
from stayrate.llm.secret_scan import masked
from stayrate.llm.sieve import sifted

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
STAGE = Callable[[SparkSession, DataFrame, str], DataFrame]

#: SQL can't express the field of the first stage, nor the tokenizer of the last.
ORACLE_SQL = None


def _with_text(docs: DataFrame) -> DataFrame:
    """n_chars made to fit the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field does not predict to be toxic."""
    return toxicity.without_toxic(docs.select(*COLUMNS), queries.toxicity_model(spark, docs, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8): the row of the smallest id, nulls last.

    Rows are numbered in a written table and judged by that number, so null and repeated ids are like others: of rows
    that are near copies one stays, whatever their ids, and of rows of one id those with texts of their own stay.
    """
    rows = written(docs.select(*COLUMNS).withColumn("row_key", F.monotonically_increasing_id()), "rows")
    groups = near_copies(rows.select(F.col("row_key").alias("doc_id"), "text"), width=5, least=0.8)
    placed = groups.select(F.col("doc_id").alias("row_key"), "component_id").join(rows.select("row_key", F.col("doc_id").alias("id")), "row_key")
    placed = written(placed, "placed")
    first = F.min(F.struct(F.col("id").isNull(), "id", "row_key")).alias("first")
    firsts = placed.groupBy("component_id").agg(first).select("first.row_key")
    dropped = written(placed.join(firsts, "row_key", "left_anti").select("row_key"), "dropped")
    # Texts are moved of rows that may be dropped only; the others are kept where they lie.
    rows = sifted(rows, "row_key", dropped, "row_key")
    asked = rows.where("maybe").join(dropped, "row_key", "left_anti")
    return rows.where("not maybe").unionByName(asked.select(*rows.columns)).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of ten words of a benchmark item."""
    return without_hits(docs.select(*COLUMNS), queries.table(spark, sf_dir, "benchmark"), width=10)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced by a mark; the rule is that of op10."""
    return _with_text(masked(docs.select(*COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and where they stand in sequences of 1024 tokens."""
    return packed_documents(docs, most=1024)


STAGES: list[tuple[str, STAGE]] = [
    ("toxicity", drop_toxic),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over `documents`; what each stage keeps is written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
