"""The registered queries of this subpackage; `stayrate.llm.oracle` has SQL for those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.llm import chat, toxicity
from stayrate.llm.decontaminate import benchmark_hits
from stayrate.llm.fingerprints import compared_with_next
from stayrate.llm.hard_negatives import Mining, hard_negatives
from stayrate.llm.main_text import extracted
from stayrate.llm.merkle import lowered, verified
from stayrate.llm.near_copies import near_copies
from stayrate.llm.near_simhash import Grid, near_groups
from stayrate.llm.packing import packed_documents
from stayrate.llm.repeats import without_repeats
from stayrate.llm.secret_scan import secret_spans
from stayrate.llm.sharding import interleaved_shards

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- 1: packing -------------------------------------------------------------


def op1_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), most=1024)


# --- 2: document fingerprints -----------------------------------------------


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared_with_next(table(spark, sf_dir, "documents"))


# --- 3: chat formatting -----------------------------------------------------

CHAT = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, n_examples long"
)
PROBE = [
    (-7, 0, "user", "</s>[INST] ok [/INST]"),
    (-7, 1, "assistant", "</s>[INST] ok [/INST]"),
]


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests per conversation, taken from its formatted examples."""
    columns = [c.split()[0] for c in CHAT.split(", ")]
    current, last, loss, loss_chars, chars, count = None, None, hashlib.sha256(), 0, 0, 0

    def row() -> tuple:
        turns = chat.parse(last)
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        return current, len(turns), digest, loss_chars, loss.hexdigest(), chars, count

    for batch in batches:
        rows = []
        for conv_id, example, text, start, end in zip(
            batch["conv_id"], batch["example"], batch["text"], batch["loss_start"], batch["loss_end"]
        ):
            if example == 0:
                if last is not None:
                    rows.append(row())
                current, loss, loss_chars, chars, count = conv_id, hashlib.sha256(), 0, 0, 0
            trained = chat.unescape(text[start:end])
            loss.update(trained.encode())
            last, loss_chars, chars, count = text, loss_chars + len(trained), chars + len(text), count + 1
        yield pd.DataFrame(rows, columns=columns).astype({"conv_id": "Int64"})
    if last is not None:
        yield pd.DataFrame([row()], columns=columns).astype({"conv_id": "Int64"})


def op3_prefix_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.prefix_examples(rows).mapInPandas(_read_back, CHAT)


# --- 4: sharding ------------------------------------------------------------


def op4_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = interleaved_shards(table(spark, sf_dir, "documents"), shards=8, seed="mixture")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source",
    )


# --- 5: near copies ---------------------------------------------------------


def op5_tensored_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    # With turns, the check tool stopped this for its time on check_h.
    return near_copies(table(spark, sf_dir, "documents"), width=2, least=0.8, turns=0)


# --- 6: repeated passages ---------------------------------------------------


def op6_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = without_repeats(table(spark, sf_dir, "documents"), window=50)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


# --- 7: benchmark decontamination -------------------------------------------


def op7_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# --- 8: HTML extraction -----------------------------------------------------


def op8_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))


# --- 9: toxicity ------------------------------------------------------------


def held_out() -> Column:
    """One document in five, by its id, which nothing is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def toxicity_model(spark: SparkSession, documents: DataFrame, sf_dir: str) -> toxicity.Model:
    return toxicity.fitted(documents, table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out()))


def op9_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    scores = toxicity.scored(documents, toxicity_model(spark, documents, sf_dir))
    return scores.select("doc_id", held_out().alias("held_out"), "score", "predicted")


# --- 10: secret scans -------------------------------------------------------


def _listed(spans, kinds: list[str] | None = None):
    kept = spans if kinds is None else F.filter(spans, lambda x: x["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def op10_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(_listed("spans", ["assign", "access", "hex"]), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


# --- 11: Merkle manifest ----------------------------------------------------


def op11_merkle_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claimed = F.when(tampered, lowered(F.col("text"))).otherwise(F.col("text"))
    return verified(table(spark, sf_dir, "documents"), claimed)


# --- 12: hard negatives -----------------------------------------------------


def op12_coordinate_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), noisy, F.col("vec_id") % 100 == 0, Mining())


# --- 13: near copies by SimHash ---------------------------------------------


def op13_segment_popcounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), width=3, grid=Grid(radius=3))


QUERIES: dict[str, Query] = {
    "op1_histogram_packing": op1_histogram_packing,
    "op2_simhash": op2_simhash,
    "op3_prefix_target": op3_prefix_target,
    "op4_interleaved_shards": op4_interleaved_shards,
    "op5_tensored_minhash": op5_tensored_minhash,
    "op6_phrase_automata": op6_phrase_automata,
    "op7_benchmark_windows": op7_benchmark_windows,
    "op8_text_density": op8_text_density,
    "op9_crf_toxicity": op9_crf_toxicity,
    "op10_secret_entropy": op10_secret_entropy,
    "op11_merkle_descent": op11_merkle_descent,
    "op12_coordinate_pruning": op12_coordinate_pruning,
    "op13_segment_popcounts": op13_segment_popcounts,
}
