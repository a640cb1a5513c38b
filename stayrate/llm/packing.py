"""Packing of documents into token sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.ranks import cells_for, hash_cell, numbered
from stayrate.llm.scratch import in_small_batches, written

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = f"{PIECES}, sequence_id long, offset long"


def added_tokens(vocabulary: str) -> dict[str, int]:
    """The strings of a tokenizer file that have an id of their own, whatever stands around them."""
    import public_tokenizers

    with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip")):
        raise ValueError(f"{vocabulary} has added tokens that depend on what stands around them")
    return {t["content"]: t["id"] for t in added}


@lru_cache(maxsize=4)
def encoder(vocabulary: str, added: bool = False):
    """Text to ids of a byte-level BPE vocabulary; its added tokens are found in the text, or else are ordinary text."""
    import public_tokenizers
    import tiktoken

    ranks = {}
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        for token, rank in map(bytes.split, lines):
            ranks[base64.b64decode(token)] = int(rank)
    coding = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added_tokens(vocabulary) if added else {})
    return partial(coding.encode, allowed_special="all") if added else coding.encode_ordinary


def _cut(vocabulary: str, most: int, end_id: int, with_ids: bool, added: bool):
    columns = [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * with_ids

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary, added)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.array([*encode(text or ""), end_id], dtype="<u4")
                for start in range(0, len(ids), most):
                    part = ids[start : start + most]
                    row = (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids))
                    rows.append((*row, part.astype("int32")) if with_ids else row)
            yield pd.DataFrame(rows, columns=columns)

    return over


def pieces(
    documents: DataFrame, most: int = 1024, vocabulary: str = "byte_bpe_50k", end_id: int = 0, with_ids: bool = False, added: bool = False
) -> DataFrame:
    """Documents (doc_id, text) as token ids, closed by `end_id` and cut every `most` ids.

    Returns doc_id, start (ids of the document before the piece), length, ids_crc32 (of the ids as
    little-endian 32-bit numbers), doc_tokens (with the closing id) and, if wanted, ids. With `added`, the
    vocabulary's added tokens get their ids, as `tokenizers` gives them; else they are ordinary text. A null or
    empty text is its closing id alone. Documents are cut one by one, repeated or not; other
    columns are not read.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    rows = in_small_batches(documents).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInPandas(_cut(vocabulary, most, end_id, with_ids, added), schema)


def packing_patterns(histogram: dict[int, int], most: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths that share a sequence) and how many sequences have each.

    Lengths are placed longest first. Each goes to the open packs with the smallest sum, as long as it
    fits there; what is left opens packs that hold as many of this length as fit. Packs of one pattern are counted, not listed, so the work
    depends on how many different lengths there are and not on how many pieces.
    """
    packs: list[tuple[int, int, int, tuple | None]] = []
    serial = 0

    def put(total: int, count: int, chain: tuple | None) -> None:
        nonlocal serial
        serial += 1
        heappush(packs, (total, serial, count, chain))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not packs or packs[0][0] + length > most:
                each = most // length
                for pieces_in, count in ((each, left // each), (left % each, 1)):
                    chain = None
                    for _ in range(pieces_in):
                        chain = (length, chain)
                    if chain and count:
                        put(pieces_in * length, count, chain)
                break
            total, _, count, chain = heappop(packs)
            taken = min(left, count)
            put(total + length, taken, (length, chain))
            if taken < count:
                put(total, count - taken, chain)
            left -= taken
    return [(_listed(chain), count) for _, _, count, chain in packs]


def _listed(chain: tuple | None) -> list[int]:
    out = []
    while chain is not None:
        length, chain = chain
        out.append(length)
    return out[::-1]


def slots_of(patterns: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, offset): where its pieces go by rank."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for lengths, count in patterns:
        offset = 0
        for length in lengths:
            out.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + count
            offset += length
        sequence += count
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


def _place(slots: dict[int, np.ndarray], columns: list[str]):
    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            lengths, ranks = batch["length"].to_numpy(), batch["rank"].to_numpy()
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                table = slots[int(length)]
                row = table[np.searchsorted(table[:, 0], ranks[at], side="right") - 1]
                sequence[at] = row[:, 1] + ranks[at] - row[:, 0]
                offset[at] = row[:, 2]
            yield batch.assign(sequence_id=sequence, offset=offset)[columns]

    return over


def packed(cut: DataFrame, most: int = 1024) -> DataFrame:
    """Pieces (see `pieces`) with the sequence each belongs to and its offset there.

    The histogram of lengths, `most` numbers at most, is all that the driver sees. Its packing
    patterns say where the pieces of a length go by rank, and the pieces are ranked within their
    length without a sort of all pieces of one length. Sequences have no gaps; ids count from 0.
    Which of several equally long pieces goes where depends on a hash of their place only. No
    pieces, no sequences. `cut` is read three times, so it should be a written table.
    """
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    slots = slots_of(packing_patterns(histogram, most))
    cells = cells_for(sum(histogram.values()))
    shuffled = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id"), F.lit(-1)), "start"))
    spread = cut.withColumn("shuffled", shuffled).withColumn("cell", hash_cell(F.col("shuffled"), cells))
    ranked = numbered(spread, "length", "cell", ["shuffled", "doc_id", "start", "ids_crc32"], "rank", "of")
    columns = [*cut.columns, "sequence_id", "offset"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return ranked.select(*cut.columns, "rank").mapInPandas(_place(slots, columns), schema)


def packed_documents(documents: DataFrame, most: int = 1024, vocabulary: str = "byte_bpe_50k", end_id: int = 0) -> DataFrame:
    """Documents (doc_id, text) cut into pieces, with the ids of added tokens, and packed; see `pieces` and `packed`."""
    return packed(written(pieces(documents, most, vocabulary, end_id, added=True), "pieces"), most)


def sequences(placed: DataFrame, most: int = 1024, pad_id: int = 0) -> DataFrame:
    """sequence_id, ids and n_ids of packed pieces that carry ids.

    Sequences are padded to `most` ids, but for those whose length is a power of two.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
    n = F.size("ids")
    whole = F.bit_count(n) == 1
    padding = F.array_repeat(F.lit(pad_id), F.when(whole, 0).otherwise(F.lit(most) - n))
    return joined.select("sequence_id", F.concat("ids", padding).alias("ids"), n.alias("n_ids"))
