"""SimHash fingerprints of texts, and all pairs of them within a Hamming radius."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.llm.scratch import in_small_batches
from stayrate.llm.words import Words, blocks, grams, mix

LANES = 2
BITS = 64 * LANES

#: Where the signed votes of a byte of a term's hash begin: bit by bit, as -1 or 1.
_SIGNS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int8) * 2 - 1


def fingerprints(texts: list[bytes | None], gram: int = 2) -> list[str]:
    """SimHash of each text, as hexadecimal.

    A text's terms are its distinct runs of `gram` words (a text with fewer words is one term); a
    term weighs the square root of its number of occurrences. Each bit of a term's hash votes for
    or against that bit with the term's weight, and the sign of the sum is the fingerprint's bit; a tie
    is 0. So a text without words has the fingerprint 0.
    """
    out: list[str] = []
    for lo, hi in blocks(len(t or b"") for t in texts):
        words = Words(texts[lo:hi])
        counts = words.counts()
        for k in range(hi - lo):
            hashes = words.hashes[words.first[k] : words.first[k + 1]]
            if not counts[k]:
                out.append("0" * (BITS // 4))
                continue
            terms, times = np.unique(grams(hashes, min(gram, len(hashes))), return_counts=True)
            weights = np.sqrt(times)
            lanes = np.stack([mix(terms, lane + 1) for lane in range(LANES)], axis=1)
            votes = np.zeros(BITS)
            # A byte of the hash at a time: the weights of its 256 values, then the votes of those.
            for i, column in enumerate(lanes.view(np.uint8).reshape(len(terms), -1).T):
                votes[8 * i : 8 * i + 8] = np.bincount(column, weights, minlength=256) @ _SIGNS
            out.append(np.packbits(votes > 1e-9).tobytes().hex())
    return out


def likeness(a: str, b: str) -> float:
    """1 less the share of bits in which two fingerprints differ."""
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / (4 * len(a))


def fingerprinted(documents: DataFrame, gram: int = 2) -> DataFrame:
    """doc_id and fingerprint of every document (doc_id, text); a null text counts as empty."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [None if t is None else t.encode("utf-8", "surrogatepass") for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "fingerprint": fingerprints(texts, gram)})

    rows = in_small_batches(documents).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInPandas(over, "doc_id long, fingerprint string")


def _hamming(a: Column, b: Column) -> Column:
    """Differing bits of two hexadecimal fingerprints of equal length."""
    parts = [
        F.bit_count(
            F.conv(F.substring(a, i, 15), 16, 10).cast("long").bitwiseXOR(F.conv(F.substring(b, i, 15), 16, 10).cast("long"))
        )
        for i in range(1, BITS // 4 + 1, 15)
    ]
    return sum(parts[1:], parts[0])


def near_fingerprints(prints: DataFrame, radius: int = 6, cuts: int = 8, clean: int = 2) -> tuple[DataFrame, DataFrame]:
    """All pairs of different fingerprints at most `radius` bits apart, and who has each.

    Fingerprints are cut into `cuts` blocks. Two that differ in at most radius bits agree
    in cuts - radius blocks at least; for each choice of `clean` <= cuts - radius blocks there is a
    permuted table in which those blocks come first as the key, so every such pair meets in some
    table. A pair that meets in several is kept in the first only. Keys have
    clean * 128 / cuts bits, which should exceed log2 of the number of fingerprints.

    Returns pairs (a, b, distance) with a < b, one for each pair of distinct fingerprints, and members
    (fingerprint, doc_id). Equal fingerprints make no pairs: they share their fingerprint in members.
    Null fingerprints are left out of both.
    """
    if not 1 <= clean <= cuts - radius:
        raise ValueError("cuts - radius blocks are sure to agree; clean must not exceed that")
    digits = BITS // 4 // cuts
    tables = list(combinations(range(cuts), clean))
    members = prints.where(F.col("fingerprint").isNotNull()).select("fingerprint", "doc_id")
    distinct = members.select("fingerprint").distinct()
    block = lambda c, k: F.substring(c, k * digits + 1, digits)
    keys = F.array(
        *[F.struct(F.lit(i).alias("table"), F.concat(*[block(F.col("fingerprint"), k) for k in t]).alias("key")) for i, t in enumerate(tables)]
    )
    dealt = distinct.select("fingerprint", F.explode(keys).alias("place")).select("fingerprint", "place.table", "place.key")
    left = dealt.select(F.col("fingerprint").alias("a"), "table", "key")
    right = dealt.select(F.col("fingerprint").alias("b"), "table", "key")
    agreeing = F.array(*[block(F.col("a"), k) == block(F.col("b"), k) for k in range(cuts)])
    # The first table of a pair is that of its first agreeing blocks.
    firsts = F.slice(F.filter(F.transform(agreeing, lambda x, k: F.when(x, k)), lambda x: x.isNotNull()), 1, clean)
    of_table = F.element_at(F.array(*[F.array(*[F.lit(k) for k in t]) for t in tables]), F.col("table") + 1)
    pairs = (
        left.join(right, ["table", "key"])
        .where(F.col("a") < F.col("b"))
        .withColumn("distance", _hamming(F.col("a"), F.col("b")))
        .where((F.col("distance") <= radius) & (firsts == of_table))
        .select("a", "b", "distance")
    )
    return pairs, members


def _bounds(ids: DataFrame, rows_each: int) -> list[int]:
    """Ascending ids that cut the table into ranges of about rows_each rows; 10,000 cuts at most."""
    n = ids.count()
    parts = min(10_000, n // rows_each)
    if parts < 2:
        return []
    shares = [k / parts for k in range(1, parts)]
    return sorted(set(ids.select(F.percentile_approx("doc_id", shares, 10 * parts)).first()[0] or []))


def edit(text: str, following: str) -> str:
    """A text whose last quarter is replaced by the beginning of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


NEIGHBOURS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(gram: int):
    import hashlib

    def rows_of(pairs: list[tuple[int, str, str]]) -> pd.DataFrame:
        edited = [edit(t, after).encode("utf-8", "surrogatepass") for _, t, after in pairs]
        own = [t.encode("utf-8", "surrogatepass") for _, t, _ in pairs]
        after = [a.encode("utf-8", "surrogatepass") for _, _, a in pairs[-1:]]
        prints = fingerprints(own + after, gram)
        changed = fingerprints(edited, gram)
        return pd.DataFrame(
            {
                "doc_id": pd.array([d for d, _, _ in pairs], dtype="Int64"),
                "n_chars": [len(t) for _, t, _ in pairs],
                "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edited],
                "fingerprint": prints[: len(pairs)],
                "edited_fingerprint": changed,
                "near_edited": [likeness(a, b) for a, b in zip(prints, changed)],
                "near_next": [likeness(a, b) for a, b in zip(prints, prints[1:])],
            }
        )

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, str, str]] = []
        before, size = None, 0
        for batch in batches:
            for span, border, doc_id, text in zip(batch["span"], batch["border"], batch["doc_id"], batch["text"]):
                text = text or ""
                if before is not None and before[0] == span:
                    held.append((before[1], before[2], text))
                    size += len(before[2])
                    if size >= 1 << 20:
                        yield rows_of(held)
                        held, size = [], 0
                elif held:
                    yield rows_of(held)
                    held, size = [], 0
                before = None if border else (span, None if pd.isna(doc_id) else int(doc_id), text)
        if held:
            yield rows_of(held)

    return over


def compared_with_next(documents: DataFrame, gram: int = 2, rows_each: int = 500) -> DataFrame:
    """How well fingerprints tell a small edit from another text.

    Every document (doc_id, text) is compared with its edit (see `edit`) and with the next document
    in ascending doc_id; after the last comes the first. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Documents are dealt to ranges of ids and sorted within their range; the first document of a
    range also goes to the end of the range before it, so each task sees every neighbour it
    needs. Texts are moved once and read as a stream.

    A null text is empty. Null ids come first; among equal ids, texts are in order. A single document is
    its own next. An empty table gives no rows. Other columns are not read.
    """
    rows = in_small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = rows.select("doc_id")
    bounds = np.array(_bounds(ids, rows_each), dtype=np.int64)

    def range_of(doc_id: pd.Series) -> np.ndarray:
        """How many bounds an id reaches; a null id reaches none."""
        known = doc_id.notna().to_numpy()
        out = np.zeros(len(doc_id), dtype=np.int64)
        out[known] = np.searchsorted(bounds, doc_id[known].astype("int64").to_numpy(), side="right")
        return out

    @F.pandas_udf("long")
    def span_of(doc_id: pd.Series) -> pd.Series:
        return pd.Series(range_of(doc_id))

    heads = (
        ids.select(span_of("doc_id").alias("span"), "doc_id")
        .groupBy("span")
        .agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("null"))
        .orderBy("span")
        .collect()
    )
    # A range's first document closes the range before; the first range closes the last.
    closes = {None if h["null"] else h["first"]: heads[i - 1]["span"] for i, h in enumerate(heads)}

    @F.pandas_udf("array<struct<span:long,border:boolean>>")
    def places(doc_id: pd.Series) -> pd.Series:
        out = []
        for one, span in zip(doc_id, range_of(doc_id).tolist()):
            own = [{"span": span, "border": False}]
            key = None if pd.isna(one) else int(one)
            out.append(own + [{"span": closes[key], "border": True}] if key in closes else own)
        return pd.Series(out)

    dealt = (
        rows.select("doc_id", "text", F.explode(places("doc_id")).alias("place"))
        .select("place.span", "place.border", "doc_id", "text")
        .repartition("span")
        .sortWithinPartitions("span", "border", "doc_id", "text")
    )
    return dealt.mapInPandas(_compared(gram), NEIGHBOURS)
