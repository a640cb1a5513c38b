"""Removal of passages that repeat across documents, with repeated-phrase automata."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import ahocorasick
import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.scratch import in_small_batches, written
from stayrate.llm.words import BLOCK_BYTES, Words, blocks, grams

ANCHORED = "doc_id long, n_words long, text_id binary, anchors array<long>"
WINDOWS = "window long, doc_id long"
PASSAGE, NOTE, TEXT = 0, 1, 2
OUT = "doc_id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept string"


@dataclass(frozen=True)
class Anchors:
    """Which runs of words stand for the windows that hold them.

    In every window of `window` words, the run of `run` words with the least hash is its
    anchor. Equal windows have equal anchors, so a window that repeats has an anchor that repeats,
    and only about 2 in window - run + 2 runs are anchors of some window.
    """

    window: int = 50

    @property
    def run(self) -> int:
        return max(1, self.window // 3)

    @property
    def runs(self) -> int:
        """Runs in a window."""
        return self.window - self.run + 1


def anchors_of(hashes: np.ndarray, how: Anchors) -> tuple[np.ndarray, np.ndarray]:
    """The run hashes of a text and, for each window, the place of its anchor; the last of equal ones."""
    found = grams(hashes, how.run)
    n = len(found) - how.runs + 1
    if n <= 0:
        return found, np.empty(0, dtype=np.int64)
    # The place of the least of `runs` neighbours, by doubling: each step joins two spans.
    least, place, span = found.copy(), np.arange(len(found)), 1
    while span < how.runs:
        step = min(span, how.runs - span)
        a, b = slice(0, len(least) - step), slice(step, None)
        later = least[b] <= least[a]
        place = np.where(later, place[b], place[a])
        least = np.where(later, least[b], least[a])
        span += step
    return found, place


def _utf8(texts) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]


def _anchored(how: Anchors):
    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids = _utf8(batch["text"]), batch["doc_id"].to_numpy()
            for lo, hi in blocks(map(len, texts)):
                words = Words(texts[lo:hi])
                rows = []
                for k in range(hi - lo):
                    hashes = words.hashes[words.first[k] : words.first[k + 1]]
                    found, place = anchors_of(hashes, how)
                    anchors = np.unique(found[np.unique(place)]).view(np.int64) if len(place) else []
                    rows.append((ids[lo + k], len(hashes), hashlib.md5(hashes.tobytes()).digest(), anchors))
                yield pd.DataFrame(rows, columns=["doc_id", "n_words", "text_id", "anchors"])

    return over


def _words_of(data: bytes) -> list[bytes]:
    return zstandard.decompress(data).split()


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Texts as compressed words, which halves what is moved."""
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield batch.assign(data=[press.compress(b" ".join(t.split())) for t in _utf8(batch["text"])])[["doc_id", "data"]]


def _windows(how: Anchors):
    """Rows (doc_id, data, shared) to the distinct windows whose anchor is among the shared ones."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, shared = batch["doc_id"].to_numpy(), list(batch["shared"])
            texts = [zstandard.decompress(d) for d in batch["data"]]
            for lo, hi in blocks(map(len, texts)):
                words = Words(texts[lo:hi])
                parts = []
                for k in range(hi - lo):
                    hashes = words.hashes[words.first[k] : words.first[k + 1]]
                    found, place = anchors_of(hashes, how)
                    at = np.isin(found[place].view(np.int64), np.asarray(shared[lo + k], dtype=np.int64))
                    parts.append(np.unique(grams(hashes, how.window)[at]))
                yield pd.DataFrame(
                    {
                        "window": np.concatenate(parts).view(np.int64),
                        "doc_id": np.repeat(ids[lo:hi], [len(p) for p in parts]),
                    }
                )

    return over


def stretches(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """The stretches (first word, last + 1) that windows at the given sorted starts cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > width) + 1
    return [(int(p[0]), int(p[-1]) + width) for p in np.split(starts, cut)]


def _passages(how: Anchors):
    """Rows (doc_id, data, windows) to the stretches of a text that its recurring windows cover."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            rows = []
            for doc_id, data, windows in zip(batch["doc_id"], batch["data"], batch["windows"]):
                text = zstandard.decompress(data)
                all_windows = grams(Words([text]).hashes, how.window).view(np.int64)
                starts = np.flatnonzero(np.isin(all_windows, np.asarray(windows, dtype=np.int64)))
                words = text.split()
                for a, b in stretches(starts, how.window):
                    rows.append((doc_id, press.compress(b" ".join(words[a:b]))))
            yield pd.DataFrame(rows, columns=["owner", "passage"])

    return over


class Phrases:
    """An automaton of blocks of passages, and what is needed to extend an occurrence of a block.

    A passage is cut into blocks of half a window, so every window inside it holds a whole block. Of the places of a block
    in one passage that have the same words around them, as far as a window reaches, one is kept: a passage that
    repeats a word or a phrase has few.
    """

    def __init__(self, how: Anchors):
        self.how = how
        self.passages: list[list[bytes]] = []
        self.blocks: dict[str, list[tuple[int, int]]] = {}
        self.automaton: ahocorasick.Automaton | None = None

    def add(self, words: list[bytes]) -> int:
        """Takes a passage in and gives its number."""
        size = max(1, self.how.window // 2)
        reach, seen = self.how.window - size, set()
        for at in range(0, len(words) - size + 1, size):
            around = (min(at, reach), *words[max(0, at - reach) : at + size + reach])
            if around in seen:
                continue
            seen.add(around)
            block = f" {b' '.join(words[at : at + size]).decode('utf-8', 'surrogatepass')} "
            self.blocks.setdefault(block, []).append((len(self.passages), at))
        self.passages.append(words)
        return len(self.passages) - 1

    def compile(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for block, places in self.blocks.items():
            self.automaton.add_word(block, places)
        self.automaton.make_automaton()
        self.blocks = {}

    def covered(self, words: list[bytes], allowed: set[int]) -> np.ndarray:
        """Which words lie in a window that an allowed passage holds too.

        A match is extended only as far as windows that hold it reach, and not at all if these are known already.
        """
        hit = np.zeros(len(words), dtype=bool)
        if self.blocks:
            self.compile()
        if self.automaton is None or not allowed or len(words) < self.how.window:
            return hit
        window, size = self.how.window, max(1, self.how.window // 2)
        reach = window - size
        line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
        ends = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype="<u4") == 0x20)[1:]
        # 1 for each word with which a window starts that an allowed passage holds.
        known = bytearray(len(words) - window + 1)
        for end, places in self.automaton.iter(line):
            last = int(np.searchsorted(ends, end)) + 1
            first = last - size
            low, high = max(0, first - reach), min(first, len(words) - window)
            for passage, at in places:
                if known.find(0, low, high + 1) < 0:
                    break
                if passage not in allowed:
                    continue
                other = self.passages[passage]
                i, j, least = first, at, first - reach
                while i > max(0, least) and j and words[i - 1] == other[j - 1]:
                    i, j = i - 1, j - 1
                p, q, most = last, at + size, min(len(words), last + reach)
                while p < most and q < len(other) and words[p] == other[q]:
                    p, q = p + 1, q + 1
                if p - i >= window:
                    known[i : p - window + 1] = b"\x01" * (p - window + 1 - i)
                    hit[i:p] = True
        return hit


def _located(how: Anchors):
    """Rows of a block, in order of kind: passages with their owners, notes on which owners a document
    needs or that it is a copy, and documents, in which occurrences of the passages are located."""
    columns = ["doc_id", "n_words", "n_removed", "removed", "kept"]

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, phrases, passages, needs, copies = None, Phrases(how), {}, {}, set()
        for batch in batches:
            rows = []
            for block, kind, doc_id, data, owners in zip(*(batch[c] for c in ("block", "kind", "doc_id", "data", "owners"))):
                if block != shard:
                    shard, phrases, passages, needs, copies = block, Phrases(how), {}, {}, set()
                if kind == PASSAGE:
                    passages.setdefault(doc_id, []).append(phrases.add(_words_of(data)))
                    continue
                if kind == NOTE:
                    if owners is None:
                        copies.add(doc_id)
                    else:
                        needs[doc_id] = {p for o in owners for p in passages.get(o, ())}
                    continue
                words = _words_of(data)
                if doc_id in copies:
                    hit = np.full(len(words), len(words) >= how.window)
                else:
                    hit = phrases.covered(words, needs.get(doc_id, set()))
                edge = np.diff(hit.astype(np.int8), prepend=0, append=0)
                removed = [{"start": a, "end": b} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
                kept = b" ".join([w for w, h in zip(words, hit) if not h] if removed else words)
                doc_id = None if pd.isna(doc_id) else int(doc_id)
                rows.append((doc_id, len(words), int(hit.sum()), removed, kept.decode("utf-8", "surrogatepass")))
                if len(rows) >= 256:
                    yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    return over


def without_repeats(documents: DataFrame, window: int = 50, block_bytes: int = 4 * BLOCK_BYTES) -> DataFrame:
    """Documents (doc_id, text) without the words of windows that a smaller doc_id holds as well.

    A window is `window` consecutive words. Steps:
    1. Every document gives its anchors (see Anchors); those of two different texts are shared.
    2. The windows around shared anchors are counted by hash. One found in several documents is
       confirmed to recur, and the smallest of these owns it. An owner's windows merge to passages.
    3. Documents are dealt to blocks of about `block_bytes`. For each block, the passages its documents
       need are compiled into one automaton, through which its documents are streamed. An occurrence of
       half a window is extended word by word along the passage; of `window` words or more, its words
       are removed. So hashes only say where to look, and words decide: a collision of 64-bit hashes can
       take nothing away wrongly, and hides a window only if no other of its passage recurs.
    Copies of a whole text are known by its hash, and need no look if a smaller doc_id has it.

    Returns doc_id, n_words, n_removed, removed (stretches of words, end exclusive) and kept (the
    other words joined by one space). Words are runs without ASCII white space, compared
    unchanged. Null and empty texts have no words. Texts shorter than a window lose nothing. doc_id
    should be unique: of rows that share one, and of a null, none is removed on account of
    another. An empty table gives no rows. Other columns are not read.
    """
    how = Anchors(window)
    rows = in_small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    anchored = written(rows.mapInPandas(_anchored(how), ANCHORED), "anchored")
    long = anchored.where((F.col("n_words") >= window) & F.col("doc_id").isNotNull())
    firsts = long.groupBy("text_id").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    copies = long.select("doc_id", "text_id").join(firsts, "text_id").where("doc_id > first").select("doc_id")
    copies = written(copies.distinct(), "copies")
    own = long.join(copies, "doc_id", "left_anti").select("doc_id", F.explode("anchors").alias("anchor"))
    shared = own.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    flagged = own.join(shared.select("anchor"), "anchor").groupBy("doc_id").agg(F.collect_list("anchor").alias("shared"))
    texts = rows.mapInPandas(_packed, "doc_id long, data binary")
    suspects = written(texts.join(flagged, "doc_id"), "suspects")
    windows = suspects.mapInPandas(_windows(how), WINDOWS)
    recurring = windows.groupBy("window").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"))
    recurring = written(recurring.where("owner < last").select("window", "owner"), "recurring")
    needs = windows.join(recurring, "window").where("owner < doc_id").select("doc_id", "owner").distinct()
    needs = written(needs, "needs")
    owned = recurring.groupBy("owner").agg(F.collect_list("window").alias("windows")).withColumnRenamed("owner", "doc_id")
    passages = written(
        suspects.select("doc_id", "data").join(owned, "doc_id").mapInPandas(_passages(how), "owner long, passage binary"),
        "passages",
    )
    # Blocks: enough for all the text at the given size each.
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    block = F.pmod(F.xxhash64("doc_id"), F.lit(max(1, -(-size // block_bytes)))).alias("block")
    none, nobody = F.lit(None).cast("binary").alias("data"), F.lit(None).cast("array<long>").alias("owners")
    wanted = needs.select(block, "owner").distinct().join(passages, "owner")
    parts = [
        wanted.select("block", F.lit(PASSAGE).alias("kind"), F.col("owner").alias("doc_id"), F.col("passage").alias("data"), nobody),
        needs.groupBy("doc_id").agg(F.collect_list("owner").alias("owners")).select(
            block, F.lit(NOTE).alias("kind"), "doc_id", none, "owners"
        ),
        copies.select(block, F.lit(NOTE).alias("kind"), "doc_id", none, nobody),
        texts.select(block, F.lit(TEXT).alias("kind"), "doc_id", "data", nobody),
    ]
    dealt = reduce(DataFrame.unionByName, parts).repartition("block").sortWithinPartitions("block", "kind")
    return dealt.mapInPandas(_located(how), OUT)
