"""Passages of benchmark items in documents, found by one Aho-Corasick automaton."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import parquet
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.scratch import in_small_batches, written

#: Bytes that part words: all of ASCII but letters and digits.
_PARTING = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_LOWER = bytes(range(0x41, 0x5B))
#: Lower-cases A-Z and turns every parting byte into a space; other bytes stay.
_NORMAL = bytes(
    b + 32 if b in _LOWER else 0x20 if b in _PARTING else b for b in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

PASSED = "doc_id long, text string, n_words long, runs array<struct<start:long,end:long>>, items array<string>"
HITS = (
    "doc_id long, n_words long, n_hit long, items array<string>, "
    "spans array<struct<start:long,end:long>>"
)


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text: A-Z lower-cased, then runs of letters, digits and non-ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_NORMAL).split()


@dataclass
class Windows:
    """The distinct windows of a set of items, and which items hold each."""

    texts: list[str]
    sizes: list[int]
    items: list[list[str]]


def _cut(width: int):
    """Rows (window, size, item): all windows of `width` consecutive words; an item with fewer words is one window."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for item, text in zip(batch["item"], batch["text"]):
                words = normal_words(text)
                found = {b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1) if words else 0)}
                if found:
                    yield pd.DataFrame({"window": sorted(found), "size": min(width, len(words)), "item": item})

    return over


@dataclass
class Stored:
    """A written table of windows, dealt to parts by a hash of the window; each part makes one automaton."""

    files: list[str]
    parts: int

    def windows(self, part: int) -> Windows:
        """The windows of a part, read by the task that needs them."""
        found: dict[bytes, tuple[int, list[str]]] = {}
        for file in self.files:
            system, path = FileSystem.from_uri(file.replace("s3a://", "s3://", 1))
            rows = parquet.read_table(path, filesystem=system, filters=[("part", "=", part)])
            for window, size, item in zip(*(rows[c].to_pylist() for c in ("window", "size", "item"))):
                found.setdefault(window, (size, []))[1].append(item)
        return Windows(
            [f" {w.decode('utf-8', 'surrogatepass')} " for w in found], [n for n, _ in found.values()], [x for _, x in found.values()]
        )


def stored_windows(benchmark: DataFrame, width: int, most_bytes: int) -> Stored:
    """The distinct windows of the items, written to the shared folder in parts of about `most_bytes` bytes."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("None")).alias("item"), F.col("text").cast("string").alias("text"))
    rows = written(in_small_batches(items).mapInPandas(_cut(width), "window binary, size int, item string").distinct(), "windows")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("window")), F.lit(0))).first()[0]
    parts = max(1, -(-size // most_bytes))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("window"), F.lit(parts)).cast("int"))
    return Stored(written(dealt.repartition(parts, "part"), "window-parts").inputFiles(), parts)


def automaton_of(windows: Windows) -> ahocorasick.Automaton | None:
    if not windows.texts:
        return None
    automaton = ahocorasick.Automaton()
    for i, text in enumerate(windows.texts):
        automaton.add_word(text, i)
    automaton.make_automaton()
    return automaton


def scan(text: str | None, automaton: ahocorasick.Automaton | None, windows: Windows) -> tuple[int, list[tuple[int, int]], set[str]]:
    """How many words a text has, its runs of hit words as (first, last + 1), and the items hit.

    The text is read once in its normal form, whose words are one space apart.
    """
    words = normal_words(text)
    if not words or automaton is None:
        return len(words), [], set()
    line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    matches = list(automaton.iter(line))
    if not matches:
        return len(words), [], set()
    # The space that ends each word, in order.
    ends = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype="<u4") == 0x20)[1:]
    last = np.searchsorted(ends, np.array([end for end, _ in matches])) + 1
    first = last - np.array([windows.sizes[i] for _, i in matches])
    return len(words), joined(list(zip(first.tolist(), last.tolist()))), {x for _, i in matches for x in windows.items[i]}


def joined(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs in order, with those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original_spans(text: str, runs: list[tuple[int, int]]) -> list[dict]:
    """Runs of words as code point offsets in the text as it was."""
    places = [m.span() for m in _WORD.finditer(text)]
    return [{"start": places[a][0], "end": places[b - 1][1]} for a, b in runs]


def _pass(stored: Stored, part: int):
    """One pass over the documents: adds the runs and items of a part's windows to those so far."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        windows = stored.windows(part)
        automaton = automaton_of(windows)
        for batch in batches:
            rows = []
            for doc_id, text, had_runs, had_items in batch.itertuples(index=False):
                n, runs, items = scan(text, automaton, windows)
                runs = joined(runs + [(r["start"], r["end"]) for r in had_runs])
                rows.append((doc_id, text, n, [{"start": a, "end": b} for a, b in runs], sorted(items.union(had_items))))
            yield pd.DataFrame(rows, columns=["doc_id", "text", "n_words", "runs", "items"])

    return over


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        runs = [[(r["start"], r["end"]) for r in x] for x in batch["runs"]]
        batch["n_hit"] = [sum(b - a for a, b in x) for x in runs]
        batch["spans"] = [original_spans(t, x) if x else [] for t, x in zip(batch["text"], runs)]
        yield batch[["doc_id", "n_words", "n_hit", "items", "spans"]]


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, width: int = 10, most_bytes: int = 8_000_000) -> DataFrame:
    """Where windows of `width` item words occur in documents (doc_id, text).

    benchmark: item_id, text. A window is `width` consecutive words of an item in normal form, or
    the whole item if it is shorter. Returns for every document doc_id, n_words, n_hit (words inside
    any occurrence), items (ids of items with an occurring window, as sorted strings) and
    spans (the hit stretches as code point offsets in the original text).

    The windows are made by tasks and written to the shared folder, which has to be one that pyarrow can open too; nothing
    of them passes through the driver. Tasks compile them into one automaton, which scans
    every text once, without a shuffle. Windows of more than `most_bytes` bytes are dealt to as many automata as
    needed; the documents pass through one after the other and are written in between, so that a
    task holds one automaton, whose size the bytes bound.

    Null and empty texts have no words and no hits; null and empty items have no windows; an
    item id may be null ("None"). Items with the same text are all reported. Repeated documents are
    scanned one by one, very long ones whole. Other columns are not read. Without documents there are no rows; without
    items nothing is hit.
    """
    stored = stored_windows(benchmark, width, most_bytes)
    runs = F.array().cast("array<struct<start:long,end:long>>").alias("runs")
    out = in_small_batches(documents).select("doc_id", "text", runs, F.array().cast("array<string>").alias("items"))
    for k in range(stored.parts):
        out = written(out, "scanned") if k else out
        out = out.select("doc_id", "text", "runs", "items").mapInPandas(_pass(stored, k), PASSED)
    return out.mapInPandas(_finish, HITS)


def without_hits(documents: DataFrame, benchmark: DataFrame, width: int = 10, most_bytes: int = 8_000_000) -> DataFrame:
    """The documents, with all their columns, in whose text no window of the benchmark occurs (see benchmark_hits).

    Each row is judged by its own text, whether its id is null or repeated. Null and empty texts stay.
    """
    stored = stored_windows(benchmark, width, most_bytes)

    def over(part: int):
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            windows = stored.windows(part)
            automaton = automaton_of(windows)
            for batch in batches:
                keep = [not scan(text.as_py(), automaton, windows)[1] for text in batch["text"]]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return clean

    for k in range(stored.parts):
        documents = written(documents, "clean") if k else documents
        documents = in_small_batches(documents).mapInArrow(over(k), documents.schema)
    return documents
