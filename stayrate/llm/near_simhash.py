"""Groups of documents whose SimHash fingerprints differ in few bits, found by bit counts of segments."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.llm.components import connected_components
from stayrate.llm.scratch import in_small_batches, written

BITS = 64
SEED = 42
#: A fingerprint with more than this share of all rows is joined apart; there are fewer than 1 / HOT of them.
HOT = 1e-4
#: Votes are counted so many hashes at a time.
VOTES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of a text: a bit is 1 if it is set in over half of its shingles' hashes.

    Shingles are the runs of `width` words (A-Z lower-cased, a space between), repeats included; a text
    of fewer words is one shingle, and one of none has the fingerprint 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined, count = b" ".join(words), max(1, len(words) - width + 1)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:count].tolist()
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[-count:].tolist())), dtype=np.uint64, count=count
    )
    votes = np.zeros(BITS, dtype=np.int64)
    for i in range(0, count, VOTES_AT_ONCE):
        some = hashes[i : i + VOTES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > count, bitorder="little").tobytes(), "little")


def fingerprinted(documents: DataFrame, width: int = 3) -> DataFrame:
    """doc_id and print, the fingerprint as a long of the same bits, of every document (doc_id, text)."""

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = [fingerprint((t or "").encode("utf-8", "surrogatepass"), width) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "print": np.array(prints, dtype=np.uint64).view(np.int64)})

    rows = in_small_batches(documents).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInPandas(over, "doc_id long, print long")


@dataclass(frozen=True)
class Grid:
    """The embedding of fingerprints: how many bits are set in each of `segments` segments.

    The Manhattan distance of two embeddings is at most the number of differing bits. Segments are dealt to `parts`
    parts of a fingerprint; within a distance of `radius` some part has a Manhattan distance of radius / parts at most, which
    has to be 0 or 1. So two fingerprints meet in the same cell of that part's grid, or in cells that are
    neighbours along one axis.
    """

    radius: int = 3
    segments: int = 32
    parts: int = 2
    #: Members of a cell beyond which it is cut into chunks.
    chunk: int = 1024

    def __post_init__(self):
        if BITS % self.segments or self.segments % self.parts or BITS // self.parts > 32:
            raise ValueError("segments divide 64, parts divide segments, and a part has 32 bits at most")
        if self.radius // self.parts > 1:
            raise ValueError("radius / parts has to be below 2")

    @property
    def width(self) -> int:
        return BITS // self.segments

    def axes(self) -> int:
        return self.segments // self.parts

    def count(self, part: int, axis: int) -> Column:
        """The set bits of a segment."""
        shift = (part * self.axes() + axis) * self.width
        return F.bit_count(F.shiftrightunsigned("print", shift).bitwiseAND(F.lit((1 << self.width) - 1)))

    def cell(self, part: int) -> Column:
        """The number of the cell in which a fingerprint lies."""
        base = self.width + 1
        terms = [self.count(part, i).cast("long") * base**i for i in range(self.axes())]
        return sum(terms[1:], terms[0]) + part * base ** self.axes()

    def neighbours(self, part: int) -> Column:
        """The cells one step up along an axis: of two neighbours, the lower one visits the upper one."""
        base, own = self.width + 1, self.cell(part)
        up = [F.when(self.count(part, i) < self.width, own + base**i) for i in range(self.axes())]
        return F.filter(F.array(*up), lambda c: c.isNotNull())


def _rest(prints: np.ndarray, part_bits: int, part: np.ndarray) -> np.ndarray:
    """The set bits of fingerprints outside a part."""
    inside = np.uint64((1 << part_bits) - 1) << (part.astype(np.uint64) * np.uint64(part_bits))
    return np.bitwise_count(prints & ~inside).astype(np.int64)


class _Joined:
    """Which members of a cell are joined already; a link is told once for each join."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, one: int, others: np.ndarray) -> list[int]:
        """Of the others, one of each group that `one` is not yet joined with."""
        groups, first = np.unique(self.of[others], return_index=True)
        new = groups != self.of[one]
        if not new.any():
            return []
        self.of[np.isin(self.of, groups)] = self.of[one]
        return others[first[new]].tolist()


def _links_of(prints: np.ndarray, part: int, left: np.ndarray, right: np.ndarray, grid: Grid) -> list[tuple[int, int]]:
    """Links that join all members of one cell (or of two chunks of it) that are linked there.

    left, right: whether a member is compared with the others, or others with it. Members are in order of their set bits
    outside the part: those further apart in that than the radius allows are not compared (again a Manhattan
    distance, of one segment). The rest are compared bit by bit.
    """
    bits = BITS // grid.parts
    outside = _rest(prints, bits, np.full(len(prints), part))
    order = np.argsort(outside, kind="stable")
    prints, outside, left, right = prints[order], outside[order], left[order], right[order]
    others = np.flatnonzero(right)
    lows = np.searchsorted(outside[others], outside - grid.radius)
    highs = np.searchsorted(outside[others], outside + grid.radius, side="right")
    joined, out = _Joined(len(prints)), []
    for i in np.flatnonzero(left).tolist():
        near = others[lows[i] : highs[i]]
        near = near[np.bitwise_count(prints[near] ^ prints[i]) <= grid.radius]
        if len(near) > 1 or (len(near) and near[0] != i):
            out += [(int(prints[i]), int(prints[k])) for k in joined.join(i, near)]
    return out


def _linked(grid: Grid):
    cells = (grid.width + 1) ** grid.axes()

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def links(cell: int, i: int, j: int, prints: np.ndarray, slot: np.ndarray, own: np.ndarray) -> list[tuple[int, int]]:
            left, right = own & (slot == i), slot == j
            if len(prints) == 2:
                met = (left[0] and right[1]) or (left[1] and right[0])
                return [(int(prints[0]), int(prints[1]))] if met and (int(prints[0]) ^ int(prints[1])).bit_count() <= grid.radius else []
            return _links_of(prints, cell // cells, left, right, grid)

        held: list[np.ndarray] = []
        for batch in batches:
            rows = [batch[c].to_numpy() for c in ("cell", "i", "j", "print", "slot", "own")]
            # What is held back is the last task of the batch before, never more than a chunk or two.
            rows = [np.concatenate(pair) for pair in zip(held, rows)] if held else rows
            cell, i, j, prints, slot, own = rows
            prints = prints.view(np.uint64)
            change = (cell[1:] != cell[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
            cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
            found: list[tuple[int, int]] = []
            for lo, hi in zip(cuts, cuts[1:]):
                found += links(int(cell[lo]), int(i[lo]), int(j[lo]), prints[lo:hi], slot[lo:hi], own[lo:hi])
            held = [x[cuts[-1] :] for x in rows]
            yield _signed(found)
        if held and len(held[0]):
            cell, i, j, prints, slot, own = held
            yield _signed(links(int(cell[0]), int(i[0]), int(j[0]), prints.view(np.uint64), slot, own))

    return over


def _signed(links: list[tuple[int, int]]) -> pd.DataFrame:
    both = np.array(links, dtype=np.uint64).reshape(-1, 2).view(np.int64)
    return pd.DataFrame({"a": both.min(axis=1), "b": both.max(axis=1)})


def near_links(distinct: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Links (a, b), a < b, that join exactly the fingerprints reachable by steps of `radius` bits or fewer.

    distinct: print, each once. Every fingerprint owns the cell in which it lies, in each part's grid, and visits
    the cells one step up; visits to cells that nobody owns go at once. In a cell, owners are compared with owners
    and visitors, and of the links found there a spanning forest is kept, so a cell of n members
    gives fewer than n links. Cells of more than `chunk` members are cut into chunks, and each pair of chunks is a task.
    """
    parts = range(grid.parts)
    own = distinct.select("print", F.explode(F.array(*[grid.cell(p) for p in parts])).alias("cell"))
    visits = distinct.select("print", F.explode(F.flatten(F.array(*[grid.neighbours(p) for p in parts]))).alias("cell"))
    if not grid.radius // grid.parts:
        visits = visits.limit(0)
    owned = written(own, "simhash-own")
    owners = owned.groupBy("cell").agg(F.count(F.lit(1)).alias("owners"))
    guests = written(visits.join(owners, "cell").select("print", "cell"), "simhash-guests")
    sizes = (
        owners.join(guests.groupBy("cell").agg(F.count(F.lit(1)).alias("guests")), "cell", "left")
        .withColumn("guests", F.coalesce("guests", F.lit(0)))
        .where("owners + guests > 1")
    )
    whole = F.col("owners") + F.col("guests") <= grid.chunk
    chunks = lambda c: F.ceil(F.col(c) / (grid.chunk // 2))
    sizes = sizes.select(
        "cell", F.when(whole, 1).otherwise(chunks("owners")).alias("left"), F.when(whole, 0).otherwise(chunks("guests")).alias("more")
    )
    members = owned.withColumn("own", F.lit(True)).unionByName(guests.withColumn("own", F.lit(False)))
    dealt = F.xxhash64("print", "cell")
    slot = F.when(F.col("own"), F.pmod(dealt, "left")).when(F.col("more") == 0, 0).otherwise(F.col("left") + F.pmod(dealt, F.greatest("more", F.lit(1))))
    # A chunk of owners meets itself, the chunks after it, and the chunks before it; one of visitors all chunks of owners.
    last = F.when(F.col("slot") < F.col("left"), F.col("left") + F.col("more")).otherwise(F.col("left"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), last - 1))
    tasks = (
        members.join(sizes, "cell")
        .withColumn("slot", slot.cast("long"))
        .withColumn("other", other)
        .select("cell", F.least("slot", "other").alias("i"), F.greatest("slot", "other").alias("j"), "slot", "own", "print")
    )
    # Few bytes are much work here, so partitions are not to be joined by their size.
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt_out = tasks.repartition(parts, "cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return dealt_out.mapInPandas(_linked(grid), "a long, b long")


def near_groups(documents: DataFrame, width: int = 3, grid: Grid = Grid()) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of documents (doc_id, text).

    Rows are linked if their fingerprints differ in `grid.radius` bits or fewer; component_id is the smallest doc_id that links
    lead to, the row's own included. Only distinct fingerprints are compared, so copies of any number are one.

    A null or empty text, or one without words, has the fingerprint 0 and is linked like any other. Null ids link like
    others and are never the smallest, unless all are null. Repeated rows have a row each. A text of any length is read whole, its
    hashes counted in pieces. An empty table gives no rows. Other columns are not read.
    """
    prints = written(fingerprinted(documents, width), "simhash")
    members = written(prints.groupBy("print").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("times")), "simhash-distinct")
    groups = written(
        connected_components(written(near_links(members.select("print"), grid), "simhash-links")).withColumnRenamed("vertex", "print"),
        "simhash-groups",
    )
    linked = groups.join(members, "print")
    least = linked.groupBy("component").agg(F.min("least").alias("least"))
    found = groups.join(least, "component").select("print", F.col("least").alias("joined"))
    ids = written(members.join(found, "print", "left").select("print", "times", F.coalesce("joined", "least").alias("component_id")), "simhash-ids")
    rows = members.agg(F.sum("times")).first()[0] or 0
    # Copies by the thousand stay where they are: their few fingerprints come to them.
    often = F.col("times") > rows * HOT
    copied = F.broadcast(ids.where(often).select("print", "component_id"))
    rest = ids.where(~often).select("print", "component_id")
    out = prints.join(copied, "print").unionByName(prints.join(copied, "print", "left_anti").join(rest, "print"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
