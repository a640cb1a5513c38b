"""Near copies of documents by MinHash with tensored banding, confirmed on whole shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.llm.compact import compact, words_of
from stayrate.llm.components import connected_components
from stayrate.llm.scratch import in_small_batches, written
from stayrate.llm.sieve import sifted
from stayrate.llm.words import Words, blocks, grams, mix

SIGNED = "doc_id long, n_shingles long, set_id binary, left array<long>, right array<long>"
#: In how many different orders the members of buckets are tried as hubs.
ORDERS = 3
#: Sides of the blocks in which the members of neighbouring groups are compared.
HOSTS, GUESTS = 256, 512
#: Cells by which shingles are counted, whatever the tables: 1 MB.
CELLS = 1 << 20
#: Of the rows that share a rare shingle, how many are looked at by pairs at once, and how many pairs for each row are taken.
SIDE, PAIRS = 512, 4
#: How many times the members of crowds are linked with their most likely partners, at most.
TURNS = 8


@dataclass(frozen=True)
class Banding:
    """Two collections of `bands` half keys, each of `rows` minhashes.

    A table is a pair of a half key of the one and a half key of the other, so there are
    bands * bands tables of 2 * rows minhashes each, for 2 * bands * rows minhashes in all instead of
    bands * bands * 2 * rows. Two sets of similarity s meet in some table unless all half
    keys of one collection differ: a chance of about 2 * (1 - s ** rows) ** bands.
    """

    rows: int = 3
    bands: int = 13

    def sure_matches(self, similarity: float, risk: float = 1e-5) -> int:
        """How many of all half keys two sets so similar share at least, but for a chance of `risk`."""
        n, p = 2 * self.bands, similarity**self.rows
        fewer, k = 0.0, 0
        while fewer <= risk:
            fewer += comb(n, k) * p**k * (1 - p) ** (n - k)
            k += 1
        return k - 1


def shingles(text: bytes, width: int) -> np.ndarray:
    """The distinct runs of `width` words of a text, A-Z lower-cased, as sorted 64-bit hashes."""
    hashes = Words([text.lower()]).hashes
    return np.unique(grams(hashes, min(width, len(hashes)))) if len(hashes) else hashes


def half_keys(sets: list[np.ndarray], banding: Banding) -> tuple[np.ndarray, np.ndarray]:
    """The half keys of both collections, a row for each set; sets are not empty."""
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    every = np.concatenate(sets)
    halves = []
    with np.errstate(over="ignore"):
        for side in range(2):
            keys = np.empty((len(sets), banding.bands), dtype=np.uint64)
            for band in range(banding.bands):
                key = np.full(len(sets), band, dtype=np.uint64)
                for row in range(banding.rows):
                    seed = 1 + (side * banding.bands + band) * banding.rows + row
                    # A seeded odd factor and two shifts reorder the hashes, which are well mixed already.
                    factor = mix(np.array([seed], dtype=np.uint64))[0] | np.uint64(1)
                    order = (every ^ (factor >> np.uint64(7))) * factor
                    order ^= order >> np.uint64(32)
                    order *= np.uint64(0xD6E8FEB86659FD93)
                    least = np.minimum.reduceat(order, starts)
                    key = mix(key ^ least, row + 1)
                keys[:, band] = key
            halves.append(keys.view(np.int64))
    return halves[0], halves[1]


def _sign(width: int, banding: Banding):
    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass").lower() for t in batch["text"]]
            ids = batch["doc_id"].to_numpy()
            for lo, hi in blocks(map(len, texts)):
                words = Words(texts[lo:hi])
                sets = []
                for k in range(hi - lo):
                    hashes = words.hashes[words.first[k] : words.first[k + 1]]
                    sets.append(np.unique(grams(hashes, min(width, len(hashes)))) if len(hashes) else hashes)
                full = [s for s in sets if len(s)]
                left, right = half_keys(full, banding) if full else ([], [])
                keys = iter(zip(left, right))
                pairs = [next(keys) if len(s) else ((), ()) for s in sets]
                yield pd.DataFrame(
                    {
                        "doc_id": ids[lo:hi],
                        "n_shingles": [len(s) for s in sets],
                        "set_id": [hashlib.md5(s.tobytes()).digest() for s in sets],
                        "left": [a for a, _ in pairs],
                        "right": [b for _, b in pairs],
                    }
                )

    return over


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (key, vertex) sorted by key: each row but a key's first gives a pair (hub, vertex) with that first."""
    last_key, last_hub = None, None
    for batch in batches:
        key, vertex = batch["key"].to_numpy(), batch["vertex"].to_numpy()
        if not len(key):
            continue
        new = np.concatenate([[last_key is None or key[0] != last_key], key[1:] != key[:-1]])
        begins = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
        hub = vertex[np.maximum(begins, 0)]
        if not new[0]:
            hub = np.where(begins < 0, last_hub, hub)
        last_key, last_hub = key[-1], hub[-1]
        other = ~new & (hub != vertex)
        yield pd.DataFrame({"hub": hub[other], "vertex": vertex[other]})


def candidates(vertices: DataFrame, banding: Banding) -> DataFrame:
    """Pairs (a, b, tables, a_hub, b_hub) of vertices that share the key of some table, how many they were met in, and which was a hub.

    vertices: vertex, left, right. In each bucket, the first vertex in an order by hash
    is the hub and is paired with each of the others, so a bucket gives no more pairs than it has
    members. Each table uses one of a few orders of the vertices, so hubs differ between
    tables, and two similar sets, which share many buckets, are compared with each other or
    with the same third ones many times over; but a large group has only a few hubs in all.
    """
    tables = F.flatten(
        F.transform("left", lambda x: F.transform("right", lambda y: F.xxhash64(x, y)))
    )
    dealt = vertices.select("vertex", F.explode(tables).alias("key")).repartition("key")
    order = F.xxhash64("vertex", F.pmod("key", F.lit(ORDERS)))
    sorted_ = dealt.sortWithinPartitions("key", order)
    stars = sorted_.select("key", "vertex").mapInPandas(_stars, "hub long, vertex long")
    pairs = stars.select(F.least("hub", "vertex").alias("a"), F.greatest("hub", "vertex").alias("b"), "hub")
    is_hub = [F.max(F.col("hub") == F.col(c)).alias(f"{c}_hub") for c in "ab"]
    return pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("tables"), *is_hub)


def _confirm(width: int, least: float):
    hundredths = round(100 * least)

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, known, name = [], None, None
            for a, b, x, y in zip(batch["a"], batch["b"], batch["data_a"], batch["data_b"]):
                if name != a:
                    known, name = shingles(words_of(x), width), a
                other = shingles(words_of(y), width)
                both = np.intersect1d(known, other, assume_unique=True).size
                out.append(100 * both >= hundredths * (len(known) + len(other) - both))
            keep = np.array(out, dtype=bool)
            yield batch.loc[keep, ["a", "b"]]

    return over


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """The pairs (a, b) whose whole shingle sets are at least `least` similar. texts: vertex, data."""
    first, second = texts.toDF("a", "data_a"), texts.toDF("b", "data_b")
    rows = pairs.select("a", "b").join(first, "a").join(second, "b")
    return rows.mapInPandas(_confirm(width, least), "a long, b long")


def _compare(width: int, least: float, matches: int):
    """Rows of a block, mere guests first and mere hosts last: links of a guest and a host of other parts whose whole sets are similar enough.

    A row that is both is compared with the guests before it, and so is each later one with it. A link joins two parts.
    Parts that links of the block have joined are one from then on and are not compared, so a block gives fewer links
    than it has parts, and no similar pair of parts is left apart.
    """
    hundredths = round(100 * least)

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, names, sets = None, [], []
        sizes, home, table = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty((0, 0), dtype=np.int8)
        joined: dict[int, int] = {}

        def root(part: int) -> int:
            while (up := joined.get(part, part)) != part:
                joined[part] = joined.get(up, up)
                part = up
            return part

        for batch in batches:
            out = []
            for key, guest, host, vertex, part, data, sketch in zip(*(batch[c] for c in ("block", "is_guest", "is_host", "vertex", "part", "data", "sketch"))):
                if key != block:
                    block, names, sets = key, [], []
                    joined.clear()
                own, sketch, n = shingles(words_of(data), width), np.asarray(sketch, dtype=np.int8), len(names)
                if host and n:
                    alike = (table[:n] == sketch).sum(axis=1) >= matches
                    alike &= 100 * np.minimum(sizes[:n], len(own)) >= hundredths * np.maximum(sizes[:n], len(own))
                    alike &= home[:n] != part
                    for k in np.flatnonzero(alike):
                        one, other = root(part), root(int(home[k]))
                        if one == other:
                            continue
                        both = np.intersect1d(own, sets[k], assume_unique=True).size
                        if 100 * both >= hundredths * (len(own) + len(sets[k]) - both):
                            out.append((min(vertex, names[k]), max(vertex, names[k])))
                            joined[max(one, other)] = min(one, other)
                if guest:
                    if n == len(sizes) or table.shape[1] != len(sketch):
                        more = max(64, 2 * n)
                        sizes, home = np.resize(sizes, more), np.resize(home, more)
                        table = np.concatenate([table[:n].reshape(n, len(sketch)), np.empty((more - n, len(sketch)), dtype=np.int8)])
                    sizes[n], home[n], table[n] = len(own), part, sketch
                    names.append(vertex)
                    sets.append(own)
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return over


def _cells(shingles_: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return (shingles_ % np.uint64(len(counts))).astype(np.int64)


def _count_cells(width: int):
    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            for data in batch["data"]:
                np.add.at(counts, _cells(shingles(words_of(data), width), counts), 1)
        cell = np.flatnonzero(counts)
        yield pd.DataFrame({"cell": cell, "n": counts[cell]})

    return over


def shingle_levels(texts: DataFrame, width: int) -> np.ndarray:
    """For each cell of shingles, how many times the texts (data) have it, as a byte: 0 for at most once, else 1 + 4 * log2, rounded down."""
    counts = texts.select("data").mapInPandas(_count_cells(width), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    often = counts.where("n > 1").select("cell", F.least(F.floor(1 + 4 * F.log2("n")), F.lit(255)).cast("int").alias("level")).toPandas()
    levels = np.zeros(CELLS, dtype=np.uint8)
    levels[often["cell"].to_numpy(dtype=np.int64)] = often["level"].to_numpy(dtype=np.uint8)
    return levels


def _rank(width: int, least: float, levels: np.ndarray):
    """Rows (vertex, data, sketch) to the rarest shingles of each, and how many are left from each on."""
    hundredths = round(100 * least)

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, keys, rests = [], [], []
            for data in batch["data"]:
                own = shingles(words_of(data), width)
                level, n = levels[_cells(own, levels)], len(own)
                first = np.lexsort((own, level))[: n + hundredths * n // -100 + 1]
                often = level[first] > 0
                sizes.append(n)
                keys.append(own[first].view(np.int64)[often])
                rests.append((n - np.arange(len(first), dtype=np.int32))[often])
            yield pd.DataFrame({"vertex": batch["vertex"], "sketch": batch["sketch"], "size": sizes, "key": keys, "rest": rests})

    return over


def _common(size, other, hundredths: int):
    """How many shingles sets of these sizes have in common at least if they are similar enough; else more than either has."""
    common = -(-hundredths * (size + other) // (100 + hundredths))
    return np.where(100 * np.minimum(size, other) >= hundredths * np.maximum(size, other), common, size + other)


def _may_have_partners(part: np.ndarray, size: np.ndarray, rest: np.ndarray, hundredths: int) -> np.ndarray:
    """Which rows of one key fit some row of another part in size and rest, without looking at pairs."""
    sizes, at = np.unique(size, return_inverse=True)
    order = np.lexsort((-rest, at))
    top = order[np.searchsorted(at[order], np.arange(len(sizes)))]
    first, home, second = rest[top], part[top], np.full(len(sizes), -1, dtype=np.int64)
    other = part != home[at]
    np.maximum.at(second, at[other], rest[other])
    out = np.zeros(len(part), dtype=bool)
    step = max(1, (1 << 20) // len(sizes))
    for k in range(0, len(part), step):
        here = slice(k, k + step)
        theirs = np.where(part[here, None] == home, second, first)
        out[here] = (np.minimum(rest[here, None], theirs) >= _common(size[here, None], sizes, hundredths)).any(axis=1)
    return out


def _partners(least: float, matches: int):
    """Rows sorted by key: pairs (a, b, agree, done) of different parts that have a key and may be similar enough.

    Of a key with few such pairs, these are all (done). Of others, each row that may have partners is given once,
    with the most likely of some of them or with null.
    """
    hundredths = round(100 * least)

    def over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = None
        for batch in chain(batches, [None]):
            rows = batch if kept is None else kept if batch is None else pd.concat([kept, batch], ignore_index=True)
            if rows is None or not len(rows):
                continue
            key, vertex, part, size, rest = (rows[c].to_numpy(dtype=np.int64) for c in ("key", "vertex", "part", "size", "rest"))
            sketch = np.array(rows["sketch"].tolist(), dtype=np.int8)
            begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            # The last key may go on in the next batch.
            last = begins[-1] if batch is not None else len(key)
            kept = rows.iloc[last:]

            def agreeing(some: np.ndarray, others: np.ndarray) -> np.ndarray:
                agree = (sketch[some, None] == sketch[others]).sum(axis=2)
                fits = np.minimum(rest[some, None], rest[others]) >= _common(size[some, None], size[others], hundredths)
                return np.where(fits & (part[some, None] != part[others]) & (agree >= matches), agree, 0)

            pairs, rest_of = [], []
            for lo, hi in zip(begins, np.append(begins[1:], len(key))):
                if lo == last or part[lo:hi].min() == part[lo:hi].max():
                    continue
                may = np.arange(lo, hi)
                if len(may) > SIDE:
                    may = may[_may_have_partners(part[lo:hi], size[lo:hi], rest[lo:hi], hundredths)]
                # What is too much for one task is left to blocks.
                found, n = [], 0 if len(may) <= 16 * SIDE else PAIRS * len(may) + 1
                for k in range(0, len(may) if n == 0 else 0, SIDE):
                    for j in range(0, k + 1, SIDE):
                        agree = agreeing(may[k : k + SIDE], may[j : j + SIDE])
                        x, y = np.nonzero(np.tril(agree, -1) if j == k else agree)
                        found.append((vertex[may[k + x]], vertex[may[j + y]], agree[x, y]))
                        n += len(x)
                    if n > PAIRS * len(may):
                        break
                if n <= PAIRS * len(may):
                    pairs += found
                    continue
                for k in range(0, len(may), SIDE):
                    some = may[k : k + SIDE]
                    agree = agreeing(some, some)
                    best = agree.max(axis=1)
                    rest_of.append((vertex[some], vertex[some[agree.argmax(axis=1)]], best))
            for done, told in ((True, pairs), (False, rest_of)):
                if told:
                    a, b, agree = (np.concatenate(c) for c in zip(*told))
                    out = pd.DataFrame({"a": a, "b": pd.array(b, dtype="Int64"), "agree": agree, "done": done})
                    out.loc[out["agree"] == 0, "b"] = pd.NA
                    yield out

    return over


def partners(ranked: DataFrame, parts: DataFrame, least: float, matches: int, turn: int = 0) -> DataFrame:
    """(a, b, agree, done): pairs of vertices of different parts that may be similar enough.

    A vertex is in no pair with any that it is not given with, unless it is an a that is not done. ranked: vertex, sketch, size, key, rest;
    parts: vertex, part. If two sets are similar enough and the shingles of both are put in one order, they share one of
    their first few; in an order by frequency these are rare, so few others have them.
    """
    each = F.explode(F.arrays_zip("key", "rest")).alias("of")
    rows = ranked.join(parts, "vertex").select("vertex", "part", "size", "sketch", each).select("of.*", "vertex", "part", "size", "sketch")
    dealt = rows.repartition("key").sortWithinPartitions("key", F.xxhash64("vertex", F.lit(turn)))
    told = dealt.mapInPandas(_partners(least, matches), "a long, b long, agree int, done boolean")
    return told.groupBy("a", "b", "done").agg(F.max("agree").alias("agree"))


def settled(crowd: DataFrame, parts: DataFrame, width: int, least: float, matches: int, turns: int) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """The parts after links within a crowd (vertex, data, sketch), these links (a, b), and which vertices may have others still.

    Pairs of keys that have few are confirmed, and of the others' vertices each with its most likely partner of another
    part. This is done `turns` times at most; it makes no more pairs than some for each key of each vertex, however many
    are alike. Nothing is decided on vertices that are left: all their pairs are still to be compared.
    """
    shape = "vertex long, sketch array<tinyint>, size int, key array<long>, rest array<int>"
    ranked = written(crowd.mapInPandas(_rank(width, least, shingle_levels(crowd, width)), shape), "ranked")
    links = tried = None
    for turn in range(turns):
        told = written(partners(ranked, parts, least, matches, turn), "partners")
        best = told.where("not done and b is not null").groupBy("a").agg(F.max(F.struct("agree", "b")).alias("best")).select("a", "best.b")
        pairs = told.where("done").select("a", "b").unionByName(best)
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = written(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        found = written(confirmed(pairs, crowd.select("vertex", "data"), width, least), "links")
        tried = pairs if tried is None else tried.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        left = told.where("not done").select(F.col("a").alias("vertex")).distinct()
        if left.isEmpty():
            break
        parts = written(_joined(parts, found), "parts")
    return parts, links, left


def block_rows(visits: DataFrame, parts: DataFrame) -> DataFrame:
    """(block, vertex, is_guest, is_host): in which blocks each vertex is compared, once for each. visits: host, vertex; parts: vertex, part.

    Only ids are dealt here: members and guests to chunks by hash; each pair of chunks is a block.
    """
    sizes = parts.groupBy(F.col("part").alias("host")).agg(F.count(F.lit(1)).alias("n"))
    plans = visits.groupBy("host").agg(F.count(F.lit(1)).alias("n_guest")).join(sizes, "host", "left").select(
        "host",
        F.ceil((F.coalesce("n", F.lit(0)) + F.col("n_guest")) / HOSTS).alias("host_chunks"),
        F.ceil(F.col("n_guest") / GUESTS).alias("guest_chunks"),
    )
    own = parts.select(F.col("part").alias("host"), "vertex").join(plans, "host")
    guests = visits.select("host", "vertex").join(plans, "host")
    every = [F.sequence(F.lit(0).cast("long"), F.col(c) - 1) for c in ("host_chunks", "guest_chunks")]
    chunk = [F.pmod(F.xxhash64("vertex"), F.col(c)) for c in ("host_chunks", "guest_chunks")]
    as_guest = guests.select("host", "vertex", F.lit(True).alias("is_guest"), F.explode(every[0]).alias("h"), chunk[1].alias("g"))
    as_host = own.unionByName(guests).select("host", "vertex", F.lit(False).alias("is_guest"), chunk[0].alias("h"), F.explode(every[1]).alias("g"))
    rows = as_guest.unionByName(as_host).withColumn("block", F.xxhash64("host", "h", "g"))
    return rows.groupBy("block", "vertex").agg(F.max("is_guest").alias("is_guest"), F.max(~F.col("is_guest")).alias("is_host"))


def between_neighbours(met: DataFrame, texts: DataFrame, parts: DataFrame, width: int, least: float, matches: int, turns: int = 0) -> DataFrame:
    """Links (a, b) between groups that meet in some table, though no link was found so far.

    met: a, b, a_hub, b_hub; texts: vertex, data, sketch; parts: vertex, part. Whoever meets a hub of another group is
    a guest of the hub's group, whichever of the groups is larger. All guests of a group are compared with its members
    and with each other, so of two vertices in one bucket no pair is left out: each is the hub, of its group or its
    guest. This is done in blocks of bounded size: members and guests are dealt to chunks by hash, each pair of
    chunks is a block, and in a block only those of other groups with enough half keys in common are looked at.
    A text goes to a block once, whether as guest, as host or as both, and only when all blocks are known.

    Where a group and its guests need more than one block and there are turns, blocks grow with the square of their number. So of these
    only such go to blocks that share a rare shingle with one of another group, after likely partners have been linked
    (see settled); of the others, none has a similar one among them.
    """
    open_ = _across(met, parts, "a", "b", "a_hub", "b_hub")
    side = [F.when(F.col(f"{h}_hub"), F.struct(F.col(f"part_{h}").alias("host"), F.col(g).alias("vertex"))) for h, g in ("ab", "ba")]
    visits = written(open_.select(F.explode(F.array_compact(F.array(*side))).alias("of")).select("of.*").distinct(), "visits")
    texts = texts.select("vertex", "data", "sketch")
    members = parts.select(F.col("part").alias("host"), "vertex")
    there = visits.select("host", F.lit(1).alias("g")).unionByName(members.select("host", F.lit(0).alias("g")))
    crowded = there.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("g").alias("g")).where((F.col("g") > 0) & (F.col("n") > HOSTS))
    crowded = written(crowded.select("host"), "crowded")
    hosts, links = parts, None
    if turns and not crowded.isEmpty():
        crowd = visits.unionByName(members).join(crowded, "host", "left_semi").select("vertex").distinct()
        parts, links, left = settled(written(texts.join(crowd, "vertex"), "crowd"), parts, width, least, matches, turns)
        crowded, left = crowded.withColumn("crowded", F.lit(True)), left.withColumn("left", F.lit(True))
        visits, members = (
            each.join(crowded, "host", "left").join(left, "vertex", "left").where("crowded is null or left").select("host", "vertex")
            for each in (visits, members)
        )
        visits, hosts = written(visits, "visits"), members.withColumnRenamed("host", "part")
    rows = block_rows(visits, hosts).join(parts, "vertex").join(texts, "vertex")
    dealt = rows.repartition("block").sortWithinPartitions("block", "is_host", F.desc("is_guest"))
    found = dealt.mapInPandas(_compare(width, least, matches), "a long, b long")
    return (found if links is None else found.unionByName(links)).distinct()


def _across(pairs: DataFrame, parts: DataFrame, *columns: str) -> DataFrame:
    """Of the pairs (a, b), those that lead from part to part: part_a, part_b and these columns. parts: vertex, part."""
    both = pairs.join(parts.toDF("a", "part_a"), "a").join(parts.toDF("b", "part_b"), "b")
    return both.where("part_a <> part_b").select("part_a", "part_b", *columns)


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """The parts (vertex, part) after those between which there are links (a, b) became one; the others stay as they are."""
    across = _across(links, parts).select(F.least("part_a", "part_b").alias("a"), F.greatest("part_a", "part_b").alias("b"))
    merged = connected_components(across).toDF("part", "found")
    return parts.join(merged, "part", "left").select("vertex", F.coalesce("found", "part").alias("part"))


def near_copies(documents: DataFrame, width: int = 5, least: float = 0.8, banding: Banding | None = None, turns: int | None = None) -> DataFrame:
    """Groups of near copies among documents (doc_id, text).

    A document's set is its distinct runs of `width` words, lower-cased A-Z (all words as one run if
    there are fewer; empty without words). Documents are linked if their sets' Jaccard similarity is
    at least `least`; candidates come from tensored MinHash tables (see Banding) and every link
    is confirmed on the whole sets. Returns doc_id, n_shingles, component_id (the smallest doc_id that
    can be reached over links, itself included) and kept (component_id is doc_id).

    Documents with equal sets form one vertex, so copies make neither keys nor pairs. Of the
    candidates, each vertex's pair met in most tables is confirmed first, then each group's. Pairs that these links
    have joined already need no look. Where a hub was met by other groups, these are compared with its own and with each other
    (see between_neighbours); `turns`, unless given TURNS, are taken before large groups are, without changing the result.

    Null texts and texts without words are linked with nothing. Rows with the same doc_id are the same
    document. A null doc_id keeps the component of its equal texts, if those have an id, and else is
    its own (null, kept). An empty table gives no rows. Other columns are not read.
    """
    banding = banding or Banding()
    rows = in_small_batches(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = written(rows.mapInPandas(_sign(width, banding), SIGNED), "signed")
    filled = signed.where("n_shingles > 0")
    classes = written(
        filled.groupBy("set_id").agg(
            F.min("doc_id").alias("vertex"),
            F.min_by(F.struct("left", "right", "n_shingles"), F.coalesce("doc_id", F.lit(0))).alias("of"),
        ).select("set_id", "vertex", "of.left", "of.right", "of.n_shingles"),
        "classes",
    )
    # A byte of each half key, by which the half keys that two vertices share are counted.
    bytes_of = F.transform(F.concat("left", "right"), lambda x: x.bitwiseAND(127).cast("tinyint"))
    sketches = classes.select("vertex", "n_shingles", bytes_of.alias("sketch"))
    met = candidates(classes.where("vertex is not null"), banding)
    # Sets whose sizes differ too much, or that share too few half keys, can't be similar enough. Such a pair
    # is kept all the same: others that met the same hub may be similar.
    shared = F.size(F.filter(F.zip_with("sketch_a", "sketch_b", lambda x, y: x == y), lambda x: x))
    fits = (F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * round(100 * least)) & (
        shared >= banding.sure_matches(least)
    )
    met = written(
        met.join(sketches.toDF("a", "size_a", "sketch_a"), "a")
        .join(sketches.toDF("b", "size_b", "sketch_b"), "b")
        .select("a", "b", "tables", "a_hub", "b_hub", fits.alias("fits")),
        "pairs",
    )
    pairs = met.where("fits")
    involved = met.select(F.explode(F.array("a", "b")).alias("vertex")).distinct()
    # Only texts that may be involved are moved.
    texts = compact(sifted(rows, "doc_id", involved, "vertex").where("maybe")).withColumnRenamed("doc_id", "vertex")
    # What is involved grows with the documents, so it is never broadcast.
    texts = texts.join(involved.hint("merge"), "vertex").join(sketches.hint("merge"), "vertex")
    texts = written(texts.select("vertex", "data", "sketch"), "texts")
    best = (
        pairs.select(F.explode(F.array("a", "b")).alias("vertex"), "a", "b", "tables")
        .groupBy("vertex")
        .agg(F.max(F.struct("tables", "a", "b")).alias("best"))
        .select("best.a", "best.b")
        .distinct()
    )
    links = written(confirmed(best, texts.select("vertex", "data"), width, least), "links")
    found = connected_components(links)
    parts = texts.select("vertex").join(found, "vertex", "left")
    parts = written(parts.select("vertex", F.coalesce("component", "vertex").alias("part")), "parts")
    # The pair met most often that leads out of a group is looked at next: one for each group, not all.
    leading = _across(pairs, parts, "tables", "a", "b")
    next_best = leading.select(F.explode(F.array("part_a", "part_b")).alias("part"), "tables", "a", "b").groupBy("part").agg(
        F.max(F.struct("tables", "a", "b")).alias("best")
    )
    links = written(confirmed(next_best.select("best.a", "best.b").distinct(), texts.select("vertex", "data"), width, least), "links")
    parts = written(_joined(parts, links), "parts")
    found = _joined(parts, between_neighbours(met, texts, parts, width, least, banding.sure_matches(least), TURNS if turns is None else turns))
    found = found.withColumnRenamed("part", "found")
    groups = classes.select("set_id", "vertex").join(found, "vertex", "left").select(
        "set_id", F.coalesce("found", "vertex").alias("component")
    )
    joined = signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("set_id")).alias("set_id")).join(
        groups, "set_id", "left"
    )
    component = F.coalesce("component", "doc_id")
    return joined.select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )
