"""Ranks, quantiles and tiles over a whole table without a whole-table sort.

A global window would move every row into one task. Here rows are first reduced to
counts per distinct value; only those counts are ordered, cell by cell, and the few
rows that sit on a boundary are told apart by a uniform hash of their identifier. Cells are cut at
sampled values, so they hold about as many distinct values each, wherever these lie.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

# Leading hex digits of a tie key that name its block: 65,536 blocks of even size.
BLOCK_DIGITS = 4
# Values sampled to cut cells; a power of two less one, so that halving finds a cell.
CUTS = 1023


def tie_key(identifier: Column, seed: str = "") -> Column:
    """A uniform, reproducible total order over identifiers."""
    text = F.coalesce(identifier.cast("string"), F.lit(""))
    salted = F.concat(F.lit(f"{seed}|"), text) if seed else text
    return F.concat(F.md5(salted), text)


def _before(by: Sequence[str], order: str, amount: str) -> Column:
    """Sum of ``amount`` over the earlier rows of the group (NULLs are ordered last)."""
    window = (
        Window.partitionBy(*by)
        .orderBy(F.col(order).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(amount).over(window), F.lit(0).cast("bigint"))


def _match(keys: Sequence[str]) -> Column:
    """Null-safe equality of the keys of two frames aliased ``l`` and ``r``."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}"))
    return condition


def _left(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"l.{c}") for c in columns]


def counted(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``n`` per distinct value of each group; the only step in which rows themselves are moved."""
    return df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def with_cell(counts: DataFrame, value: str, cuts: int = CUTS) -> DataFrame:
    """Add ``cell``, which never decreases with the value; NULL values have none.

    Cells are cut at the values of the ``cuts`` rows with the smallest hash, an even sample of the distinct values of all
    groups together. The same rows always give the same cells, however often and wherever they are computed. With fewer
    distinct values every value is a cell.
    """
    # All columns and rows, also of unknown values, which the list leaves out: so the sample reads the very counts
    # that are placed, and these are made once.
    sample = counts.select(value, F.xxhash64(*counts.columns).alias("_hash")).orderBy("_hash", value).limit(cuts)
    edges = sample.agg(F.array_sort(F.collect_list(value))).scalar()
    steps = [1 << k for k in reversed(range(cuts.bit_length()))]

    def further(at: Column, step: Column) -> Column:
        """Past the next ``step`` edges, if the last of them is no larger than the value."""
        return F.when(F.get(F.col("_edges"), at + step - 1) <= F.col(value), at + step).otherwise(at)

    cell = F.aggregate(F.array(*[F.lit(step) for step in steps]), F.lit(0), further)
    placed = counts.withColumn("_edges", F.coalesce(edges, F.array().cast(counts.select(F.array(value)).schema[0].dataType)))
    return placed.withColumn("cell", F.when(F.col(value).isNotNull(), cell)).drop("_edges")


def rank_index(counts: DataFrame, value: str, by: Sequence[str] = (), cuts: int = CUTS) -> DataFrame:
    """Per distinct value of ``counts``: ``n``, the rows ``start`` before it and the group's ``total``.

    counts: a row for each group and value, with its number of rows ``n``. The running count is taken over cells
    first and inside each cell second, so no task orders more than the cells of a group or the distinct values of a cell.
    """
    by = list(by)
    placed = with_cell(counts, value, cuts)
    cells = (
        placed.groupBy(*by, "cell")
        .agg(F.sum("n").alias("cell_n"))
        .withColumn("cell_start", _before(by, "cell", "cell_n"))
        .withColumn("total", F.sum("cell_n").over(Window.partitionBy(*by)))
    )
    inside = placed.withColumn("inside", _before([*by, "cell"], value, "n"))
    return inside.alias("l").join(cells.alias("r"), _match([*by, "cell"])).select(
        *_left([*by, value]),
        "n",
        (F.col("cell_start") + F.col("inside")).alias("start"),
        "total",
    )


def value_positions(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """The rank index of the values of a column."""
    return rank_index(counted(df, value, by), value, by)


def quantiles_of(counts: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles of counted values with linear interpolation, one column per named probability.

    Unknown values count as no rows; a group of nothing else has no row.
    """
    # Not a filter, which would be pushed below the counts and have them made once more.
    positions = rank_index(counts.withColumn("n", F.when(F.col(value).isNotNull(), F.col("n")).otherwise(0)), value, by)
    number = F.col(value).cast("double")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("start") <= rank) & (rank < F.col("start") + F.col("n")), number))

    measures = []
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (F.col("total") - 1)
        measures += [
            at(F.floor(place)).alias(f"{name}_low"),
            at(F.ceil(place)).alias(f"{name}_high"),
            F.max(place - F.floor(place)).alias(f"{name}_part"),
        ]
    return (
        positions.groupBy(*by)
        .agg(*measures, F.max("total").alias("_rows"))
        .where(F.col("_rows") > 0 if by else F.lit(True))
        .select(
            *by,
            *[
                (
                    F.col(f"{name}_low")
                    + (F.col(f"{name}_high") - F.col(f"{name}_low")) * F.col(f"{name}_part")
                ).alias(name)
                for name in probabilities
            ],
        )
    )


def quantiles(df: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles of a column."""
    return quantiles_of(counted(df, value, by), value, probabilities, by)


def cut_keys(
    df: DataFrame, by: str, identifier: str, ranks: Sequence[tuple[object, int]], seed: str = ""
) -> dict[tuple[object, int], str]:
    """The tie key at each wanted ``(group, 1-based rank)`` of the groups' hash order.

    Rows are counted per hash block and only the blocks that hold a wanted rank are ordered,
    each by its own task and by distinct key, so copies of a row collapse before they meet. The
    driver sees one row per wanted rank, never a group. Copies share a key and stay together.
    """
    if not ranks:
        return {}

    def any_of(conditions: Sequence[Column]) -> Column:
        return reduce(Column.__or__, conditions)

    group = F.col(by)
    groups = list(dict.fromkeys(value for value, _ in ranks))
    tied = (
        df.where(any_of([group.eqNullSafe(F.lit(value)) for value in groups]))
        .withColumn("tie", tie_key(F.col(identifier), seed))
        .select(by, "tie", F.substring("tie", 1, BLOCK_DIGITS).alias("block"))
    )
    start, end = F.col("start"), F.col("start") + F.col("n")
    blocks = (
        tied.groupBy(by, "block")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("start", _before([by], "block", "n"))
        .where(
            any_of([group.eqNullSafe(F.lit(v)) & (start < rank) & (F.lit(rank) <= end) for v, rank in ranks])
        )
        .collect()
    )
    found = {}
    if not blocks:
        return found

    def in_block(row: Row) -> Column:
        return group.eqNullSafe(F.lit(row[by])) & (F.col("block") == row["block"])

    keys = (
        tied.where(any_of([in_block(row) for row in blocks]))
        .groupBy(by, "block", "tie")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("start", _before([by, "block"], "tie", "n"))
    )
    targets = [
        (row, value, rank)
        for row in blocks
        for value, rank in ranks
        if row[by] == value and row["start"] < rank <= row["start"] + row["n"]
    ]
    holds = [in_block(row) & (start < rank - row["start"]) & (F.lit(rank - row["start"]) <= end) for row, _, rank in targets]
    for key in keys.where(any_of(holds)).collect():
        for row, value, rank in targets:
            same_block = row[by] == key[by] and row["block"] == key["block"]
            if same_block and key["start"] < rank - row["start"] <= key["start"] + key["n"]:
                found[value, rank] = key["tie"]
    return found


def tile_end(tile: Column, total: Column, tiles: int) -> Column:
    """Last rank of a tile when ``total`` rows go into ``tiles`` of near-equal size."""
    rest = total % F.lit(tiles)
    return tile * ((total - rest) / F.lit(tiles)).cast("bigint") + F.least(tile, rest)


def tile_cuts(df: DataFrame, tiles: int, value: str, identifier: str) -> list[tuple[object, str]]:
    """The (value, tie key) of the last row of every tile but the final one."""
    keys = df.select(value, identifier)
    wanted = (
        value_positions(keys, value)
        .withColumn("cut", F.explode(F.sequence(F.lit(1), F.lit(tiles - 1))))
        .withColumn("rank", tile_end(F.col("cut"), F.col("total"), tiles) - F.col("start"))
        .where((F.col("rank") > 0) & (F.col("rank") <= F.col("n")))
        .orderBy("cut")
        .select(value, "rank")
        .collect()
    )
    ranks = [(row[0], row[1]) for row in wanted]
    found = cut_keys(keys, value, identifier, ranks)
    return [(pair[0], found[pair]) for pair in ranks]


def with_ntile(df: DataFrame, tiles: int, value: str, identifier: str, output: str) -> DataFrame:
    """Add ``ntile(tiles)`` in the order of ``value``, ties in hash order of ``identifier``.

    Only the ``tiles - 1`` rows that end a tile are searched for; every row is then placed
    by comparing it with them, so the table itself is never shuffled.
    """
    order, tie = F.col(value), tie_key(F.col(identifier))
    tile = F.lit(1)
    for last, last_tie in tile_cuts(df, tiles, value, identifier) if tiles > 1 else []:
        end = F.lit(last)
        later = F.coalesce(order > end, order.isNull() & end.isNotNull())
        tile = tile + F.when(later | (order.eqNullSafe(end) & (tie > last_tie)), 1).otherwise(0)
    return df.withColumn(output, tile)
