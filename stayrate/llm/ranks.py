"""Numbering rows within groups of any size, without all rows of a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cells_for(rows: int) -> int:
    """How many cells to deal rows to: as many cells as rows in a cell, so both stay small."""
    return max(1, int(rows**0.5) + 1)


def hash_cell(hexadecimal: Column, cells: int) -> Column:
    """The cell, 0 to cells - 1, of an evenly spread hexadecimal hash; cells follow its order."""
    number = F.conv(F.substring(hexadecimal, 1, 8), 16, 10).cast("long")
    return F.floor(number * F.lit(cells) / F.lit(2**32)).cast("long")


def numbered(df: DataFrame, group: str, cell: str, order: list[str], rank: str, total: str) -> DataFrame:
    """Adds `rank`, from 0 within each group by (cell, *order), and `total`, the group's rows.

    `cell` must not decrease along the order and must be spread evenly within a group. Counts per
    cell give every cell its first rank; only the rows of one cell are ever sorted together, so
    a group with a third of all rows is as harmless as any other. `group` and `cell` are not null.
    """
    counts = df.groupBy(group, cell).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(group)
    starts = counts.select(
        group,
        cell,
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias(total),
    )
    place = F.row_number().over(Window.partitionBy(group, cell).orderBy(*order)).cast("long")
    return (
        df.join(starts, [group, cell])
        .withColumn(rank, place - 1 + F.col("_before"))
        .drop("_before")
    )
