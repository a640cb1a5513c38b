"""A sieve for rows too wide to be moved: most of those that a join would not touch are told apart where they lie."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Of the sieve, whatever the tables: 2 MB.
BITS = 1 << 24
#: Of each of the bitmaps that Spark makes.
PART = 1 << 15


def _place(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(BITS))


def sifted(rows: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """The rows with a column `maybe`: false only if the row's key is surely not among the wanted ones (whole numbers).

    Each wanted key sets one bit, chosen by hash. The bits are broadcast; their size is fixed, so where the wanted
    keys are many, more rows are taken for wanted, and none that is wanted is missed. What to do with those that may
    be wanted is for an exact join to say, which has to move these rows only.
    """
    at = wanted.select(_place(wanted_key).alias("at"))
    bits = at.groupBy(F.floor(F.col("at") / PART).alias("sieve_part")).agg(
        F.bitmap_construct_agg(F.pmod("at", F.lit(PART))).alias("sieve_bits")
    )
    place = _place(key)
    here = F.pmod(place, F.lit(PART))
    byte = F.substr("sieve_bits", (F.floor(here / 8) + 1).cast("int"), F.lit(1))
    hit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(here, F.lit(8)).cast("int")) == 1
    met = rows.withColumn("sieve_part", F.floor(place / PART)).join(F.broadcast(bits), "sieve_part", "left")
    return met.select(*rows.columns, F.coalesce(hit, F.lit(False)).alias("maybe"))
