"""Cleaning: fill, trim, keep the first of repeated ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.schema import TEXT_COLUMNS, WHITESPACE


def unbilled() -> Column:
    """New customers without a bill yet: no total and no tenure."""
    return F.col("total_charges").isNull() & (F.col("tenure_months") == 0)


def fill_total_charges(df: DataFrame) -> DataFrame:
    """total_charges becomes 0 for customers not billed yet; other NULLs stay."""
    zero = F.lit(0).cast(df.schema["total_charges"].dataType)
    return df.withColumn("total_charges", F.when(unbilled(), zero).otherwise(F.col("total_charges")))


def fill_report(df: DataFrame) -> DataFrame:
    """How many rows the fill changes."""
    return df.agg(F.count_if(unbilled()).alias("updated_rows"))


def trim_text(df: DataFrame) -> DataFrame:
    """Strip white space of any kind around the category texts."""
    return df.withColumns({c: F.btrim(F.col(c), F.lit(WHITESPACE)) for c in TEXT_COLUMNS})


def keep_first(df: DataFrame, order: str = "seq") -> DataFrame:
    """The first row of each customer_id.

    ``row_number() = 1`` lets the optimizer drop repeats before the shuffle as well, so an id
    that fills a large part of the table leaves one row per input task.
    """
    place = F.row_number().over(Window.partitionBy("customer_id").orderBy(order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def dedup_report(df: DataFrame) -> DataFrame:
    """Rows before and after keeping the first of each id, and rows dropped."""
    per_id = df.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"), F.count(F.lit(1)).alias("rows_after")
    ).withColumn("dropped_rows", F.col("rows_before") - F.col("rows_after"))


def clean(df: DataFrame, order: str = "seq") -> DataFrame:
    """Fill, trim and deduplicate."""
    return keep_first(trim_text(fill_total_charges(df)), order)
