"""The stored joint aggregate: one row for each combination of categories and tenure that occurs.

Its size is bounded by the domains of the columns, not by the number of customers. Questions are rolled up from it.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayrate.functions.measures import CHARGED, CHARGES, CUSTOMERS
from stayrate.schema import PROTECTIVE_ADD_ONS

DIMENSIONS = [
    "churn", "gender", "senior_citizen", "partner", "dependents", "paperless_billing",
    "contract_type", "payment_method", "internet_service", *PROTECTIVE_ADD_ONS, "tenure_months",
]


def joint_aggregate(df: DataFrame, dimensions: Sequence[str] = tuple(DIMENSIONS)) -> DataFrame:
    """Customers, those with a known charge, and their charges, for each combination of the dimensions."""
    return df.groupBy(*dimensions).agg(
        F.count(F.lit(1)).alias(CUSTOMERS), F.count("monthly_charges").alias(CHARGED), F.sum("monthly_charges").alias(CHARGES)
    )


def counted_customers(df: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Customers for each combination of the dimensions: what histograms and densities of these need."""
    return df.groupBy(*dimensions).agg(F.count(F.lit(1)).alias(CUSTOMERS))


# --- moments ---------------------------------------------------------------


def _is_dimension(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (T.BooleanType, T.IntegralType))


def _exact(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    return F.col(column) if isinstance(kind, T.DecimalType) else F.col(column).cast("double")


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """n, and the sums of a, b, a * a, b * b and a * b over the rows in which both are known, for each pair of columns.

    Booleans (as 0 and 1) and whole numbers are dimensions: rows are counted per combination of them, with sums and
    products of the amounts beside. Pairs are read off these cells, so rows pass one aggregate of a few sums, which may be
    merged in any order. Decimals are summed exactly.
    """
    dimensions = [c for c in columns if _is_dimension(df, c)]
    amounts = [c for c in columns if c not in dimensions]
    sums = [F.count(F.lit(1)).alias("_n")]
    sums += [F.sum(_exact(df, a)).alias(f"_{a}") for a in amounts]
    sums += [
        F.sum(_exact(df, a) * _exact(df, b)).alias(f"_{a}_{b}") for i, a in enumerate(amounts) for b in amounts[i:]
    ]
    # A cell holds rows of one pattern of unknown amounts, so its sums are over all its rows or none.
    known = [F.col(a).isNotNull().alias(f"_known_{a}") for a in amounts]
    cells = df.groupBy(*dimensions, *known).agg(*sums)

    def value(c: str) -> Column:
        return F.col(c).cast("int").cast("double")

    def of(per_dimension, per_amount) -> Column:
        return F.array(*[per_dimension(c) if c in dimensions else per_amount(c) for c in columns])

    def cross(a: str, b: str) -> Column:
        both = sorted((c for c in (a, b) if c in amounts), key=amounts.index)
        return F.col(f"_{both[0]}_{both[1]}").cast("double") if len(both) == 2 else F.lit(None).cast("double")

    n, size = F.col("_n").cast("double"), len(columns)
    vectors = cells.select(
        n.alias("_n"),
        of(lambda c: F.col(c).isNotNull(), lambda c: F.col(f"_known_{c}")).alias("known"),
        of(value, lambda c: F.lit(None).cast("double")).alias("values"),
        of(lambda c: value(c) * n, lambda c: F.col(f"_{c}").cast("double")).alias("sums"),
        of(lambda c: value(c) * value(c) * n, lambda c: F.col(f"_{c}_{c}").cast("double")).alias("squares"),
        F.array(*[cross(a, b) for a in columns for b in columns]).alias("crosses"),
    )
    places = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in combinations(range(size), 2)])
    pairs = vectors.select("*", F.inline(places))
    at = lambda name, place: F.get(F.col(name), F.col(place))
    # A cell's rows share the value of a dimension, so it comes before the other column's sum.
    products = F.coalesce(
        at("values", "i") * at("sums", "j"), at("sums", "i") * at("values", "j"), F.get("crosses", F.col("i") * size + F.col("j"))
    )
    both = at("known", "i") & at("known", "j")
    measures = {
        "n": F.col("_n"), "sa": at("sums", "i"), "sb": at("sums", "j"),
        "saa": at("squares", "i"), "sbb": at("squares", "j"), "sab": products,
    }
    found = pairs.groupBy("i", "j").agg(*[F.sum(F.when(both, v).otherwise(0.0)).alias(k) for k, v in measures.items()])
    names = F.array(*[F.lit(c) for c in columns])
    return found.select(F.get(names, F.col("i")).alias("column_a"), F.get(names, F.col("j")).alias("column_b"), *measures)


def correlation() -> Column:
    """Pearson's from moments; NULL where a column doesn't vary."""
    apart = F.col("n") * F.col("sab") - F.col("sa") * F.col("sb")
    spread = (F.col("n") * F.col("saa") - F.pow("sa", F.lit(2))) * (F.col("n") * F.col("sbb") - F.pow("sb", F.lit(2)))
    return F.try_divide(apart, F.sqrt(F.greatest(spread, F.lit(0.0))))
