"""Measures over customers, or over cells of a joint aggregate that stand for many customers each.

A joint aggregate (`operators.joint`) has the dimensions of customers and, in place of its amounts, their counts and
sums. Every measure here is a sum or a count, so it is read off either, and a question put to the one can be put to the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.rates import as_int, mean, money, percent

CUSTOMERS, CHARGED, CHARGES = "_customers", "_charged", "_charges"


def is_joint(df: DataFrame) -> bool:
    return CUSTOMERS in df.columns


def weight(df: DataFrame) -> Column:
    """How many customers a row stands for."""
    return F.col(CUSTOMERS) if is_joint(df) else F.lit(1)


def n_customers(df: DataFrame) -> Column:
    return F.sum(CUSTOMERS) if is_joint(df) else F.count(F.lit(1))


def n_where(df: DataFrame, condition: Column) -> Column:
    """Customers for whom the condition holds."""
    return F.sum(F.when(condition, F.col(CUSTOMERS)).otherwise(0)) if is_joint(df) else F.sum(as_int(condition))


def churned(df: DataFrame) -> Column:
    return n_where(df, F.col("churn"))


def charges(df: DataFrame) -> Column:
    return F.sum(CHARGES if is_joint(df) else "monthly_charges")


def charges_where(df: DataFrame, condition: Column) -> Column:
    """The charges of customers for whom the condition holds."""
    return F.sum(F.when(condition, F.col(CHARGES if is_joint(df) else "monthly_charges")).otherwise(0))


def churn_rate(df: DataFrame) -> Column:
    return percent(churned(df), n_customers(df)).alias("churn_rate_pct")


def revenue(df: DataFrame) -> Column:
    return money(charges(df)).alias("total_monthly_revenue")


def avg_charges(df: DataFrame) -> Column:
    n = F.sum(CHARGED) if is_joint(df) else F.count("monthly_charges")
    return mean(charges(df), n).alias("avg_monthly_charges")


def total_of(df: DataFrame, dimension: str) -> Column:
    """The sum of a numeric dimension over customers."""
    return F.sum(F.col(dimension) * weight(df))


def known_of(df: DataFrame, dimension: str) -> Column:
    """Customers of whom a dimension is known."""
    return F.sum(F.when(F.col(dimension).isNotNull(), weight(df)).otherwise(0))


def avg_tenure(df: DataFrame) -> Column:
    return mean(total_of(df, "tenure_months"), known_of(df, "tenure_months"), 1).alias("avg_tenure_months")
