"""Business questions about churn and revenue.

Every answer is one partial-and-final hash aggregate over a pruned scan. Questions that ask
for several dimensions at once aggregate over all of them together first, which leaves a few
hundred rows, and only those are unfolded into long form. A question can be put to customers or to their stored joint
aggregate (`operators.joint`); only the spend quartiles need the customers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.measures import (
    avg_charges,
    avg_tenure,
    charges,
    charges_where,
    churn_rate,
    churned,
    n_customers,
    revenue,
)
from stayrate.functions.ranks import with_ntile
from stayrate.functions.rates import money, percent
from stayrate.schema import (
    ANNUAL_CONTRACTS,
    AUTOPAY_METHODS,
    PROTECTIVE_ADD_ONS,
    TENURE_BUCKETS,
    TENURE_TOP,
)


def summarise(df: DataFrame, dims: Sequence[str | Column], *measures: Column, min_customers: int = 0) -> DataFrame:
    """Customers and further measures per group, for groups of at least ``min_customers``."""
    result = df.groupBy(*dims).agg(n_customers(df).alias("customers"), *measures)
    return result.where(F.col("customers") >= min_customers) if min_customers else result


def churn_rate_by(df: DataFrame, *dims: str | Column, measures: Sequence[Column] = (), min_customers: int = 0) -> DataFrame:
    """Customers and churn rate per group, highest rate first."""
    result = summarise(df, dims, *measures, churn_rate(df), min_customers=min_customers)
    return result.orderBy(F.col("churn_rate_pct").desc_nulls_first())


def churn_rate_long(df: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Churn rate per value of each of several low-cardinality columns, in long form, in one scan."""
    counts = df.groupBy(*columns).agg(n_customers(df).alias("n"), churned(df).alias("churned"))
    texts = counts.select(*[F.col(c).cast("string").alias(c) for c in columns], "n", "churned")
    return (
        texts.unpivot(["n", "churned"], list(columns), name, value)
        .groupBy(name, value)
        .agg(F.sum("n").alias("customers"), percent(F.sum("churned"), F.sum("n")).alias("churn_rate_pct"))
        .orderBy(name, F.col(value).asc_nulls_last())
    )


# --- customers -------------------------------------------------------------


def overall_churn(df: DataFrame) -> DataFrame:
    return df.agg(
        n_customers(df).alias("total_customers"), churned(df).alias("churned_customers"), churn_rate(df)
    )


def churn_by_demographics(df: DataFrame) -> DataFrame:
    return churn_rate_long(df, ["gender", "senior_citizen", "partner", "dependents"], "dimension", "value")


def tenure_by_churn(df: DataFrame) -> DataFrame:
    return summarise(df, ["churn"], avg_tenure(df)).orderBy("churn")


# --- revenue ---------------------------------------------------------------


def revenue_totals(df: DataFrame) -> DataFrame:
    return df.agg(revenue(df), avg_charges(df))


def revenue_lost(df: DataFrame) -> DataFrame:
    gone, kept = charges_where(df, F.col("churn")), charges_where(df, ~F.col("churn"))
    return df.agg(
        money(gone).alias("churned_monthly_revenue"),
        money(kept).alias("retained_monthly_revenue"),
        percent(gone, charges(df)).alias("pct_revenue_from_churned"),
    )


def revenue_by_contract(df: DataFrame) -> DataFrame:
    return summarise(df, ["contract_type"], revenue(df), avg_charges(df)).orderBy(F.desc("total_monthly_revenue"))


# --- contract and payment --------------------------------------------------


def churn_by_contract(df: DataFrame) -> DataFrame:
    return churn_rate_by(df, "contract_type", measures=[churned(df).alias("churned")])


def tenure_by_contract(df: DataFrame) -> DataFrame:
    return df.groupBy("contract_type").agg(avg_tenure(df)).orderBy(F.desc("avg_tenure_months"))


def churn_by_payment(df: DataFrame) -> DataFrame:
    return churn_rate_by(df, "payment_method", measures=[churned(df).alias("churned")])


def churn_by_paperless(df: DataFrame) -> DataFrame:
    return summarise(df, ["paperless_billing"], churn_rate(df))


def risk_segment() -> Column:
    monthly = (F.col("contract_type") == "Month-to-month") & (F.col("payment_method") == "Electronic check")
    committed = F.col("contract_type").isin(ANNUAL_CONTRACTS) & F.col("payment_method").isin(AUTOPAY_METHODS)
    return (
        F.when(monthly, "Month-to-month + Electronic check")
        .when(committed, "Annual+ contract + Autopay")
        .otherwise("Other")
    )


def churn_by_risk_segment(df: DataFrame) -> DataFrame:
    return churn_rate_by(df, risk_segment().alias("segment"))


# --- services --------------------------------------------------------------


def churn_by_internet(df: DataFrame) -> DataFrame:
    return churn_rate_by(df, "internet_service", measures=[avg_charges(df)])


def churn_by_add_on(df: DataFrame) -> DataFrame:
    """Among internet customers; an unknown internet service is left out, as SQL's ``!=`` does."""
    return churn_rate_long(df.where(F.col("internet_service") != "No"), PROTECTIVE_ADD_ONS, "add_on", "status")


# --- segments --------------------------------------------------------------


def tenure_bucket() -> Column:
    """Right-closed tenure buckets; an unknown tenure falls through to the last, as in SQL CASE."""
    tenure = F.col("tenure_months")
    (edge, label), *rest = TENURE_BUCKETS
    bucket = F.when(tenure <= edge, label)
    for edge, label in rest:
        bucket = bucket.when(tenure <= edge, label)
    return bucket.otherwise(TENURE_TOP)


def churn_by_tenure_bucket(df: DataFrame) -> DataFrame:
    rows = summarise(
        df, [tenure_bucket().alias("tenure_bucket")], churn_rate(df), F.min("tenure_months").alias("_from")
    )
    return rows.orderBy(F.col("_from").asc_nulls_last()).drop("_from")


def spend_quartiles(df: DataFrame) -> DataFrame:
    """Customers with the quartile of their monthly charge."""
    columns = df.select("customer_id", "monthly_charges", "churn")
    return with_ntile(columns, 4, "monthly_charges", "customer_id", "spend_quartile")


def churn_by_spend_quartile(df: DataFrame) -> DataFrame:
    rows = spend_quartiles(df)
    return summarise(
        rows,
        ["spend_quartile"],
        money(F.min("monthly_charges")).alias("min_monthly_charges"),
        money(F.max("monthly_charges")).alias("max_monthly_charges"),
        churn_rate(rows),
    ).orderBy("spend_quartile")


def churn_matrix(df: DataFrame, min_customers: int = 20) -> DataFrame:
    """Contract by payment method, without cells too small for a stable rate."""
    return churn_rate_by(df, "contract_type", "payment_method", min_customers=min_customers)
