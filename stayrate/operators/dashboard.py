"""The datasets behind the dashboard pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayrate.functions.measures import charges, churn_rate, n_customers
from stayrate.functions.rates import money, percent
from stayrate.operators.eda import histogram
from stayrate.operators.metrics import churn_rate_long
from stayrate.schema import CUSTOMER_COLUMNS, RECOMMENDATION_COLUMNS

SCORE_COLUMNS = [c for c in RECOMMENDATION_COLUMNS if c not in ("customer_id", "monthly_charges")]
BREAKDOWNS = ["contract_type", "payment_method", "internet_service", "gender", "senior_citizen"]


def customer_dashboard(customers: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Every customer with their recommendation; those who left have NULLs there."""
    scores = recommendations.select("customer_id", *SCORE_COLUMNS)
    return customers.select(*CUSTOMER_COLUMNS).join(scores, "customer_id", "left")


def apply_slicers(df: DataFrame, filters: Mapping[str, Sequence[object]] | None) -> DataFrame:
    """Keep rows whose columns hold one of the chosen values."""
    for column, values in (filters or {}).items():
        df = df.where(F.col(column).isin(list(values)))
    return df


def _total(column: str) -> Column:
    """The sum of a money column, to the cent; exact, so it does not depend on the order of rows."""
    return F.round(F.sum(F.col(column).cast("decimal(24,8)")), 2).cast("double").alias(column)


def sliced_histogram(
    dashboard: DataFrame, value: str, bins: int, filters: Mapping[str, Sequence[object]] | None = None
) -> DataFrame:
    """The distribution of a charge or of tenure, by churn, under the slicers."""
    return histogram(apply_slicers(dashboard, filters), value, bins)


def kpi_cards(dashboard: DataFrame, threshold: float | Column) -> DataFrame:
    """Customers, churn rate, revenue, revenue at risk and customers at or above the threshold."""
    return dashboard.agg(
        n_customers(dashboard).alias("total_customers"),
        churn_rate(dashboard),
        money(charges(dashboard)).alias("monthly_revenue"),
        _total("revenue_at_risk"),
        F.count_if(F.col("churn_probability") >= threshold).alias("high_risk_customers"),
    )


def contract_mix(dashboard: DataFrame) -> DataFrame:
    """Customers per contract type and their share of all."""
    counts = dashboard.groupBy("contract_type").agg(n_customers(dashboard).alias("customers"))
    whole = counts.agg(F.sum("customers")).scalar()
    return counts.withColumn("share_pct", percent(F.col("customers"), whole)).orderBy(
        F.desc("customers"), "contract_type"
    )


def churn_breakdowns(dashboard: DataFrame, filters: Mapping[str, Sequence[object]] | None = None) -> DataFrame:
    """Churn rate by contract, payment, internet, gender and age group under the slicers."""
    return churn_rate_long(apply_slicers(dashboard, filters), BREAKDOWNS, "dimension", "value")


def worklist(
    recommendations: DataFrame,
    filters: Mapping[str, Sequence[object]] | None = None,
    sort_by: str = "churn_probability",
    descending: bool = True,
    limit: int | None = None,
) -> DataFrame:
    """Scored customers, filtered and sorted as asked, ids in order among equals."""
    key = F.col(sort_by).desc_nulls_last() if descending else F.col(sort_by).asc_nulls_last()
    rows = apply_slicers(recommendations, filters).orderBy(key, "customer_id")
    return rows if limit is None else rows.limit(limit)


PAGE_ROWS = 50
#: The low bits of monotonically_increasing_id count rows within a partition.
_ROW_BITS = 33


def write_pages(
    recommendations: DataFrame,
    path: str,
    filters: Mapping[str, Sequence[object]] | None = None,
    sort_by: str = "churn_probability",
    descending: bool = True,
    page_rows: int = PAGE_ROWS,
) -> None:
    """Store the worklist in its order with ``rank``, from 1, and ``page``, from 0, so that a page is read by its key.

    Rows are sorted by ranges, each range by its own task, and counts per range say at which rank it begins. A file
    holds neighbouring pages, so a reader skips all files and row groups but those of its page. Rows that agree in
    the sorting column and in customer_id may stand in either order.
    """
    spark = recommendations.sparkSession
    key = F.col(sort_by).desc_nulls_last() if descending else F.col(sort_by).asc_nulls_last()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = apply_slicers(recommendations, filters)
    ranged = (
        rows.repartitionByRange(parts, key, "customer_id")
        .sortWithinPartitions(key, "customer_id")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    # Written before it is counted, so that ranges can't be cut anew in between.
    ranged.write.mode("overwrite").parquet(f"{path}/ranges")
    placed = spark.read.schema(ranged.schema).parquet(f"{path}/ranges").withColumn("_range", F.shiftright("_place", _ROW_BITS))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row a range; there are no more ranges than partitions.
    starts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    rank = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + F.col("_before") + 1
    paged = (
        placed.join(F.broadcast(starts), "_range")
        .withColumn("rank", rank)
        .withColumn("page", F.floor((F.col("rank") - 1) / page_rows))
        .select(*rows.columns, "rank", "page")
    )
    paged.sortWithinPartitions("rank").write.mode("overwrite").parquet(f"{path}/pages")


def read_page(spark: SparkSession, path: str, page: int) -> DataFrame:
    """One page of a stored worklist, in order; a page beyond the last is empty."""
    return spark.read.parquet(f"{path}/pages").where(F.col("page") == page).orderBy("rank")


def worklist_totals(recommendations: DataFrame) -> DataFrame:
    """Customers flagged, their revenue at risk and the expected net benefit of offers to them."""
    flagged = F.col("recommended_action") != "No Action"
    return recommendations.where(flagged).agg(
        n_customers(recommendations).alias("flagged_customers"),
        _total("revenue_at_risk"),
        _total("expected_net_benefit"),
    )
