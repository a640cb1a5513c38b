"""Features derived from what is known of a customer before they leave.

Cut points (a median and two terciles) are fitted apart from being applied, so they can come
from the training rows alone; fitting on all rows and applying to the same is one call more.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.functions.ranks import quantiles
from stayrate.functions.rates import flag
from stayrate.operators.metrics import tenure_bucket
from stayrate.schema import AUTOPAY_METHODS, REVENUE_LABELS, SERVICE_ADD_ONS

_POINTS = {"lowest": 0.0, "third": 1 / 3, "median": 0.5, "two_thirds": 2 / 3, "highest": 1.0}


@dataclass(frozen=True)
class FeatureCuts:
    """The fitted cut points."""

    median_total_charges: float | None
    low_monthly_charges: float
    high_monthly_charges: float

    def to_frame(self, spark: SparkSession) -> DataFrame:
        schema = "median_total_charges double, low_monthly_charges double, high_monthly_charges double"
        return spark.createDataFrame([tuple(asdict(self).values())], schema)

    @classmethod
    def from_frame(cls, frame: DataFrame) -> FeatureCuts:
        return cls(**frame.first().asDict())


def charge_points(df: DataFrame, exact: bool = True, accuracy: int = 1_000_000) -> DataFrame:
    """Minimum, terciles, median and maximum of both charge columns, one row per column."""
    charges = df.select(
        F.col("monthly_charges").cast("decimal(10,2)"), F.col("total_charges").cast("decimal(10,2)")
    ).unpivot([], ["monthly_charges", "total_charges"], "column_name", "amount")
    if exact:
        return quantiles(charges, "amount", _POINTS, by=["column_name"])
    sketch = F.percentile_approx(
        F.col("amount").cast("double"), list(_POINTS.values()), F.lit(accuracy)
    ).alias("points")
    found = charges.where("amount IS NOT NULL").groupBy("column_name").agg(sketch)
    return found.select(
        "column_name", *[F.col("points")[i].alias(name) for i, name in enumerate(_POINTS)]
    )


def fit_features(df: DataFrame, exact: bool = True) -> FeatureCuts:
    """Median of total_charges and terciles of monthly_charges (two small rows come back)."""
    points = {row["column_name"]: row for row in charge_points(df, exact).collect()}
    monthly, total = points.get("monthly_charges"), points.get("total_charges")
    if monthly is None:
        raise ValueError("no monthly_charges to cut into terciles")
    edges = [monthly[name] for name in ("lowest", "third", "two_thirds", "highest")]
    if len(set(edges)) < len(edges):
        raise ValueError(f"monthly_charges terciles are not distinct: {edges}")
    return FeatureCuts(total["median"] if total else None, edges[1], edges[2])


def tenure_group() -> Column:
    return F.when(F.col("tenure_months").isNotNull(), tenure_bucket())


def count_true(conditions: Sequence[Column]) -> Column:
    """How many of the conditions hold in a row; unknown ones do not."""
    count = F.lit(0)
    for condition in conditions:
        count = count + flag(condition).cast("int")
    return count


def service_count() -> Column:
    """Phone, internet and add-ons. An unknown internet service counts, an unknown add-on does not."""
    internet = ~F.col("internet_service").eqNullSafe("No")
    return count_true([F.col("phone_service"), internet, *[F.col(c) == "Yes" for c in SERVICE_ADD_ONS]])


def add_tenure_group(df: DataFrame) -> DataFrame:
    return df.withColumn("tenure_group", tenure_group())


def add_service_count(df: DataFrame) -> DataFrame:
    return df.withColumn("service_count", service_count())


def add_high_value_customer(df: DataFrame, cuts: FeatureCuts) -> DataFrame:
    """Billed strictly more than the median."""
    median = F.lit(cuts.median_total_charges).cast("double")
    return df.withColumn("high_value_customer", flag(F.col("total_charges") > median))


def add_premium_customer(df: DataFrame) -> DataFrame:
    return df.withColumn("premium_customer", flag(F.col("internet_service") == "Fiber optic"))


def add_autopay_customer(df: DataFrame) -> DataFrame:
    return df.withColumn("autopay_customer", flag(F.col("payment_method").isin(AUTOPAY_METHODS)))


def add_revenue_category(df: DataFrame, cuts: FeatureCuts) -> DataFrame:
    """Right-closed terciles of the monthly charge."""
    charge = F.col("monthly_charges").cast("double")
    low, medium, high = REVENUE_LABELS
    category = (
        F.when(charge <= cuts.low_monthly_charges, low)
        .when(charge <= cuts.high_monthly_charges, medium)
        .when(charge.isNotNull(), high)
    )
    return df.withColumn("revenue_category", category)


def apply_features(df: DataFrame, cuts: FeatureCuts) -> DataFrame:
    """All six features; a narrow projection."""
    return (
        df.transform(add_tenure_group)
        .transform(add_service_count)
        .transform(add_high_value_customer, cuts)
        .transform(add_premium_customer)
        .transform(add_autopay_customer)
        .transform(add_revenue_category, cuts)
    )


def engineer_features(df: DataFrame, fit_on: DataFrame | None = None, exact: bool = True) -> DataFrame:
    """Features of ``df`` with cut points from ``fit_on`` (by default from ``df`` itself)."""
    return apply_features(df, fit_features(df if fit_on is None else fit_on, exact))
