"""From churn probabilities to money and to one action per customer.

The value of flagging is taken as it is usually back-tested here: a caught churner is worth the
saved share of their value less the offer, a missed one costs their whole value, an offer to
someone who stays costs the offer. The share of caught churners who leave anyway is not charged.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.operators.evaluation import COUNTS, rates_of
from stayrate.schema import (
    EXPECTED_MONTHS,
    GRID_FIRST,
    GRID_LAST,
    NOBODY_FLAGGED,
    OFFER_COST,
    OFFER_SUCCESS_RATE,
    RECOMMENDATION_COLUMNS,
)

CLV_TYPE = "decimal(12,2)"


def clv() -> Column:
    """Value of a customer over the expected months."""
    return (F.col("monthly_charges") * F.lit(Decimal(EXPECTED_MONTHS))).cast(CLV_TYPE)


def with_clv(df: DataFrame) -> DataFrame:
    return df.withColumn("clv", clv())


def value_of(threshold: float | Column) -> Column:
    """What flagging at ``threshold`` is worth for one customer."""
    flagged, churned = F.col("churn_probability") >= threshold, F.col("churn")
    saved = F.col("clv") * F.lit(OFFER_SUCCESS_RATE) - F.lit(OFFER_COST)
    return (
        F.when(flagged & churned, saved)
        .when(flagged, F.lit(-OFFER_COST))
        .when(churned, -F.col("clv"))
        .otherwise(F.lit(Decimal(0)))
    )


def _value_at(threshold: float | Column) -> Column:
    return F.sum(value_of(threshold)).cast("double")


def business_value(scored: DataFrame, thresholds: dict[str, float | Column]) -> DataFrame:
    """Back-tested value at each named threshold, all in one scan."""
    values = scored.agg(*[_value_at(t).alias(name) for name, t in thresholds.items()])
    return values.unpivot([], list(thresholds), "strategy", "business_value")


def backtest(scored: DataFrame, threshold: float) -> DataFrame:
    return scored.agg(_value_at(threshold).alias("business_value"))


def _last_passed() -> Column:
    """The last grid number i whose i / 100 does not exceed the probability."""
    p = F.col("churn_probability")
    guess = F.floor(p * 100)
    found = (
        F.when((guess + 1).cast("double") / 100 <= p, guess + 1)
        .when(guess.cast("double") / 100 > p, guess - 1)
        .otherwise(guess)
    )
    return F.least(F.greatest(found, F.lit(GRID_FIRST - 1)), F.lit(GRID_LAST)).cast("int")


def swept(scored: DataFrame) -> DataFrame:
    """Confusion counts and back-tested value at every candidate threshold, from one scan.

    Rows are summed per last threshold they pass (92 groups at most); who is flagged at a
    threshold is then the sum of the groups from it upward. ``no_program`` is the value of
    flagging nobody.
    """
    churned = F.col("churn")
    groups = scored.groupBy(_last_passed().alias("step")).agg(
        F.count_if(churned).alias("pos"),
        F.count_if(~churned).alias("neg"),
        F.coalesce(F.sum(F.when(churned, F.col("clv"))), F.lit(Decimal("0.00"))).alias("at_stake"),
    )
    grid = scored.sparkSession.range(GRID_FIRST, GRID_LAST + 1).select(
        *[
            (F.col("id") if f.name == "step" else F.lit(0)).cast(f.dataType).alias(f.name)
            for f in groups.schema.fields
        ]
    )
    amounts = ["pos", "neg", "at_stake"]
    steps = groups.unionByName(grid).groupBy("step").agg(*[F.sum(c).alias(c) for c in amounts])
    upward = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everyone = Window.orderBy(F.desc("step")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    running = steps.select(
        "step",
        *[F.sum(c).over(upward).alias(c) for c in amounts],
        *[F.sum(c).over(everyone).alias(f"all_{c}") for c in amounts],
    )
    caught = F.col("at_stake").cast("decimal(28,2)")
    lost = F.col("all_at_stake").cast("decimal(28,2)") - caught
    offers = (F.col("pos") + F.col("neg")).cast("decimal(20,0)") * F.lit(OFFER_COST)
    return (
        running.where(F.col("step") >= GRID_FIRST)
        .select(
            (F.col("step").cast("double") / 100).alias("threshold"),
            (caught * F.lit(OFFER_SUCCESS_RATE) - offers - lost).alias("business_value"),
            (-F.col("all_at_stake")).alias("no_program"),
            (F.col("all_neg") - F.col("neg")).alias("tn"),
            F.col("neg").alias("fp"),
            (F.col("all_pos") - F.col("pos")).alias("fn"),
            F.col("pos").alias("tp"),
        )
        .orderBy("threshold")
    )


def threshold_sweep(scored: DataFrame) -> DataFrame:
    """Back-tested value at every candidate threshold."""
    return swept(scored).select("threshold", "business_value")


def best_threshold(sweep: DataFrame) -> DataFrame:
    """The row of the highest value, the lowest threshold among equals."""
    return sweep.orderBy(F.desc("business_value"), "threshold").limit(1)


def optimal_threshold(scored: DataFrame) -> Column:
    """The best threshold as a value inside a query."""
    return best_threshold(threshold_sweep(scored)).select("threshold").scalar()


def reference_points(scored: DataFrame) -> DataFrame:
    """Value at the usual 0.5, with nobody flagged, and at the best threshold."""
    return points_of(swept(scored))


def points_of(sweep: DataFrame) -> DataFrame:
    """The reference points of a finished sweep."""
    points = sweep.agg(
        F.max(F.when(F.col("threshold") == 0.5, F.col("business_value"))).alias("default"),
        F.max("no_program").alias("no_program"),
        F.max("business_value").alias("optimal"),
    )
    return points.unpivot([], ["default", "no_program", "optimal"], "strategy", "business_value")


def rates_at_optimum(scored: DataFrame) -> DataFrame:
    """Precision, recall and confusion counts at the best threshold."""
    return rates_at_best(swept(scored))


def rates_at_best(sweep: DataFrame) -> DataFrame:
    """The rates at the best threshold of a finished sweep."""
    return rates_of(best_threshold(sweep)).select("threshold", "precision", "recall", *COUNTS)


def score_active(scored: DataFrame) -> DataFrame:
    """Customers who have not left, with what they are worth and what an offer may bring."""
    p, value = F.col("churn_probability"), F.col("clv").cast("double")
    cost = float(OFFER_COST)
    return (
        scored.where(~F.col("churn"))
        .withColumn("clv", clv())
        .withColumns(
            {
                "revenue_at_risk": p * value,
                "retention_offer_cost": F.lit(cost),
                "expected_net_benefit": p * float(OFFER_SUCCESS_RATE) * value - cost,
            }
        )
    )


def recommend_action(threshold: float | Column) -> Column:
    """Retain where an offer pays, Monitor where the risk is high but it does not, else No Action."""
    offer = F.when(F.col("expected_net_benefit") > 0, "Retain").otherwise("Monitor")
    return F.when(F.col("churn_probability") >= threshold, offer).otherwise("No Action")


def recommend(scored: DataFrame, threshold: float | Column) -> DataFrame:
    """The recommendations table: one row per active customer."""
    rows = score_active(scored).withColumn("recommended_action", recommend_action(threshold))
    return rows.select(*RECOMMENDATION_COLUMNS)


def action_counts(recommendations: DataFrame) -> DataFrame:
    counts = recommendations.groupBy("recommended_action").agg(F.count(F.lit(1)).alias("customers"))
    return counts.orderBy(F.desc("customers"), "recommended_action")


def top_risk(recommendations: DataFrame, n: int = 20) -> DataFrame:
    """The n highest probabilities, ids in order among equals."""
    return recommendations.orderBy(F.desc("churn_probability"), "customer_id").limit(n)
