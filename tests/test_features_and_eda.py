"""Feature edges, cut points and chart numbers against pandas and numpy."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stayrate.operators import eda, features, metrics
from stayrate.schema import SERVICE_ADD_ONS


def _services(spark, **changes):
    row = {"phone_service": True, "internet_service": "DSL", **dict.fromkeys(SERVICE_ADD_ONS, "No"), **changes}
    schema = "phone_service boolean, internet_service string, " + ", ".join(f"{c} string" for c in SERVICE_ADD_ONS)
    return spark.createDataFrame([tuple(row.values())], schema)


def test_tenure_edges_are_right_closed(spark):
    rows = spark.createDataFrame([(t,) for t in [0, 12, 13, 24, 25, 48, 49, None]], "tenure_months int")
    found = [r["tenure_group"] for r in features.add_tenure_group(rows).collect()]
    low, second, third, top = "0-12 months", "13-24 months", "25-48 months", "49+ months"
    assert found == [low, low, second, second, third, third, top, None]
    # The business question has no bucket for the unknown but the last one.
    assert rows.select(metrics.tenure_bucket().alias("b")).collect()[-1]["b"] == top


@pytest.mark.parametrize(
    ("changes", "count"),
    [
        ({}, 2),
        ({"internet_service": "No", "phone_service": False}, 0),
        ({"internet_service": None}, 2),
        ({"tech_support": None}, 2),
        (dict.fromkeys(SERVICE_ADD_ONS, "Yes"), 9),
    ],
)
def test_service_count(spark, changes, count):
    assert features.add_service_count(_services(spark, **changes)).first()["service_count"] == count


def test_unknown_values_give_false_flags(spark):
    cuts = features.FeatureCuts(10.0, 1.0, 2.0)
    rows = spark.createDataFrame([(None, None, None)], "total_charges decimal(10,2), internet_service string, payment_method string")
    row = rows.transform(features.add_high_value_customer, cuts).transform(features.add_premium_customer).transform(features.add_autopay_customer).first()
    assert (row["high_value_customer"], row["premium_customer"], row["autopay_customer"]) == (False, False, False)


def test_median_itself_is_not_high_value(spark):
    rows = spark.createDataFrame([(Decimal(x), Decimal(x)) for x in (1, 2, 3, 4, 5)], "monthly_charges decimal(8,2), total_charges decimal(10,2)")
    cuts = features.fit_features(rows)
    flags = [r["high_value_customer"] for r in features.add_high_value_customer(rows, cuts).orderBy("total_charges").collect()]
    assert flags == [False, False, False, True, True]


def test_terciles_equal_pandas(spark, customers):
    cuts = features.fit_features(customers)
    ours = features.add_revenue_category(customers, cuts).select("monthly_charges", "revenue_category").toPandas()
    expected = pd.qcut(ours["monthly_charges"].astype(float), q=3, labels=["Low", "Medium", "High"])
    assert (ours["revenue_category"] == expected.astype(str)).all()


def test_tied_terciles_are_refused(spark):
    rows = spark.createDataFrame([(Decimal(5), Decimal(5))] * 9, "monthly_charges decimal(8,2), total_charges decimal(10,2)")
    with pytest.raises(ValueError, match="not distinct"):
        features.fit_features(rows)


def test_cuts_from_training_rows_only(spark, customers):
    first = customers.where("monthly_charges < 60")
    assert features.fit_features(first).high_monthly_charges < features.fit_features(customers).high_monthly_charges
    rows = features.engineer_features(customers, fit_on=first)
    assert rows.where("revenue_category = 'High'").count() > rows.where("revenue_category = 'Low'").count()


def test_approximate_cuts_are_near(spark, customers):
    exact, near = features.fit_features(customers), features.fit_features(customers, exact=False)
    assert near.low_monthly_charges == pytest.approx(exact.low_monthly_charges, abs=1.5)


def test_cuts_survive_storage(spark, customers):
    cuts = features.fit_features(customers)
    assert features.FeatureCuts.from_frame(cuts.to_frame(spark)) == cuts


@pytest.mark.parametrize(("column", "bins"), [("monthly_charges", 40), ("tenure_months", 36)])
def test_histogram_equals_numpy(spark, customers, column, bins):
    data = customers.select(F.col(column).cast("double").alias("x"), "churn").toPandas()
    edges = np.histogram_bin_edges(data["x"], bins)
    rows = eda.histogram(customers, column, bins).toPandas()
    assert len(rows) == 2 * bins and rows["customers"].sum() == len(data)
    assert rows["bin_start"].unique() == pytest.approx(edges[:-1], abs=1e-6)
    for churn, part in rows.groupby("churn"):
        counts, _ = np.histogram(data.loc[data["churn"] == churn, "x"], edges)
        assert abs(part.sort_values("bin")["customers"].to_numpy() - counts).sum() <= 4  # values on float edges


def test_histogram_of_one_value(spark):
    rows = spark.range(5).select(F.lit(7).alias("v"), F.lit(True).alias("churn"))
    found = eda.histogram(rows, "v", 4).where("customers > 0").collect()
    assert [(r["bin"], r["customers"]) for r in found] == [(3, 5)]
    assert eda.histogram(rows, "v", 4).first()["bin_start"] == 6.5


def test_describe_and_correlations_equal_pandas(spark, customers):
    data = customers.select(*eda.CORRELATED).toPandas().astype(float)
    for row in eda.group_describe(customers, "monthly_charges").collect():
        part = data.loc[data["churn"] == float(row["churn"]), "monthly_charges"]
        assert (row["mean"], row["median"], row["std"]) == pytest.approx((part.mean(), part.median(), part.std()))
    expected = data.corr()
    rows = eda.correlations(customers).collect()
    assert len(rows) == 64
    for row in rows:
        assert row["correlation"] == pytest.approx(expected.loc[row["column_a"], row["column_b"]])


def test_density_integrates_to_one_per_group(spark, customers):
    rows = eda.density(customers).toPandas()
    for _, part in rows.groupby("churn"):
        area = np.trapezoid(part["density"], part["grid_value"])
        assert 0.9 < area <= 1.0


def test_boxplot_outliers_equal_pandas(spark, customers):
    data = customers.select("tenure_months", "churn").toPandas()
    for row in eda.boxplots(customers, ["tenure_months"]).collect():
        x = data.loc[data["churn"] == row["churn"], "tenure_months"]
        q1, q3 = x.quantile(0.25), x.quantile(0.75)
        outside = (x < q1 - 1.5 * (q3 - q1)) | (x > q3 + 1.5 * (q3 - q1))
        assert (row["q1"], row["q3"], row["outliers"]) == (q1, q3, outside.sum())
        assert (row["whisker_low"], row["whisker_high"]) == (x[~outside].min(), x[~outside].max())


def test_shape_and_preview(spark, customers):
    assert tuple(eda.shape(customers).first()) == (customers.count(), 21)
    assert eda.preview(customers).count() == 5


def test_unknown_internet_is_left_out_of_add_ons(spark, customers):
    unknown = customers.withColumn("internet_service", F.lit(None).cast("string"))
    assert metrics.churn_by_add_on(unknown).count() == 0


def test_long_form_equals_union_of_groups(spark, customers):
    one_scan = {tuple(r) for r in metrics.churn_by_demographics(customers).collect()}
    union = set()
    for column in ("gender", "senior_citizen", "partner", "dependents"):
        for r in metrics.churn_rate_by(customers, column).collect():
            value = r[column] if isinstance(r[column], str) else str(r[column]).lower()
            union.add((column, value, r["customers"], r["churn_rate_pct"]))
    assert one_scan == union


def test_small_cells_are_hidden(spark, customers):
    assert metrics.churn_matrix(customers, 100).where("customers < 100").count() == 0


def test_histogram_refuses_inexact_numbers(spark):
    df = spark.createDataFrame([(0.1, True), (0.9, False)], "x double, churn boolean")
    with pytest.raises(TypeError, match="x is double"):
        eda.histogram(df, "x", 4)


def test_preview_in_an_order(spark):
    assert [r["id"] for r in eda.preview(spark.range(9, -1, -1), 3, "id").collect()] == [0, 1, 2]


@pytest.mark.parametrize("bins", [21, 101, 801])
def test_binned_density_stays_within_its_bound(customers, bins):
    exact = {(r["churn"], r["point"]): r for r in eda.density(customers, points=50).collect()}
    binned = {(r["churn"], r["point"]): r for r in eda.density(customers, points=50, bins=bins).collect()}
    frame = customers.select(F.col("monthly_charges").cast("double").alias("x"), "churn").toPandas()
    apart = (frame["x"].max() - frame["x"].min()) / (bins - 1)
    assert exact.keys() == binned.keys()
    for churn, rows in frame.groupby("churn"):
        bandwidth = rows["x"].std() * len(rows) ** -0.2
        bound = apart**2 / (8 * np.sqrt(2 * np.pi) * bandwidth**3)
        missed = [abs(exact[k]["density"] - binned[k]["density"]) for k in exact if k[0] == churn]
        assert max(missed) <= bound + 1e-12
        # Mass is dealt, not lost.
        width = exact[churn, 1]["grid_value"] - exact[churn, 0]["grid_value"]
        assert abs(sum(exact[k]["density"] - binned[k]["density"] for k in exact if k[0] == churn)) * width < 0.01


def test_binned_density_of_equal_values(spark):
    rows = spark.createDataFrame([(Decimal("5.00"), True)] * 3 + [(Decimal("5.00"), False)], "monthly_charges decimal(8,2), churn boolean")
    for bins in (None, 10):
        found = eda.density(rows, points=5, bins=bins).collect()
        assert len(found) == 10 and all(r["density"] is None for r in found)
