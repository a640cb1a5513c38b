"""Answers rolled up from the joint aggregate against answers from the customers themselves."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stayrate.operators import dashboard, eda, joint
from stayrate.plans import jobs
from stayrate.schema import CUSTOMER_COLUMNS


@pytest.fixture(scope="module")
def some(customers):
    """Customers, some of whose categories, tenures and charges are unknown."""
    columns = [c for c in CUSTOMER_COLUMNS if c != "customer_id"]
    unknown = {
        c: F.when(F.pmod(F.xxhash64("customer_id", F.lit(c)), F.lit(23)) == 0, None).otherwise(F.col(c))
        for c in columns
        if c != "churn"
    }
    return customers.withColumns(unknown).cache()


@pytest.fixture(scope="module")
def cells(some):
    return joint.joint_aggregate(some).cache()


def _rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("answer", jobs.ROLLED_UP, ids=lambda f: f.__name__)
def test_rolled_up_answers_are_the_same(some, cells, answer):
    assert _rows(answer(cells)) == _rows(answer(some))


@pytest.mark.parametrize(
    "answer",
    [
        dashboard.contract_mix,
        dashboard.churn_breakdowns,
        lambda df: dashboard.churn_breakdowns(df, {"partner": [True], "contract_type": ["One year"]}),
        lambda df: eda.histogram(df, "tenure_months", 36),
        lambda df: eda.group_mean(df, "tenure_months"),
        lambda df: eda.churn_share(df, "payment_method"),
    ],
)
def test_rolled_up_pages_are_the_same(some, cells, answer):
    assert _rows(answer(cells)) == _rows(answer(some))


def test_charge_counts_answer_for_charges(some):
    counts = joint.counted_customers(some, ["churn", "monthly_charges"])
    assert _rows(eda.histogram(counts, "monthly_charges", 40)) == _rows(eda.histogram(some, "monthly_charges", 40))
    ours, rows = (
        [r["density"] for r in eda.density(df).orderBy("churn", "point").collect()] for df in (counts, some)
    )
    assert ours == pytest.approx(rows, rel=1e-9)


def test_cells_stand_for_every_customer(some, cells):
    row = cells.agg(F.sum("_customers"), F.sum("_charged"), F.sum("_charges")).first()
    assert tuple(row) == tuple(some.agg(F.count(F.lit(1)), F.count("monthly_charges"), F.sum("monthly_charges")).first())
    empty = joint.joint_aggregate(some.limit(0))
    assert empty.count() == 0 and jobs.ROLLED_UP[0](empty).first()["churned_customers"] is None


def test_correlations_equal_pandas_with_unknown_values(some):
    frame = some.select(*[F.col(c).cast("double").alias(c) for c in eda.CORRELATED]).toPandas().astype(float)
    found = {(r["column_a"], r["column_b"]): r["correlation"] for r in eda.correlations(some).collect()}
    expected = frame.corr()
    assert len(found) == len(eda.CORRELATED) ** 2
    for a, b in itertools.product(eda.CORRELATED, repeat=2):
        assert found[a, b] == pytest.approx(expected.loc[a, b], abs=1e-9)


def test_correlation_without_variation_is_null(spark):
    frame = pd.DataFrame({"a": [1.0, 1.0, 1.0], "b": [1.0, 2.0, np.nan], "c": [True, False, True]})
    rows = eda.correlations(spark.createDataFrame(frame), ["a", "b", "c"]).collect()
    found = {(r["column_a"], r["column_b"]): r["correlation"] for r in rows}
    assert found["a", "c"] is None and found["a", "a"] == 1.0
