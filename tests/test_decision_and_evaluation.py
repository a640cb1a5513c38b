"""Money, thresholds and ranking measures on toy rows and against direct computation."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayrate.operators import dashboard, decision, evaluation

SCHEMA = "customer_id string, churn boolean, monthly_charges decimal(8,2), churn_probability double"


def _toy(spark, *rows):
    data = [(f"c{i}", churn, Decimal(charge), p) for i, (churn, charge, p) in enumerate(rows)]
    return decision.with_clv(spark.createDataFrame(data, SCHEMA))


@pytest.mark.parametrize(
    ("churn", "p", "value"), [(True, 0.9, 280.0), (False, 0.9, -20.0), (True, 0.1, -1200.0), (False, 0.1, 0.0)]
)
def test_value_of_each_outcome(spark, churn, p, value):
    assert decision.backtest(_toy(spark, (churn, 100, p)), 0.5).first()["business_value"] == value


@pytest.mark.parametrize(("p", "charge", "action"), [(0.09, 100, "Retain"), (0.09, 50, "Monitor"), (0.08, 100, "No Action")])
def test_actions(spark, p, charge, action):
    rows = decision.recommend(_toy(spark, (False, charge, p), (True, charge, p)), 0.09).collect()
    assert [r["recommended_action"] for r in rows] == [action]


def test_sweep_equals_direct_value_at_every_threshold(spark, scores):
    sweep = {round(r["threshold"] * 100): r["business_value"] for r in decision.threshold_sweep(scores).collect()}
    assert sorted(sweep) == list(range(5, 96))
    direct = decision.business_value(scores, {f"t{i}": i / 100 for i in range(5, 96)}).collect()
    assert {int(r["strategy"][1:]): r["business_value"] for r in direct} == sweep


def test_probabilities_on_grid_points_are_flagged(spark):
    rows = _toy(spark, *[(i % 2 == 0, 60, i / 100) for i in range(0, 101)])
    sweep = {r["threshold"]: r["business_value"] for r in decision.threshold_sweep(rows).collect()}
    for i in range(5, 96):
        assert sweep[i / 100] == decision.backtest(rows, i / 100).first()["business_value"]


def test_best_threshold_inside_the_grid_and_first_of_equals(spark):
    rows = _toy(spark, *[(True, 100, 0.6)] * 3, *[(False, 100, 0.3)] * 50)
    best = decision.best_threshold(decision.threshold_sweep(rows)).first()
    assert best["threshold"] == 0.31 and best["business_value"] == 3 * 280


def test_reference_points(spark, scores):
    found = {r["strategy"]: r["business_value"] for r in decision.reference_points(scores).collect()}
    assert found["default"] == decision.backtest(scores, 0.5).first()[0]
    assert found["no_program"] == decision.backtest(scores, 1.01).first()[0]
    assert found["optimal"] == max(r["business_value"] for r in decision.threshold_sweep(scores).collect())


def test_rates_at_optimum_equal_direct_counts(spark, scores):
    row = decision.rates_at_optimum(scores).first()
    direct = evaluation.classification_rates(scores, row["threshold"]).first()
    assert all(row[c] == direct[c] for c in ("precision", "recall", "tn", "fp", "fn", "tp"))


def test_recall_falls_as_the_threshold_rises(spark, scores):
    caught = [r["tp"] for r in decision.swept(scores).collect()]
    assert caught == sorted(caught, reverse=True)


def test_actions_cover_the_active_customers(spark, scores):
    rows = decision.recommend(scores, decision.optimal_threshold(scores))
    assert sum(r["customers"] for r in decision.action_counts(rows).collect()) == scores.where("NOT churn").count()


def test_rates_are_zero_where_undefined(spark):
    row = evaluation.classification_rates(_toy(spark, (False, 10, 0.1))).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_published_rates(spark):
    counts = spark.createDataFrame([(746, 289, 75, 299)], "tn long, fp long, fn long, tp long")
    row = evaluation.rates_of(counts).first()
    assert [round(row[c], 4) for c in ("accuracy", "precision", "recall", "f1")] == [0.7417, 0.5085, 0.7995, 0.6216]


def _pairs(labels, scores):
    pos, neg = scores[labels], scores[~labels]
    above = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return above / (len(pos) * len(neg))


@pytest.mark.parametrize("decimals", [1, 2, 12])
def test_auc_equals_all_pairs(spark, decimals):
    rng = np.random.default_rng(decimals)
    scores = np.round(rng.beta(2, 5, 180), decimals)
    scores[:60] = scores[0]  # a third of the rows share one score
    labels = rng.random(180) < 0.3
    rows = spark.createDataFrame([(bool(y), float(s)) for y, s in zip(labels, scores, strict=True)], "churn boolean, churn_probability double")
    assert evaluation.roc_auc(rows).first()["roc_auc"] == pytest.approx(_pairs(labels, scores), abs=1e-12)


def test_auc_of_scores_that_differ_in_the_last_bits(spark):
    scores = 1 - np.arange(40) * 2.0**-53
    labels = np.arange(40) % 3 == 0
    rows = spark.createDataFrame([(bool(y), float(s)) for y, s in zip(labels, scores, strict=True)], "churn boolean, churn_probability double")
    assert evaluation.roc_auc(rows).first()["roc_auc"] == pytest.approx(_pairs(labels, scores))


def test_auc_needs_both_classes(spark):
    assert evaluation.roc_auc(_toy(spark, (True, 1, 0.5))).first()["roc_auc"] is None


def test_models_are_ranked_by_auc(spark, scores):
    worse = scores.withColumn("churn_probability", F.lit(0.5))
    rows = evaluation.compare_models({"constant": worse, "scored": scores}).collect()
    assert [r["model"] for r in rows] == ["scored", "constant"] and rows[1]["roc_auc"] == 0.5


def test_dashboard_keeps_every_customer(spark, customers, scores):
    rows = dashboard.customer_dashboard(customers, decision.recommend(scores, 0.2))
    assert rows.count() == customers.count() and len(rows.columns) == 27
    assert rows.where("churn AND recommended_action IS NOT NULL").count() == 0
    assert rows.where("NOT churn AND recommended_action IS NULL").count() == 0


def test_worklist_is_filtered_and_sorted(spark, scores):
    rows = decision.recommend(scores, 0.2)
    shown = [r["clv"] for r in dashboard.worklist(rows, {"recommended_action": ["Monitor"]}, "clv", descending=False, limit=10).collect()]
    assert shown == sorted(shown) and len(shown) == 10
    assert dashboard.worklist(rows).count() == rows.count()


def test_slicers_narrow_the_breakdowns(spark, customers):
    rows = dashboard.churn_breakdowns(customers, {"gender": ["Male"]}).where("dimension = 'gender'").collect()
    assert [(r["value"], r["customers"]) for r in rows] == [("Male", customers.where("gender = 'Male'").count())]


@pytest.mark.parametrize("scale", [1e-12, 1e-300, 1.0, 1e9])
def test_auc_is_exact_at_any_scale_of_the_scores(spark, scale):
    draw = np.random.default_rng(6)
    scores = np.concatenate([draw.integers(1, 100, 400) * scale, [0.0, 5e-324, scale / 3]])
    labels = draw.random(len(scores)) < 0.4
    rows = spark.createDataFrame([(bool(y), float(s)) for y, s in zip(labels, scores, strict=True)], "churn boolean, churn_probability double")
    assert evaluation.roc_auc(rows).first()["roc_auc"] == pytest.approx(_pairs(labels, scores), abs=1e-12)


@pytest.mark.parametrize("descending", [True, False])
def test_pages_are_slices_of_the_whole_order(spark, tmp_path, descending):
    rows = spark.range(1203).select(
        F.format_string("c%05d", F.pmod(F.xxhash64("id"), F.lit(99_991))).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 7.0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40).alias("amount"),
        F.when(F.col("id") % 2 == 0, "Retain").otherwise("Monitor").alias("recommended_action"),
    )
    chosen = {"recommended_action": ["Retain"]}
    dashboard.write_pages(rows, str(tmp_path), chosen, "amount", descending, page_rows=50)
    whole = [tuple(r) for r in dashboard.worklist(rows, chosen, "amount", descending).collect()]
    for page in (0, 3, 12, 13):
        found = dashboard.read_page(spark, str(tmp_path), page).collect()
        assert [tuple(r)[:3] for r in found] == whole[50 * page : 50 * page + 50]
        assert [r["rank"] for r in found] == list(range(50 * page + 1, 50 * page + 1 + len(found)))
    plan = dashboard.read_page(spark, str(tmp_path), 3)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(page), EqualTo(page,3)]" in plan


def test_pages_of_an_empty_worklist(spark, tmp_path):
    rows = spark.createDataFrame([], "customer_id string, churn_probability double")
    dashboard.write_pages(rows, str(tmp_path))
    assert dashboard.read_page(spark, str(tmp_path), 0).count() == 0
