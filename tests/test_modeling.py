"""Splits, encoding and fits."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayrate.operators import cleaning, evaluation, features, modeling
from stayrate.sources import store


@pytest.fixture(scope="module")
def matrix(customers):
    rows = features.engineer_features(cleaning.fill_total_charges(customers))
    return modeling.training_matrix(rows).cache()


def test_split_is_exact_and_repeatable(customers):
    split = modeling.stratified_split(customers)
    sizes = {(r["churn"], r["split"]): r["count"] for r in split.groupBy("churn", "split").count().collect()}
    assert (sizes[False, "test"], sizes[True, "test"]) == (226, 74)
    again = modeling.stratified_split(customers.repartition(13))
    assert split.select("customer_id", "split").exceptAll(again.select("customer_id", "split")).count() == 0


def test_another_seed_gives_another_split(customers):
    def chosen(seed):
        rows = modeling.stratified_split(customers, seed=seed).where("split = 'test'")
        return {r["customer_id"] for r in rows.collect()}

    assert chosen(42) != chosen(7)


@pytest.mark.parametrize(
    ("sizes", "quotas"),
    [({True: 1869, False: 5174}, {True: 374, False: 1035}), ({True: 3, False: 7}, {True: 1, False: 1})],
)
def test_quotas_share_out_the_remainder(sizes, quotas):
    assert modeling.class_quotas(sizes, 0.2) == quotas


def test_folds_are_even_per_class(customers):
    rows = modeling.stratified_folds(customers, 5).groupBy("churn", "fold").count().collect()
    assert len(rows) == 10
    for churn in (True, False):
        sizes = [r["count"] for r in rows if r["churn"] == churn]
        assert max(sizes) - min(sizes) <= 1


def test_weights():
    weights = modeling.ClassWeights(kept=300, churned=100)
    assert weights.balanced == pytest.approx((2 / 3, 2.0)) and weights.positive == 3.0


def test_one_class_has_no_weights(customers):
    with pytest.raises(ValueError, match="both classes"):
        modeling.class_weights(customers.where("churn"))


def test_encoder_shape_and_scaling(matrix):
    encoder = Pipeline(stages=modeling.encoding_stages()).fit(matrix)
    names = modeling.feature_names(encoder)
    rows = np.array([r[0] for r in encoder.transform(matrix).select(vector_to_array("features")).collect()])
    assert rows.shape[1] == len(names)
    number = [names.index(c) for c in modeling.NUMERIC_FEATURES]
    assert rows[:, number].mean(axis=0) == pytest.approx(np.zeros(4), abs=1e-9)
    assert rows[:, number].std(axis=0) == pytest.approx(np.ones(4))
    contracts = [i for i, name in enumerate(names) if name.startswith("contract_type=")]
    assert (rows[:, contracts].sum(axis=1) == 1).all()


def test_unseen_category_is_all_zero(matrix):
    encoder = Pipeline(stages=modeling.encoding_stages()).fit(matrix)
    names = modeling.feature_names(encoder)
    odd = matrix.limit(1).withColumn("x_contract_type", F.lit("Weekly"))
    vector = encoder.transform(odd).select(vector_to_array("features").alias("v")).first()["v"]
    assert [vector[i] for i, name in enumerate(names) if name.startswith("contract_type=")] == [0.0] * 3


def test_logistic_fit_minimises_the_weighted_loss(matrix):
    """Against Newton's method on the same penalised, class-weighted loss."""
    strength = 0.5
    total = matrix.agg(F.sum("balanced_weight")).first()[0]
    model = modeling.fit_model(matrix, modeling.logistic_regression(regParam=1 / (strength * total), tol=1e-10))
    rows = model.transform(matrix).select(vector_to_array("features"), "label", "balanced_weight").collect()
    x = np.array([r[0] for r in rows])
    y, w = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    x1 = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x1.shape[1])
    penalty = np.diag([1.0] * x.shape[1] + [0.0]) / strength
    for _ in range(50):
        p = 1 / (1 + np.exp(-x1 @ beta))
        gradient = x1.T @ (w * (p - y)) + penalty @ beta
        beta -= np.linalg.solve((x1 * (w * p * (1 - p))[:, None]).T @ x1 + penalty, gradient)
    assert np.append(model.stages[-1].coefficients.toArray(), model.stages[-1].intercept) == pytest.approx(beta, abs=2e-3)


@pytest.mark.parametrize(
    ("make", "settings"),
    [
        (modeling.random_forest, {"numTrees": 15, "maxDepth": 5}),
        (modeling.boosted_trees, {"maxIter": 5, "maxDepth": 3}),
    ],
)
def test_trees_learn(matrix, make, settings):
    scored = modeling.predict(modeling.fit_model(matrix, make(**settings)), matrix)
    assert evaluation.roc_auc(scored).first()["roc_auc"] > 0.8


def test_model_survives_storage(matrix, tmp_path):
    model = modeling.fit_model(matrix, modeling.logistic_regression(regParam=0.1, maxIter=5))
    store.save_model(model, str(tmp_path / "model"))
    again = store.load_model(str(tmp_path / "model"))
    assert modeling.predict(model, matrix).exceptAll(modeling.predict(again, matrix)).count() == 0


def test_unknown_number_is_scored_at_the_mean(matrix):
    model = modeling.fit_model(matrix, modeling.logistic_regression(regParam=0.1, maxIter=5))
    mean = matrix.agg(F.avg("x_total_charges")).first()[0]
    row = matrix.limit(1)
    one = modeling.predict(model, row.withColumn("x_total_charges", F.lit(None).cast("double"))).first()
    two = modeling.predict(model, row.withColumn("x_total_charges", F.lit(mean))).first()
    assert one["churn_probability"] == pytest.approx(two["churn_probability"])


def test_search_draws_within_the_ranges():
    for candidate in modeling.CANDIDATES.values():
        draws = modeling.draw_settings(candidate, 15)
        assert draws == modeling.draw_settings(candidate, 15) and len({str(d) for d in draws}) == 15
    boosted = modeling.draw_settings(modeling.CANDIDATES["boosted_trees"], 200)
    assert {d["maxDepth"] for d in boosted} == {3, 4, 5, 6, 7}
    assert all(100 <= d["maxIter"] < 400 and 0.01 <= d["stepSize"] <= 0.3 for d in boosted)


def test_tuning_refits_the_best(spark, matrix):
    found = modeling.tune_model(matrix, modeling.CANDIDATES["logistic_regression"], n_iter=2, folds=2, fixed={"maxIter": 5})
    assert len(found.scores) == 2 and min(found.scores) > 0.5
    report = found.report(matrix, "logistic_regression").where("chosen").collect()
    assert [r["candidate"] for r in report] == [found.best]


def test_a_column_with_nothing_known_scales_to_zero(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    rows = modeling.PopulationScaler(columns=["a", "b"]).fit(df).transform(df).collect()
    assert [(r["z_a"], r["z_b"]) for r in rows] == [(0.0, -1.0), (0.0, 1.0)]
