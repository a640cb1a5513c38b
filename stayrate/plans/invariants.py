"""What must hold of fitted models, as relations that SQL can state without fitting any.

Each query shows ids or class sizes beside yes/no columns, computed from the models' real outputs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.functions.ranks import rank_index
from stayrate.operators import decision, evaluation, modeling
from stayrate.plans import registry
from stayrate.plans.oracle import TESTED, query


def held_out_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every model scores exactly the held-out customers, with probabilities."""
    parts = [
        scored.select(
            F.lit(name).alias("model"), "customer_id", F.col("churn_probability").between(0, 1).alias("is_probability")
        )
        for name, scored in registry.compared_scores(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def stored_equals_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model gives each customer the same probability before and after it was stored."""
    fresh = registry.held_out_scores(spark, sf_dir, "logistic_regression").select("customer_id", F.col("churn_probability").alias("p"))
    stored = registry.saved_model_scores(spark, sf_dir).select("customer_id", F.col("churn_probability").alias("q"))
    return fresh.join(stored, "customer_id", "full").select("customer_id", F.col("p").eqNullSafe(F.col("q")).alias("same"))


def stationary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The linear model's penalised weighted loss has no slope left: largest slope over all weights, against 1e-3."""
    training = modeling.training_matrix(registry.split_features(spark, sf_dir, "train"))
    fitted = registry.fitted(spark, sf_dir, "logistic_regression")
    last = fitted.stages[-1]
    weights, strength = last.coefficients.toArray().tolist(), last.getRegParam()
    rows = fitted.transform(training).select(
        F.col("balanced_weight").alias("w"),
        (vector_to_array("probability")[1] - F.col("label")).alias("miss"),
        vector_to_array("features").alias("x"),
    )
    slopes = [F.sum(F.col("w") * F.col("miss") * F.col("x")[i]) / F.sum("w") + strength * b for i, b in enumerate(weights)]
    slopes.append(F.sum(F.col("w") * F.col("miss")) / F.sum("w"))
    return rows.agg(F.greatest(*[F.abs(s) for s in slopes]).alias("slope")).select((F.col("slope") < 1e-3).alias("flat"))


def comparison_adds_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model's confusion counts make up the classes, its rates follow from them, its area counts pairs."""
    parts = []
    for name, scored in registry.compared_scores(spark, sf_dir).items():
        row = evaluation.evaluate_model(name, scored)
        # Ranks, with the mean rank for equal scores: the churners' rank sum less its least value counts the pairs they win.
        per_score = scored.groupBy("churn_probability").agg(F.count(F.lit(1)).alias("n"), F.count_if("churn").alias("ones"))
        ranked = rank_index(per_score, "churn_probability").join(per_score.drop("n"), "churn_probability")
        ones, rank = F.sum("ones"), F.col("start") + (F.col("n") + 1) / 2
        won = F.sum(F.col("ones") * rank) - ones * (ones + 1) / 2
        area = ranked.agg((won / (ones * (F.sum("n") - ones))).alias("area"))
        close = lambda a, b: F.abs(a - b) < 1e-9
        tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
        zero = F.lit(0.0)
        parts.append(
            row.withColumn("area", area.scalar()).select(
                "model",
                (tn + fp).alias("kept"),
                (fn + tp).alias("churned"),
                (
                    close(F.col("accuracy"), (tp + tn) / (tn + fp + fn + tp))
                    & close(F.col("precision"), F.coalesce(F.try_divide(tp, tp + fp), zero))
                    & close(F.col("recall"), F.coalesce(F.try_divide(tp, tp + fn), zero))
                    & close(F.col("f1"), F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), zero))
                ).alias("rates_follow"),
                close(F.col("roc_auc"), F.col("area")).alias("area_counts_pairs"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def actions_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All active customers get the action that their probability, benefit and the threshold ask for."""
    best = decision.optimal_threshold(registry.held_out_scores(spark, sf_dir, "boosted_trees"))
    rows = registry.model_recommendations(spark, sf_dir)
    wanted = F.when(F.col("churn_probability") < best, "No Action").when(F.col("expected_net_benefit") > 0, "Retain").otherwise("Monitor")
    return rows.select(
        "customer_id",
        F.col("churn_probability").between(0, 1).alias("is_probability"),
        (F.col("recommended_action") == wanted).alias("follows"),
    )


def _in_range() -> Column:
    """Whether a setting lies within the ranges of its model's search."""
    value = lambda name: F.get_json_object("settings", f"$.{name}").cast("double")
    trees = value("featureSubsetStrategy").between(0.3, 1)
    return (
        F.when(F.col("model") == "logistic_regression", value("C").between(1e-3, 1e2))
        .when(
            F.col("model") == "random_forest",
            trees & value("numTrees").between(100, 399) & value("maxDepth").isin(5, 10, 15, 20, 30) & value("minInstancesPerNode").between(1, 7),
        )
        .otherwise(
            trees & value("maxIter").between(100, 399) & value("maxDepth").between(3, 7) & value("stepSize").between(1e-2, 3e-1)
            & value("subsamplingRate").between(0.6, 1)
        )
    )


def search_is_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every setting lies within its range, was scored on every fold, and one with the highest mean is chosen."""
    scores = registry.search_journal(spark, sf_dir)
    folds = scores.groupBy("model").agg(
        F.count(F.lit(1)).alias("fits"),
        F.count_distinct("candidate").alias("candidates"),
        F.bool_and(F.col("roc_auc").between(0, 1) & F.col("fold").between(0, 4) & _in_range()).alias("in_range"),
    )
    chosen = registry.tuned(spark, sf_dir).groupBy("model").agg(
        F.count_if("chosen").alias("chosen"),
        (F.max("mean_roc_auc") == F.max(F.when(F.col("chosen"), F.col("mean_roc_auc")))).alias("best_chosen"),
        F.bool_and(F.col("folds") == 5).alias("all_folds"),
    )
    return folds.join(chosen, "model")


QUERIES = {
    "m07_is_stationary": stationary,
    "m09_held_out_ids": held_out_ids,
    "m10_search_is_whole": search_is_whole,
    "m15_adds_up": comparison_adds_up,
    "r07_actions_follow": actions_follow,
    "s09_stored_equals_fresh": stored_equals_fresh,
}

_MODELS = "(VALUES ('logistic_regression'), ('random_forest'), ('boosted_trees')) m(model)"
_TEST = f"(SELECT * FROM ({TESTED}) WHERE test)"
ORACLE = {
    "m07_is_stationary": "SELECT true AS flat",
    "m09_held_out_ids": query(f"SELECT model, customer_id, true AS is_probability FROM {_TEST} CROSS JOIN {_MODELS}", "placed", "quotas"),
    "m10_search_is_whole": f"""SELECT model, CAST(75 AS BIGINT) AS fits, CAST(15 AS BIGINT) AS candidates,
  true AS in_range, CAST(1 AS BIGINT) AS chosen, true AS best_chosen, true AS all_folds FROM {_MODELS}""",
    "m15_adds_up": query(
        f"""SELECT model, count(*) FILTER (NOT churn) AS kept, count(*) FILTER (churn) AS churned,
  true AS rates_follow, true AS area_counts_pairs FROM {_TEST} CROSS JOIN {_MODELS} GROUP BY model""",
        "placed", "quotas",
    ),
    "r07_actions_follow": query("SELECT customer_id, true AS is_probability, true AS follows FROM customers WHERE NOT churn"),
    "s09_stored_equals_fresh": query(f"SELECT customer_id, true AS same FROM {_TEST}", "placed", "quotas"),
}
