"""How well churn probabilities tell churners from the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.functions.ranks import with_cell
from stayrate.functions.rates import ratio_or_zero

COUNTS = ["tn", "fp", "fn", "tp"]


def confusion(
    scored: DataFrame, threshold: float | Column = 0.5, label: str = "churn", score: str = "churn_probability"
) -> DataFrame:
    """Counts of true and false negatives and positives; a score at the threshold is flagged."""
    flagged, actual = F.col(score) >= threshold, F.col(label)
    return scored.agg(
        F.count_if(~flagged & ~actual).alias("tn"),
        F.count_if(flagged & ~actual).alias("fp"),
        F.count_if(~flagged & actual).alias("fn"),
        F.count_if(flagged & actual).alias("tp"),
    )


def rates_of(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 beside the four counts; 0 where undefined."""
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    return counts.withColumns(
        {
            "accuracy": ratio_or_zero(tp + tn, tn + fp + fn + tp),
            "precision": ratio_or_zero(tp, tp + fp),
            "recall": ratio_or_zero(tp, tp + fn),
            "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        }
    )


def classification_rates(scored: DataFrame, threshold: float | Column = 0.5, **columns: str) -> DataFrame:
    return rates_of(confusion(scored, threshold, **columns))


def _fold(pieces: DataFrame, order: str, *by: str) -> DataFrame:
    """Join neighbouring score ranges into one per group, keeping twice the area under the curve."""
    earlier = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    negatives_before = F.coalesce(F.sum("neg").over(earlier), F.lit(0))
    return (
        pieces.withColumn("gain", F.col("area") + 2 * F.col("pos") * negatives_before.cast("decimal(19,0)"))
        .groupBy(*by)
        .agg(
            F.sum("pos").cast("decimal(19,0)").alias("pos"),
            F.sum("neg").cast("decimal(19,0)").alias("neg"),
            F.sum("gain").alias("area"),
        )
    )


def roc_auc(scored: DataFrame, label: str = "churn", score: str = "churn_probability") -> DataFrame:
    """Exact area under the ROC curve, ties counting half; NULL with one class only.

    Rows are reduced to counts per distinct score. Those are ordered within cells and the cells
    at last, so no task orders all the scores. Cells are cut at sampled scores, so scores may lie as close to 0,
    or to each other, as doubles can.
    """
    number = F.col(score)
    per_score = scored.groupBy(number.alias("score")).agg(
        F.count_if(F.col(label)).cast("decimal(19,0)").alias("pos"),
        F.count_if(~F.col(label)).cast("decimal(19,0)").alias("neg"),
    )
    pieces = with_cell(per_score, "score").withColumn("area", F.col("pos") * F.col("neg"))
    whole = _fold(_fold(pieces, "score", "cell"), "cell")
    pairs = (F.col("pos") * F.col("neg")).cast("double")
    return whole.select((F.col("area").cast("double") / F.nullif(2 * pairs, F.lit(0.0))).alias("roc_auc"))


def evaluate_model(name: str, scored: DataFrame, threshold: float | Column = 0.5) -> DataFrame:
    """One row of all measures for one model."""
    rates = classification_rates(scored, threshold).withColumn("roc_auc", roc_auc(scored).scalar())
    return rates.select(
        F.lit(name).alias("model"), "accuracy", "precision", "recall", "f1", "roc_auc", *COUNTS
    )


def compare_models(scored: dict[str, DataFrame], threshold: float = 0.5) -> DataFrame:
    """One row per model, the best ROC-AUC first."""
    rows = [evaluate_model(name, frame, threshold) for name, frame in scored.items()]
    table = rows[0]
    for row in rows[1:]:
        table = table.unionByName(row)
    return table.orderBy(F.desc_nulls_last("roc_auc"), "model")
