"""Model input, split, encoding, fitting and tuning on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions.ranks import cut_keys, tie_key
from stayrate.schema import BOOLEAN_FEATURES, CATEGORICAL_FEATURES, NUMERIC_FEATURES

SEED = 42
ID = "customer_id"
#: Candidate cuts of a number in the tree models.
MAX_BINS = 256
#: Rows from which a fit's task pays, and the most that one task holds.
TASK_ROWS, MOST_TASK_ROWS = 16_384, 524_288


def spread(df: DataFrame, rows: int, side_by_side: int = 1) -> DataFrame:
    """``df`` of so many rows dealt evenly, in a task for each core and more if these get long; few rows stay as they are.

    A dataset that was written in a few files is read by as many tasks, whatever the number of cores. Fits that run
    ``side_by_side`` share the cores, which spares each of them the stages that add up the sums of many tasks.
    """
    cores = -(-df.sparkSession.sparkContext.defaultParallelism // side_by_side)
    tasks = max(min(cores, rows // TASK_ROWS), -(-rows // MOST_TASK_ROWS))
    return df.repartition(tasks) if tasks > 1 else df


# --- model input and split -------------------------------------------------


def build_feature_matrix(df: DataFrame, carry: Sequence[str] = ("monthly_charges",)) -> DataFrame:
    """Id, 13 categories, 8 flags as 0/1, 4 numbers and, where churn is known, the 0/1 label.

    Category, flag and number columns are named ``x_``; ``carry`` keeps columns as they are. An
    unknown category is a category of its own.
    """
    columns = [F.col(ID), *[F.col(c) for c in carry]]
    columns += [F.coalesce(F.col(c), F.lit("(unknown)")).alias(f"x_{c}") for c in CATEGORICAL_FEATURES]
    columns += [F.col(c).cast("int").alias(f"x_{c}") for c in BOOLEAN_FEATURES]
    columns += [F.col(c).cast("double").alias(f"x_{c}") for c in NUMERIC_FEATURES]
    if "churn" in df.columns:
        columns += [F.col("churn"), F.col("churn").cast("double").alias("label")]
    return df.select(*columns)


def _class_sizes(df: DataFrame, label: str) -> dict[object, int]:
    """Rows per class (as many small rows as there are classes)."""
    return {row[0]: row[1] for row in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}


def class_quotas(sizes: dict[object, int], fraction: float) -> dict[object, int]:
    """Test rows per class: ceil(fraction * all) shared out by largest remainder."""
    total = sum(sizes.values())
    wanted = -int(-fraction * total // 1)
    exact = {label: wanted * n / total for label, n in sizes.items()}
    quotas = {label: int(x) for label, x in exact.items()}
    by_remainder = sorted(exact, key=lambda label: (quotas[label] - exact[label], str(label)))
    for label in by_remainder[: wanted - sum(quotas.values())]:
        quotas[label] += 1
    return quotas


def stratified_split(
    df: DataFrame, fraction: float = 0.2, seed: int = SEED, label: str = "churn", identifier: str = ID
) -> DataFrame:
    """Add ``split``: an exact share of each class goes to ``test``, chosen by seeded hash order.

    One boundary per class is searched for; every row is then placed by comparing its own hash
    with it, so the split needs no shuffle and a re-run of a lost task gives the same rows.
    """
    quotas = class_quotas(_class_sizes(df, label), fraction)
    ranks = [(value, rank) for value, rank in quotas.items() if rank > 0]
    found = cut_keys(df, label, identifier, ranks, str(seed))
    tie = tie_key(F.col(identifier), str(seed))
    test = F.lit(False)
    for (value, _), last in found.items():
        test = test | (F.col(label).eqNullSafe(F.lit(value)) & (tie <= last))
    return df.withColumn("split", F.when(test, "test").otherwise("train"))


def stratified_folds(
    df: DataFrame, folds: int = 5, seed: int = SEED, label: str = "churn", identifier: str = ID
) -> DataFrame:
    """Add ``fold`` 0..folds-1, each with an even share of each class, by seeded hash order."""
    text = f"folds-{seed}"
    ranks = []
    for value, n in _class_sizes(df, label).items():
        ends = [i * (n // folds) + min(i, n % folds) for i in range(1, folds)]
        ranks += [(value, end) for end in dict.fromkeys(ends) if 0 < end]
    found = cut_keys(df, label, identifier, ranks, text)
    tie = tie_key(F.col(identifier), text)
    fold = F.lit(0)
    for (value, _), last in found.items():
        fold = fold + F.when(F.col(label).eqNullSafe(F.lit(value)) & (tie > last), 1).otherwise(0)
    return df.withColumn("fold", fold)


# --- class weights ---------------------------------------------------------


@dataclass(frozen=True)
class ClassWeights:
    """Weights that make up for unequal classes."""

    kept: int
    churned: int

    @property
    def balanced(self) -> tuple[float, float]:
        """n / (2 * n_class) for kept and churned."""
        n = self.kept + self.churned
        return n / (2 * self.kept), n / (2 * self.churned)

    @property
    def positive(self) -> float:
        """Kept per churned, the weight of a churned row beside 1 for a kept one."""
        return self.kept / self.churned


def class_weights(df: DataFrame, label: str = "churn") -> ClassWeights:
    sizes = _class_sizes(df, label)
    if not (sizes.get(True) and sizes.get(False)):
        raise ValueError("class weights need rows of both classes")
    return ClassWeights(sizes[False], sizes[True])


def with_weights(matrix: DataFrame, weights: ClassWeights) -> DataFrame:
    """Add ``balanced_weight`` and ``positive_weight``."""
    kept, churned = weights.balanced
    is_churned = F.col("label") == 1
    return matrix.withColumns(
        {
            "balanced_weight": F.when(is_churned, churned).otherwise(kept),
            "positive_weight": F.when(is_churned, weights.positive).otherwise(1.0),
        }
    )


# --- encoding --------------------------------------------------------------


class PopulationScaler(Estimator):
    """Centre columns and divide by the population deviation (a constant column is only centred).

    An unknown number lands on the mean, where a fit on missing numbers would otherwise stop; a column
    with nothing known is 0 throughout.
    The fitted model is a SQLTransformer, so it saves and loads with its pipeline.
    """

    @keyword_only
    def __init__(self, *, columns: Sequence[str] = (), prefix: str = "z_"):
        super().__init__()
        self.columns = list(columns)
        self.prefix = prefix

    def _fit(self, dataset: DataFrame) -> SQLTransformer:
        measures = [F.avg(c).alias(f"mean_{c}") for c in self.columns]
        measures += [F.stddev_pop(c).alias(f"sd_{c}") for c in self.columns]
        row = dataset.agg(*measures).first()
        terms = [
            f"coalesce((`{c}` - {(row[f'mean_{c}'] or 0.0)!r}D) / {(row[f'sd_{c}'] or 1.0)!r}D, 0D) AS `{self.prefix}{c}`"
            for c in self.columns
        ]
        return SQLTransformer(statement=f"SELECT *, {', '.join(terms)} FROM __THIS__")


def encoding_stages() -> list:
    """One-hot categories (unseen ones all zero), scaled numbers and flags in one vector."""
    categories = [f"x_{c}" for c in CATEGORICAL_FEATURES]
    numbers = [f"x_{c}" for c in NUMERIC_FEATURES]
    return [
        StringIndexer(
            inputCols=categories,
            outputCols=[f"i_{c}" for c in categories],
            handleInvalid="keep",
            stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(
            inputCols=[f"i_{c}" for c in categories],
            outputCols=[f"h_{c}" for c in categories],
            dropLast=True,
        ),
        PopulationScaler(columns=numbers),
        VectorAssembler(
            inputCols=[
                *[f"h_{c}" for c in categories],
                *[f"z_{c}" for c in numbers],
                *[f"x_{c}" for c in BOOLEAN_FEATURES],
            ],
            outputCol="features",
        ),
    ]


def feature_names(encoder: PipelineModel) -> list[str]:
    """What each slot of the vector stands for."""
    indexer = encoder.stages[0]
    names = [
        f"{column[2:]}={level}"
        for column, levels in zip(indexer.getInputCols(), indexer.labelsArray, strict=True)
        for level in levels
    ]
    return names + list(NUMERIC_FEATURES) + list(BOOLEAN_FEATURES)


def onehot_counts(matrix: DataFrame, encoder: PipelineModel) -> DataFrame:
    """Rows that light up each one-hot slot."""
    names = feature_names(encoder)[: -len(NUMERIC_FEATURES) - len(BOOLEAN_FEATURES)]
    slots = encoder.transform(matrix).select(vector_to_array("features").alias("v"))
    row = slots.agg(*[F.sum(F.col("v")[i]).cast("bigint").alias(name) for i, name in enumerate(names)])
    long = row.unpivot([], [f"`{name}`" for name in names], "slot", "customers")
    return long.select(
        F.substring_index("slot", "=", 1).alias("column_name"),
        F.substring_index("slot", "=", -1).alias("level"),
        "customers",
    )


def encoded_slots(matrix: DataFrame, encoder: PipelineModel) -> DataFrame:
    """The encoded vectors in long form: id, slot and value of every slot that is not zero."""
    names = F.array(*[F.lit(name) for name in feature_names(encoder)])
    slots = encoder.transform(matrix).select(ID, F.posexplode(vector_to_array("features")).alias("i", "value"))
    return slots.where("value != 0").select(ID, F.get(names, F.col("i")).alias("slot"), "value")


# --- candidate models ------------------------------------------------------


@dataclass(frozen=True)
class Candidate:
    """An estimator, how to draw its settings and how these become estimator parameters."""

    name: str
    make: Callable[..., Estimator]
    draw: Callable[[np.random.Generator], dict[str, object]]
    params: Callable[[dict[str, object], float], dict[str, object]] = lambda settings, weight_sum: settings


def _log_uniform(rng: np.random.Generator, low: float, high: float) -> float:
    return float(np.exp(rng.uniform(np.log(low), np.log(high))))


def _draw_logistic(rng: np.random.Generator) -> dict[str, object]:
    return {"C": _log_uniform(rng, 1e-3, 1e2)}


def _logistic_params(settings: dict[str, object], weight_sum: float) -> dict[str, object]:
    """Inverse strength C against a summed loss is 1 / (C * sum of weights) against a mean loss."""
    other = {k: v for k, v in settings.items() if k != "C"}
    return {"regParam": 1 / (settings["C"] * weight_sum), **other}


def _draw_forest(rng: np.random.Generator) -> dict[str, object]:
    return {
        "numTrees": int(rng.integers(100, 400)),
        # 30, the deepest tree possible, stands for no limit.
        "maxDepth": int(rng.choice([30, 5, 10, 15, 20])),
        "minInstancesPerNode": int(rng.integers(1, 8)),
        "featureSubsetStrategy": f"{rng.uniform(0.3, 1.0):.4f}",
    }


def _draw_boosted(rng: np.random.Generator) -> dict[str, object]:
    return {
        "maxIter": int(rng.integers(100, 400)),
        "maxDepth": int(rng.integers(3, 8)),
        "stepSize": _log_uniform(rng, 1e-2, 3e-1),
        "subsamplingRate": float(rng.uniform(0.6, 1.0)),
        "featureSubsetStrategy": f"{rng.uniform(0.6, 1.0):.4f}",
    }


def logistic_regression(**settings: object) -> LogisticRegression:
    chosen = {"maxIter": 2000, "regParam": 0.0, **settings}
    return LogisticRegression(weightCol="balanced_weight", standardization=False, elasticNetParam=0.0, **chosen)


def random_forest(**settings: object) -> RandomForestClassifier:
    return RandomForestClassifier(weightCol="balanced_weight", seed=SEED, maxBins=MAX_BINS, **settings)


def boosted_trees(**settings: object) -> GBTClassifier:
    return GBTClassifier(weightCol="positive_weight", seed=SEED, maxBins=MAX_BINS, **settings)


CANDIDATES = {
    "logistic_regression": Candidate("logistic_regression", logistic_regression, _draw_logistic, _logistic_params),
    "random_forest": Candidate("random_forest", random_forest, _draw_forest),
    "boosted_trees": Candidate("boosted_trees", boosted_trees, _draw_boosted),
}


def fit_model(training: DataFrame, classifier: Estimator) -> PipelineModel:
    """Encoder and classifier fitted on one weighted training matrix."""
    return Pipeline(stages=[*encoding_stages(), classifier]).fit(training)


def predict(model: PipelineModel, matrix: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Id, ``keep`` columns and the probability of churn."""
    known = [c for c in (ID, "churn", "monthly_charges") if c in matrix.columns]
    probability = vector_to_array("probability")[1].alias("churn_probability")
    return model.transform(matrix).select(*dict.fromkeys([*known, *keep]), probability)


# --- tuning ----------------------------------------------------------------


def draw_settings(
    candidate: Candidate, n: int, seed: int = SEED, fixed: dict[str, object] | None = None
) -> list[dict[str, object]]:
    """``n`` seeded random settings; ``fixed`` overrides what was drawn."""
    rng = np.random.default_rng(seed)
    return [{**candidate.draw(rng), **(fixed or {})} for _ in range(n)]


@dataclass(frozen=True)
class Tuned:
    """The refitted best model and how each setting did."""

    model: PipelineModel
    settings: list[dict[str, object]]
    scores: list[float]

    @property
    def best(self) -> int:
        return int(np.argmax(self.scores))

    def report(self, df: DataFrame, name: str) -> DataFrame:
        rows = [
            (name, i, str(s), float(a), i == self.best)
            for i, (s, a) in enumerate(zip(self.settings, self.scores, strict=True))
        ]
        schema = "model string, candidate int, settings string, mean_roc_auc double, chosen boolean"
        return df.sparkSession.createDataFrame(rows, schema)


def _weight_sum(rows: DataFrame, column: str) -> float:
    return float(rows.agg(F.sum(column)).first()[0])


def cross_validate(
    training: DataFrame,
    candidate: Candidate,
    settings: Sequence[dict[str, object]],
    folds: int = 5,
    seed: int = SEED,
    parallelism: int = 4,
) -> list[float]:
    """Mean ROC-AUC of each setting over stratified folds.

    The encoder is fitted once per fold on that fold's training rows and its output kept for all
    settings, which are then fitted side by side.
    """
    weight = candidate.make().getWeightCol()
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)
    folded = stratified_folds(training, folds, seed)
    scores = np.zeros((folds, len(settings)))
    for fold in range(folds):
        fit_rows, held_rows = folded.where(F.col("fold") != fold), folded.where(F.col("fold") == fold)
        encoder = Pipeline(stages=encoding_stages()).fit(fit_rows)
        fit_set, held_set = (
            encoder.transform(rows).select("features", "label", weight).persist(StorageLevel.MEMORY_AND_DISK)
            for rows in (fit_rows, held_rows)
        )
        weight_sum = _weight_sum(fit_set, weight)

        def score(setting: dict[str, object]) -> float:
            model = candidate.make(**candidate.params(setting, weight_sum)).fit(fit_set)
            return evaluator.evaluate(model.transform(held_set))

        with ThreadPool(parallelism) as pool:
            scores[fold] = pool.map(inheritable_thread_target(training.sparkSession)(score), settings)
        fit_set.unpersist()
        held_set.unpersist()
    return scores.mean(axis=0).tolist()


def tune_model(
    training: DataFrame,
    candidate: Candidate,
    n_iter: int = 15,
    folds: int = 5,
    seed: int = SEED,
    parallelism: int = 4,
    fixed: dict[str, object] | None = None,
) -> Tuned:
    """Random search by cross-validated ROC-AUC; the best setting is refitted on all rows.

    ``training`` is a weighted matrix; store it as a dataset or cache it first, since every fold
    reads it again.
    """
    settings = draw_settings(candidate, n_iter, seed, fixed)
    scores = cross_validate(training, candidate, settings, folds, seed, parallelism)
    best = settings[int(np.argmax(scores))]
    weight_sum = _weight_sum(training, candidate.make().getWeightCol())
    return Tuned(fit_model(training, candidate.make(**candidate.params(best, weight_sum))), settings, scores)


def training_matrix(features: DataFrame) -> DataFrame:
    """Weighted model input from feature rows."""
    matrix = build_feature_matrix(features)
    return with_weights(matrix, class_weights(matrix))


def scaled_numbers(matrix: DataFrame) -> DataFrame:
    """Id and the four numbers, centred and scaled."""
    columns = [f"x_{c}" for c in NUMERIC_FEATURES]
    scaled = PopulationScaler(columns=columns).fit(matrix).transform(matrix)
    return scaled.select(ID, *[F.col(f"z_x_{c}").alias(c) for c in NUMERIC_FEATURES])
