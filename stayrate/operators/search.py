"""The random search over models as a journal that outlives its driver.

A folder holds the encoded folds, made once and read by every model, and one row for each
(model, candidate, fold) that was scored. A search that is started again on the same data reads the rows that are
there and fits only what is missing.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayrate.operators.modeling import (
    CANDIDATES,
    ID,
    SEED,
    Candidate,
    draw_settings,
    encoding_stages,
    spread,
    stratified_folds,
)
from stayrate.sources import store

ROW = "settings string, roc_auc double"
JOURNAL = "model string, candidate int, fold int, settings string, roc_auc double"
WEIGHTS = ["balanced_weight", "positive_weight"]


def identity(training: DataFrame, folds: int, seed: int) -> str:
    """A name for training rows and how they are dealt to folds: equal rows have equal names."""
    columns = sorted(training.columns)
    row = training.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("hashes")
    ).first()
    return f"{row['n']}-{abs(int(row['hashes'] or 0)) % 16**12:012x}-{folds}-{seed}"


@dataclass(frozen=True)
class SearchJournal:
    """The folder of one search: `folds/<k>` are encoded folds, `scores/` the journal."""

    spark: SparkSession
    path: str
    folds: int

    def _done(self, folder: str) -> bool:
        """Whether a dataset was written to its end."""
        jvm = self.spark.sparkContext._jvm
        mark = jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
        return mark.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)

    def prepare(self, training: DataFrame, seed: int = SEED) -> None:
        """Encode every fold that isn't there yet: features fitted on its training rows, held marks the others."""
        folded = None
        for k in range(self.folds):
            folder = f"{self.path}/folds/{k}"
            if self._done(folder):
                continue
            folded = stratified_folds(training, self.folds, seed) if folded is None else folded
            marked = folded.withColumn("held", F.col("fold") == k)
            encoder = Pipeline(stages=encoding_stages()).fit(marked.where("not held"))
            store.write_dataset(encoder.transform(marked).select(ID, "held", "features", "label", *WEIGHTS), folder)

    def fold(self, k: int) -> DataFrame:
        return store.read_dataset(self.spark, f"{self.path}/folds/{k}")

    def _entry(self, model: str, candidate: int, fold: int) -> str:
        return f"{self.path}/scores/model={model}/candidate={candidate}/fold={fold}"

    def has(self, model: str, candidate: int, fold: int, settings: str) -> bool:
        """Whether this fit was scored; another setting at the same place is an error, not a match."""
        folder = self._entry(model, candidate, fold)
        if not self._done(folder):
            return False
        if (had := self.spark.read.schema(ROW).parquet(folder).first()["settings"]) != settings:
            raise ValueError(f"{model} {candidate} was scored with {had}, not with {settings}")
        return True

    def add(self, model: str, candidate: int, fold: int, settings: str, score: float) -> None:
        """Note a score in a folder of its own, so that fits side by side don't disturb each other."""
        row = self.spark.range(1, numPartitions=1).select(F.lit(settings).alias("settings"), F.lit(float(score)).alias("roc_auc"))
        store.write_dataset(row, self._entry(model, candidate, fold))

    def scores(self) -> DataFrame:
        """All rows of the journal."""
        names = [n.split()[0] for n in JOURNAL.split(", ")]
        return self.spark.read.schema(JOURNAL).parquet(f"{self.path}/scores").select(*names)


def report(scores: DataFrame) -> DataFrame:
    """Mean score and number of folds of each candidate; the first of a model's best ones is chosen."""
    means = scores.groupBy("model", "candidate", "settings").agg(
        F.count(F.lit(1)).alias("folds"), F.avg("roc_auc").alias("mean_roc_auc")
    )
    place = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("mean_roc_auc"), "candidate"))
    return means.withColumn("chosen", place == 1)


def winners(scores: DataFrame) -> dict[str, dict[str, object]]:
    """The chosen settings of each model (a row a model)."""
    return {r["model"]: json.loads(r["settings"]) for r in report(scores).where("chosen").collect()}


def journaled_search(
    training: DataFrame,
    path: str,
    models: Sequence[str] = tuple(CANDIDATES),
    n_iter: int = 15,
    folds: int = 5,
    seed: int = SEED,
    parallelism: int = 4,
    fixed: Mapping[str, dict[str, object]] | None = None,
) -> SearchJournal:
    """Score `n_iter` drawn settings of each model on every fold, as far as the journal lacks them.

    The folder is one below `path` with the name of the training rows, so other rows make another journal. A lost
    driver loses the fits that were running; all others are found again. Two searches at once are not guarded against.
    """
    spark = training.sparkSession
    journal = SearchJournal(spark, f"{path.rstrip('/')}/{identity(training, folds, seed)}", folds)
    journal.prepare(training, seed)
    evaluator = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)
    wanted = [
        (name, i, settings)
        for name in models
        for i, settings in enumerate(draw_settings(CANDIDATES[name], n_iter, seed, (fixed or {}).get(name)))
    ]
    for k in range(folds):
        open_fits = [
            (name, i, settings)
            for name, i, settings in wanted
            if not journal.has(name, i, k, json.dumps(settings, sort_keys=True))
        ]
        if not open_fits:
            continue
        rows = journal.fold(k).select("held", "features", "label", *WEIGHTS)
        sizes = {r["held"]: r["count"] for r in rows.groupBy("held").count().collect()}
        fit_set, held_set = (
            spread(rows.where(F.col("held") == held).drop("held"), sizes.get(held, 0), parallelism).persist()
            for held in (False, True)
        )
        sums = fit_set.agg(*[F.sum(w).alias(w) for w in WEIGHTS]).first()

        def score(one: tuple[str, int, dict[str, object]]) -> None:
            name, i, settings = one
            candidate = CANDIDATES[name]
            made = candidate.make(**candidate.params(settings, float(sums[candidate.make().getWeightCol()])))
            area = evaluator.evaluate(made.fit(fit_set).transform(held_set))
            journal.add(name, i, k, json.dumps(settings, sort_keys=True), area)

        try:
            with ThreadPool(parallelism) as pool:
                pool.map(inheritable_thread_target(spark)(score), open_fits, chunksize=1)
        finally:
            fit_set.unpersist()
            held_set.unpersist()
    return journal


def fitted_on(encoder: PipelineModel, encoded: DataFrame, candidate: Candidate, settings: dict[str, object]) -> PipelineModel:
    """The encoder and a classifier fitted on what it encoded."""
    weight_sum = float(encoded.agg(F.sum(candidate.make().getWeightCol())).first()[0])
    classifier = candidate.make(**candidate.params(settings, weight_sum)).fit(encoded)
    return PipelineModel([*encoder.stages, classifier])


def refitted(training: DataFrame, candidate: Candidate, settings: dict[str, object]) -> PipelineModel:
    """A model with these settings, fitted on all training rows."""
    return refitted_all(training, {candidate.name: settings})[candidate.name]


def refitted_all(training: DataFrame, settings: Mapping[str, dict[str, object]]) -> dict[str, PipelineModel]:
    """A model for each name and its settings, fitted side by side on all training rows, which are encoded once."""
    encoder = Pipeline(stages=encoding_stages()).fit(training)
    encoded = encoder.transform(spread(training, training.count())).select("features", "label", *WEIGHTS).persist()

    def fit(name: str) -> PipelineModel:
        return fitted_on(encoder, encoded, CANDIDATES[name], settings[name])

    try:
        with ThreadPool(max(1, len(settings))) as pool:
            models = pool.map(inheritable_thread_target(training.sparkSession)(fit), settings, chunksize=1)
    finally:
        encoded.unpersist()
    return dict(zip(settings, models, strict=True))
