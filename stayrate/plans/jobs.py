"""The staged batch job: raw CSV in, recommendations and dashboard datasets out.

Each stage reads datasets and writes datasets, so a lost executor costs at most the work of one
stage and any stage can be run again by itself:

    python -m stayrate.plans.jobs --raw s3a://bucket/raw/*.csv --work s3a://bucket/work
    python -m stayrate.plans.jobs --work s3a://bucket/work --stages features train evaluate
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.operators import (
    cleaning,
    dashboard,
    decision,
    eda,
    evaluation,
    features,
    joint,
    metrics,
    modeling,
    quality,
    search,
)
from stayrate.schema import CUSTOMER_COLUMNS
from stayrate.session import build_session
from stayrate.sources import raw_csv, store

STAGES = ["ingest", "validate", "clean", "features", "train", "evaluate", "decide", "report"]


@dataclass(frozen=True)
class Settings:
    """Where the job reads and writes and how hard it searches."""

    work: str
    raw: str | None = None
    table: str = "customers"
    clean_table: str = "customers_clean"
    recommendations_table: str = "retention_recommendations"
    # Both tables are stored in so many buckets by customer_id, which the dashboard joins without a shuffle.
    buckets: int = 16
    strict: bool = True
    # Cells may hold line breaks; a file is then one task.
    multi_line: bool = True
    fit_on: str = "train"
    exact_quantiles: bool = True
    n_iter: int = 15
    folds: int = 5
    parallelism: int = 4
    models: tuple[str, ...] = tuple(modeling.CANDIDATES)
    chosen_model: str | None = None
    fixed: dict[str, dict[str, object]] | None = None

    def path(self, name: str) -> str:
        return f"{self.work.rstrip('/')}/{name}"


def _read(spark: SparkSession, settings: Settings, name: str) -> DataFrame:
    return store.read_dataset(spark, settings.path(name))


def ingest(spark: SparkSession, settings: Settings) -> None:
    """Type the raw rows and replace the customers table; bad rows stop it or go to quarantine."""
    if settings.raw is None:
        raise ValueError("ingest needs the path of the raw CSV")
    # One materialised copy: the file-position order of rows is fixed here for all later stages, and the CSV is read once.
    records = raw_csv.read_raw_records(spark, settings.raw, settings.multi_line)
    store.write_dataset(raw_csv.load_and_flag(records), settings.path("customers_loaded"))
    loaded = _read(spark, settings, "customers_loaded")
    store.write_dataset(quality.check_dtypes(loaded), settings.path("type_report"))
    store.write_dataset(raw_csv.quarantined_records(loaded), settings.path("malformed_records"))
    if settings.strict and (n := _read(spark, settings, "malformed_records").count()):
        raise store.RejectedLoad(f"{n} record(s) don't fit the header, see {settings.path('malformed_records')}")
    rows = loaded.where("malformed IS NULL").drop("malformed", "unreadable")
    if not settings.strict:
        store.write_dataset(quality.with_violations(rows), settings.path("customers_checked"))
        checked = _read(spark, settings, "customers_checked")
        sound = F.size("violations") == 0
        store.write_dataset(checked.where(~sound), settings.path("customers_quarantined"))
        rows = checked.where(sound).drop("violations")
    store.full_refresh(rows, settings.table, settings.path("customers"))


def validate(spark: SparkSession, settings: Settings) -> None:
    """All quality checks on the table, as one long report."""
    rows = spark.table(settings.table)
    checks = [
        quality.check_missing_values,
        quality.check_duplicate_ids,
        quality.check_blank_total_charges,
        quality.check_categorical_values,
    ]
    report = reduce(DataFrame.unionByName, [check(rows) for check in checks])
    store.write_dataset(report, settings.path("quality_report"))


def clean(spark: SparkSession, settings: Settings) -> None:
    cleaned = cleaning.clean(spark.table(settings.table)).select(*CUSTOMER_COLUMNS)
    store.replace_table(cleaned, settings.clean_table, settings.path("customers_clean"), buckets=settings.buckets)


def engineer(spark: SparkSession, settings: Settings) -> None:
    """Split, cut points from the training rows (or from all), features."""
    split = modeling.stratified_split(spark.table(settings.clean_table))
    fit_rows = split.where("split = 'train'") if settings.fit_on == "train" else split
    cuts = features.fit_features(fit_rows, settings.exact_quantiles)
    store.write_dataset(cuts.to_frame(spark), settings.path("feature_cuts"))
    store.write_dataset(features.apply_features(split, cuts), settings.path("customers_features"))


def train(spark: SparkSession, settings: Settings) -> None:
    """Search all models' settings in one journal, refit each winner on the training rows and save it.

    Started again after a loss, the search goes on where the journal ends.
    """
    rows = _read(spark, settings, "customers_features").where("split = 'train'")
    store.write_dataset(modeling.training_matrix(rows), settings.path("training_matrix"))
    training = _read(spark, settings, "training_matrix")
    journal = search.journaled_search(
        training,
        settings.path("search_journal"),
        settings.models,
        settings.n_iter,
        settings.folds,
        parallelism=settings.parallelism,
        fixed=settings.fixed,
    )
    scores = journal.scores().where(F.col("model").isin(*settings.models) & (F.col("candidate") < settings.n_iter))
    store.write_dataset(search.report(scores), settings.path("search"))
    for name, chosen in search.winners(scores).items():
        store.save_model(search.refitted(training, modeling.CANDIDATES[name], chosen), settings.path(f"models/{name}"))


def evaluate(spark: SparkSession, settings: Settings) -> None:
    """Score the held-out rows with every model and compare at 0.5."""
    rows = _read(spark, settings, "customers_features").where("split = 'test'")
    scored = {}
    for name in settings.models:
        model = store.load_model(settings.path(f"models/{name}"))
        predictions = modeling.predict(model, modeling.build_feature_matrix(rows))
        store.write_dataset(decision.with_clv(predictions), settings.path(f"test_scores/{name}"))
        scored[name] = _read(spark, settings, f"test_scores/{name}")
    store.write_dataset(evaluation.compare_models(scored), settings.path("model_comparison"))


def decide(spark: SparkSession, settings: Settings) -> None:
    """Threshold by back-tested value on held-out rows, then actions for active customers."""
    name = settings.chosen_model
    if name is None:
        ranked = _read(spark, settings, "model_comparison").orderBy(F.desc_nulls_last("roc_auc"), "model")
        name = ranked.first()["model"]
    scored = _read(spark, settings, f"test_scores/{name}")
    # One pass over the scores answers all that is asked of the thresholds.
    store.write_dataset(decision.swept(scored), settings.path("swept"))
    swept = _read(spark, settings, "swept")
    store.write_dataset(swept.select("threshold", "business_value"), settings.path("threshold_sweep"))
    store.write_dataset(decision.rates_at_best(swept), settings.path("rates_at_optimum"))
    store.write_dataset(decision.points_of(swept), settings.path("reference_points"))
    best = decision.best_threshold(_read(spark, settings, "threshold_sweep")).first()["threshold"]
    model = store.load_model(settings.path(f"models/{name}"))
    active = _read(spark, settings, "customers_features").where(~F.col("churn"))
    predictions = modeling.predict(model, modeling.build_feature_matrix(active))
    store.write_dataset(decision.recommend(predictions, best), settings.path("recommendations"))
    rows = _read(spark, settings, "recommendations")
    store.replace_recommendations(
        rows, settings.recommendations_table, settings.path("recommendations_table"), settings.buckets
    )
    store.write_dataset(decision.top_risk(rows), settings.path("top_risk"))
    store.write_dataset(decision.action_counts(rows), settings.path("action_counts"))


#: Questions whose answers are sums and counts over categories and tenure.
ROLLED_UP = [
    metrics.overall_churn,
    metrics.churn_by_demographics,
    metrics.tenure_by_churn,
    metrics.revenue_totals,
    metrics.revenue_lost,
    metrics.revenue_by_contract,
    metrics.churn_by_contract,
    metrics.tenure_by_contract,
    metrics.churn_by_payment,
    metrics.churn_by_paperless,
    metrics.churn_by_risk_segment,
    metrics.churn_by_internet,
    metrics.churn_by_add_on,
    metrics.churn_by_tenure_bucket,
    metrics.churn_matrix,
    eda.churn_counts,
]
#: Questions that need each customer's amounts.
BY_CUSTOMER = [metrics.churn_by_spend_quartile, eda.correlations, eda.boxplots]
AMOUNTS = ["customer_id", *eda.CORRELATED]


def report(spark: SparkSession, settings: Settings) -> None:
    """Business answers, chart numbers and dashboard datasets.

    The cleaned customers are read three times: for the joint aggregate, for the narrow table of amounts, and for the
    dashboard's own rows. Answers are rolled up from the first or computed on the second.
    """
    customers = spark.table(settings.clean_table)
    recommendations = spark.table(settings.recommendations_table)
    best = decision.best_threshold(_read(spark, settings, "threshold_sweep")).first()["threshold"]
    store.write_dataset(joint.joint_aggregate(customers), settings.path("joint_aggregate"))
    store.write_dataset(customers.select(*AMOUNTS), settings.path("amounts"))
    cells, amounts = _read(spark, settings, "joint_aggregate"), _read(spark, settings, "amounts")
    store.write_dataset(joint.counted_customers(amounts, ["churn", "monthly_charges"]), settings.path("charge_counts"))
    charge_counts = _read(spark, settings, "charge_counts")
    pages = {
        "dashboard/customers": dashboard.customer_dashboard(customers, recommendations),
        "dashboard/contract_mix": dashboard.contract_mix(cells),
        "dashboard/breakdowns": dashboard.churn_breakdowns(cells),
        "dashboard/worklist_totals": dashboard.worklist_totals(recommendations),
    }
    pages |= {f"answers/{answer.__name__}": answer(cells) for answer in ROLLED_UP}
    pages |= {f"answers/{answer.__name__}": answer(amounts) for answer in BY_CUSTOMER}
    pages["answers/density"] = eda.density(charge_counts)
    pages["answers/charge_histogram"] = eda.histogram(charge_counts, "monthly_charges", 40)
    pages["answers/tenure_histogram"] = eda.histogram(cells, "tenure_months", 36)
    for name, page in pages.items():
        store.write_dataset(page, settings.path(name))
    cards = dashboard.kpi_cards(_read(spark, settings, "dashboard/customers"), best)
    store.write_dataset(cards, settings.path("dashboard/kpi_cards"))


RUN = dict(zip(STAGES, [ingest, validate, clean, engineer, train, evaluate, decide, report], strict=True))


def run(spark: SparkSession, settings: Settings, stages: Sequence[str] = tuple(STAGES)) -> None:
    for stage in stages:
        RUN[stage](spark, settings)


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--work", required=True, help="folder for all datasets")
    parser.add_argument("--raw", help="path of the raw CSV (ingest)")
    parser.add_argument("--stages", nargs="+", choices=STAGES, default=STAGES)
    parser.add_argument("--quarantine", action="store_true", help="set bad rows aside instead of stopping")
    parser.add_argument("--fit-on", choices=["train", "all"], default="train")
    parser.add_argument("--approximate-quantiles", action="store_true")
    parser.add_argument("--n-iter", type=int, default=15)
    parser.add_argument("--folds", type=int, default=5)
    parser.add_argument("--one-line-records", action="store_true", help="no line breaks in cells: files can be cut")
    parser.add_argument("--buckets", type=int, default=16, help="buckets of the customers and recommendations tables")
    parser.add_argument("--model", choices=list(modeling.CANDIDATES), help="decide with this model")
    args = parser.parse_args()
    settings = Settings(
        work=args.work,
        raw=args.raw,
        strict=not args.quarantine,
        fit_on=args.fit_on,
        exact_quantiles=not args.approximate_quantiles,
        n_iter=args.n_iter,
        folds=args.folds,
        buckets=args.buckets,
        multi_line=not args.one_line_records,
        chosen_model=args.model,
    )
    run(build_session(), settings, args.stages)


if __name__ == "__main__":
    main()
