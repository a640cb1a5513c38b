"""The search journal: whole, shared folds, resumed after a loss."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from stayrate.operators import cleaning, features, modeling, search
from stayrate.plans import invariants, registry

SMALL = {
    "logistic_regression": {"maxIter": 5},
    "random_forest": {"numTrees": 4, "maxDepth": 3},
    "boosted_trees": {"maxIter": 2, "maxDepth": 2},
}


@pytest.fixture(scope="module")
def training(customers):
    return modeling.training_matrix(features.engineer_features(cleaning.fill_total_charges(customers))).cache()


@pytest.fixture
def added(monkeypatch):
    """The (model, candidate, fold) noted so far."""
    seen, add = [], search.SearchJournal.add

    def note(self, model, candidate, fold, settings, score):
        seen.append((model, candidate, fold))
        add(self, model, candidate, fold, settings, score)

    monkeypatch.setattr(search.SearchJournal, "add", note)
    return seen


def test_every_model_setting_and_fold_is_scored_once(training, tmp_path, added):
    journal = search.journaled_search(training, str(tmp_path), n_iter=2, folds=2, fixed=SMALL)
    rows = journal.scores().collect()
    assert sorted((r["model"], r["candidate"], r["fold"]) for r in rows) == sorted(added)
    assert len(added) == 3 * 2 * 2 and min(r["roc_auc"] for r in rows) > 0.5
    best = {}
    for r in rows:
        best.setdefault((r["model"], r["candidate"]), []).append(r["roc_auc"])
    report = search.report(journal.scores()).collect()
    assert {(r["model"], r["candidate"]): r["mean_roc_auc"] for r in report} == pytest.approx({k: sum(v) / 2 for k, v in best.items()})
    chosen = {r["model"]: r["mean_roc_auc"] for r in report if r["chosen"]}
    assert all(r["mean_roc_auc"] <= chosen[r["model"]] for r in report) and len(chosen) == 3
    model = search.refitted(training, modeling.CANDIDATES["boosted_trees"], search.winners(journal.scores())["boosted_trees"])
    assert model.stages[-1].getNumTrees == 2


def test_a_lost_search_goes_on_where_it_ended(training, tmp_path, added, monkeypatch):
    run = lambda n: search.journaled_search(training, str(tmp_path), ["logistic_regression"], n, 2, parallelism=1, fixed=SMALL)
    add = search.SearchJournal.add

    def lost(self, *entry):
        if len(added) == 3:
            raise ConnectionError("driver lost")
        add(self, *entry)

    monkeypatch.setattr(search.SearchJournal, "add", lost)
    with pytest.raises(ConnectionError):
        run(3)
    assert len(added) == 3
    monkeypatch.setattr(search.SearchJournal, "add", add)
    first = run(3)
    assert sorted(added) == [("logistic_regression", c, f) for c in range(3) for f in range(2)]
    prepared = []
    monkeypatch.setattr(search.Pipeline, "fit", lambda *a: prepared.append(a))
    again = run(3)
    assert not prepared and len(added) == 6
    assert again.scores().exceptAll(first.scores()).count() == 0


def test_other_rows_make_another_journal(training, tmp_path, added):
    run = lambda rows: search.journaled_search(rows, str(tmp_path), ["logistic_regression"], 1, 2, fixed=SMALL)
    one, two = run(training), run(training.where(F.col("x_tenure_months") > 3))
    assert one.path != two.path and len(added) == 4
    assert run(training.repartition(5)).path == one.path and len(added) == 4


def test_another_setting_in_the_same_place_is_refused(training, tmp_path):
    run = lambda fixed: search.journaled_search(training, str(tmp_path), ["logistic_regression"], 1, 2, fixed=fixed)
    run(SMALL)
    with pytest.raises(ValueError, match="was scored with"):
        run({"logistic_regression": {"maxIter": 6}})


def test_folds_are_encoded_on_their_training_rows(training, tmp_path):
    journal = search.SearchJournal(training.sparkSession, str(tmp_path), 2)
    journal.prepare(training)
    held = [set(r[0] for r in journal.fold(k).where("held").select("customer_id").collect()) for k in range(2)]
    assert not held[0] & held[1] and len(held[0] | held[1]) == training.count()
    assert journal.fold(0).columns == ["customer_id", "held", "features", "label", "balanced_weight", "positive_weight"]


def test_many_rows_are_dealt_evenly_and_few_stay(spark):
    one = spark.range(0, 300_000, 1, 1)
    sizes = lambda df: [len(list(p)) for p in df.rdd.glom().collect()]
    dealt = sizes(modeling.spread(one, 300_000))
    assert len(dealt) == 8 and max(dealt) < 1.1 * min(dealt)
    assert len(sizes(modeling.spread(one, 300_000, side_by_side=4))) == 2
    assert modeling.spread(one, 6_000_000, side_by_side=4).rdd.getNumPartitions() == 12
    assert modeling.spread(one, 20_000).rdd.getNumPartitions() == 1


def test_fits_of_a_fold_share_the_cores(training, tmp_path, monkeypatch):
    """A fold that was written as one file is fitted by several tasks."""
    seen, fit = [], modeling.LogisticRegression.fit
    monkeypatch.setattr(modeling, "TASK_ROWS", 100)
    monkeypatch.setattr(modeling.LogisticRegression, "fit", lambda self, rows: seen.append(rows.rdd.getNumPartitions()) or fit(self, rows))
    search.journaled_search(training.coalesce(1), str(tmp_path), ["logistic_regression"], 2, 2, parallelism=2, fixed=SMALL)
    assert seen == [4] * 4


def test_models_refitted_together_are_those_of_a_pipeline(training, monkeypatch):
    encoded, fit = [], search.Pipeline.fit
    settings = {"logistic_regression": {"C": 1.0, "maxIter": 5}, "boosted_trees": {"maxIter": 3, "maxDepth": 2}}
    wanted = {}
    for name, chosen in settings.items():
        candidate = modeling.CANDIDATES[name]
        weight = float(training.agg(F.sum(candidate.make().getWeightCol())).first()[0])
        wanted[name] = modeling.fit_model(training, candidate.make(**candidate.params(chosen, weight)))
    monkeypatch.setattr(search.Pipeline, "fit", lambda self, rows: encoded.append(1) or fit(self, rows))
    for name, model in search.refitted_all(training, settings).items():
        a, b = (modeling.predict(m, training).select("customer_id", "churn_probability") for m in (model, wanted[name]))
        far = a.join(b.withColumnRenamed("churn_probability", "p"), "customer_id").where("abs(p - churn_probability) > 1e-9")
        assert far.count() == 0
    assert encoded == [1]


def test_a_score_is_noted_without_rows_from_python(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: pytest.fail("rows from Python"))
    journal = search.SearchJournal(spark, str(tmp_path), 2)
    journal.add("logistic_regression", 0, 1, '{"C": 1.0}', 0.1 + 0.2)
    assert journal.has("logistic_regression", 0, 1, '{"C": 1.0}')
    assert [tuple(r) for r in journal.scores().collect()] == [("logistic_regression", 0, 1, '{"C": 1.0}', 0.1 + 0.2)]


def test_held_out_customers_are_scored_once(spark, small_dir, monkeypatch):
    scored, predict = [], modeling.predict
    monkeypatch.setattr(modeling, "predict", lambda *a, **k: scored.append(1) or predict(*a, **k))
    registry._scores_path.cache_clear()
    first, again = (registry.held_out_scores(spark, small_dir, "logistic_regression") for _ in range(2))
    assert scored == [1] and first.exceptAll(again).count() == 0 and first.count() > 0
    held = registry.split_features(spark, small_dir, "test").select("customer_id")
    assert held.exceptAll(first.select("customer_id")).count() == 0


def test_scoring_is_dealt_to_all_cores(spark, small_dir, monkeypatch):
    monkeypatch.setattr(modeling, "TASK_ROWS", 10)
    stored = registry.saved_model_scores(spark, small_dir)
    advised = registry.model_recommendations(spark, small_dir, "logistic_regression")
    assert stored.rdd.getNumPartitions() > 1 and advised.rdd.getNumPartitions() == 8
    rows = registry.store.read_dataset(spark, registry._split_path(spark.sparkContext.applicationId, small_dir))
    active = rows.where("not churn").select("customer_id")
    assert active.exceptAll(advised.select("customer_id")).count() == 0 and advised.count() == active.count()


@pytest.fixture
def small_registered_search(spark, monkeypatch):
    """The registered search over rows of its own, with one setting of few rounds for each model and two folds."""
    pick = lambda values, every: F.get(F.array(*[F.lit(v) for v in values]), (F.col("id") / every).cast("int") % len(values))
    rows = spark.range(160, numPartitions=1).select(
        F.format_string("C%04d", "id").alias("customer_id"),
        *[pick(["a", "b", "c"], i + 1).alias(c) for i, c in enumerate(registry.CATEGORICAL_FEATURES)],
        *[((F.col("id") / (i + 1)).cast("int") % 2 == 0).alias(c) for i, c in enumerate(registry.BOOLEAN_FEATURES)],
        *[(F.col("id") * (i + 3) % 37).alias(c) for i, c in enumerate(modeling.NUMERIC_FEATURES) if c != "monthly_charges"],
        (F.col("id") % 41).cast("decimal(8,2)").alias("monthly_charges"),
        (F.col("id") % 41 + F.col("id") % 7 > 30).alias("churn"),
    )
    run = search.journaled_search
    monkeypatch.setattr(registry, "training_rows", lambda *a: modeling.training_matrix(rows))
    monkeypatch.setattr(search, "journaled_search", lambda *a: run(*a, n_iter=1, folds=2, fixed=SMALL))
    registry._journal.cache_clear()
    yield
    registry._journal.cache_clear()


def test_the_registered_journal_holds_every_model(spark, small_registered_search):
    """Also where no folder of the journal is set."""
    assert spark.conf.get(registry.JOURNAL_CONF, None) is None
    rows = registry.QUERIES["m10_search_journal"](spark, "own").collect()
    assert sorted((r["model"], r["candidate"], r["fold"]) for r in rows) == [(m, 0, k) for m in sorted(modeling.CANDIDATES) for k in range(2)]
    chosen = registry.QUERIES["m10_tune_model"](spark, "own").where("chosen").collect()
    assert sorted(r["model"] for r in chosen) == sorted(modeling.CANDIDATES)


def test_a_whole_search_is_one_of_every_model(spark, small_registered_search):
    """The check shows all three models, and its SQL asks for them."""
    rows = invariants.QUERIES["m10_search_is_whole"](spark, "own").collect()
    wanted = duckdb.sql(invariants.ORACLE["m10_search_is_whole"]).fetchall()
    assert sorted(r["model"] for r in rows) == sorted(r[0] for r in wanted) == sorted(modeling.CANDIDATES)
    assert all((r["fits"], r["candidates"], r["chosen"], r["best_chosen"]) == (2, 1, 1, True) for r in rows)
    assert all(r[1:] == (75, 15, True, 1, True, True) for r in wanted)
