"""The staged job from a raw CSV to recommendations."""

from __future__ import annotations

import pytest

from stayrate.plans import jobs
from stayrate.sources import raw_csv, store
from stayrate.sources.derived import derive_raw


def _reads(frame, table):
    """How often a plan reads a table."""
    leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
    files = [x for x in map(leaves.apply, range(leaves.size())) if x.getClass().getSimpleName() == "LogicalRelation"]
    return sum(x.catalogTable().isDefined() and x.catalogTable().get().identifier().table() == table for x in files)


def test_job_end_to_end(spark, sf_dir, tmp_path, monkeypatch):
    raw_csv.write_csv(derive_raw(spark, sf_dir).drop("seq"), str(tmp_path / "raw"))
    settings = jobs.Settings(
        work=str(tmp_path / "work"),
        raw=str(tmp_path / "raw"),
        table="job_customers",
        clean_table="job_customers_clean",
        recommendations_table="job_recommendations",
        buckets=4,
        strict=False,
        models=("logistic_regression", "boosted_trees"),
        n_iter=1,
        folds=2,
        fixed={"logistic_regression": {"maxIter": 10}, "boosted_trees": {"maxIter": 3, "maxDepth": 3}},
    )
    jobs.run(spark, settings)

    def rows(name):
        return store.read_dataset(spark, settings.path(name))

    cleaned = spark.table("job_customers_clean")
    loaded, bad = rows("customers_loaded").count(), rows("customers_quarantined").count()
    assert loaded == cleaned.count() + bad and bad > 0
    assert {r["model"] for r in rows("model_comparison").collect()} == set(settings.models)
    assert rows("threshold_sweep").count() == 91
    active = cleaned.where("NOT churn").count()
    assert rows("recommendations").count() == active == spark.table("job_recommendations").count()
    assert rows("top_risk").count() == 20
    assert rows("dashboard/customers").count() == cleaned.count()
    assert rows("answers/churn_by_contract").count() == 3
    # The report reads the cleaned customers three times, however many answers it gives.
    read, write = [], store.write_dataset
    monkeypatch.setattr(store, "write_dataset", lambda df, path: (read.append(_reads(df, "job_customers_clean")), write(df, path)))
    jobs.report(spark, settings)
    assert len(read) > 25 and sum(read) == 3
    for table in ("job_customers", "job_customers_clean", "job_recommendations"):
        spark.sql(f"DROP TABLE {table}")


def test_malformed_records_go_to_quarantine_or_stop_a_strict_ingest(spark, small_dir, tmp_path):
    raw_csv.write_csv(derive_raw(spark, small_dir).drop("seq").coalesce(1), str(tmp_path / "raw"))
    (part,) = (tmp_path / "raw").glob("part-*.csv")
    (tmp_path / "raw" / f".{part.name}.crc").unlink()
    part.write_text(part.read_text() + "short,record\n")
    settings = jobs.Settings(work=str(tmp_path / "work"), raw=str(tmp_path / "raw"), table="malformed_customers", strict=False)
    jobs.ingest(spark, settings)
    (bad,) = store.read_dataset(spark, settings.path("malformed_records")).collect()
    assert bad["record"] == "short,record" and bad["file"].endswith(part.name)
    assert spark.table("malformed_customers").where("customer_id = 'short'").count() == 0
    spark.sql("DROP TABLE malformed_customers")
    with pytest.raises(store.RejectedLoad, match="1 record"):
        jobs.ingest(spark, jobs.Settings(work=str(tmp_path / "strict"), raw=str(tmp_path / "raw"), table="malformed_customers"))


def test_strict_ingest_stops_on_bad_rows(spark, small_dir, tmp_path):
    raw_csv.write_csv(derive_raw(spark, small_dir).drop("seq"), str(tmp_path / "raw"))
    settings = jobs.Settings(work=str(tmp_path / "work"), raw=str(tmp_path / "raw"), table="strict_customers")
    with pytest.raises(store.RejectedLoad):
        jobs.ingest(spark, settings)
    assert not spark.catalog.tableExists("strict_customers")
