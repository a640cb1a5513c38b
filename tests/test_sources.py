"""CSV, tables, buckets and connection settings."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stayrate.operators import decision
from stayrate.schema import COLUMN_MAP, CUSTOMER_COLUMNS
from stayrate.operators import quality
from stayrate.sources import database, raw_csv, store
from stayrate.sources.derived import derive_raw


def test_csv_is_matched_by_header_and_ordered_by_file(spark, tmp_path):
    names = list(reversed(COLUMN_MAP))
    for file, ids in (("a.csv", ["1", "2"]), ("b.csv", ["3"] * 50)):
        lines = [",".join(i if n == "customerID" else "NA" if n == "InternetService" else "Yes" for n in names) for i in ids]
        (tmp_path / file).write_text("\n".join([",".join(names), *lines]))
    rows = raw_csv.load_and_coerce(raw_csv.read_raw_csv(spark, str(tmp_path))).orderBy("seq").collect()
    assert [r["customer_id"] for r in rows] == ["1", "2"] + ["3"] * 50
    assert rows[0]["internet_service"] is None and rows[0]["churn"] is True


def test_csv_without_a_column_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text("customerID,gender\n1,Male\n")
    with pytest.raises(ValueError, match="SeniorCitizen"):
        raw_csv.read_raw_csv(spark, str(tmp_path))


def test_csv_round_trip_keeps_padding_and_quotes(spark, small_dir, tmp_path):
    raw = derive_raw(spark, small_dir).drop("seq").withColumn("Contract", F.lit(' a "quoted", text '))
    raw_csv.write_csv(raw, str(tmp_path / "out"))
    again = raw_csv.read_raw_csv(spark, str(tmp_path / "out")).drop("seq")
    assert raw.select(*again.columns).exceptAll(again).count() == 0


def _csv(folder, lines):
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join([",".join(COLUMN_MAP), *lines]))
    return str(folder)


def test_line_breaks_in_cells_and_malformed_records(spark, tmp_path):
    whole = lambda i, **odd: ",".join(odd.get(c, i if c == "customerID" else "Yes") for c in COLUMN_MAP)
    path = _csv(
        tmp_path / "in",
        [whole("1"), whole("2", Contract='"Two\nyear, ""old"""'), "3,Male", whole("4") + ",more", whole("5", tenure="ten", TotalCharges="x"), '6,"never closed'],
    )
    store.write_dataset(raw_csv.load_and_flag(raw_csv.read_raw_records(spark, path)), str(tmp_path / "loaded"))
    records = store.read_dataset(spark, str(tmp_path / "loaded"))
    rows = {r["customer_id"]: r for r in records.collect()}
    assert rows["2"]["contract_type"] == 'Two\nyear, "old"' and rows["2"]["malformed"] is None
    assert rows["1"]["unreadable"] == ["tenure_months", "monthly_charges", "total_charges"]
    bad = raw_csv.quarantined_records(records).orderBy("position").collect()
    assert [r["record"].split(",")[0] for r in bad] == ["3", "4", "6"]
    assert all(r["file"].endswith("a.csv") and r["reason"] for r in bad)
    cut = raw_csv.read_raw_csv(spark, path, multi_line=False)
    assert cut.count() == 7 and "malformed" not in cut.columns


def test_flags_are_counted_from_loaded_rows(spark, small_dir):
    raw = derive_raw(spark, small_dir)
    flagged = quality.check_dtypes(raw_csv.load_and_flag(raw))
    assert flagged.exceptAll(quality.check_dtypes(raw_csv.rename_columns(raw))).count() == 0


def test_refresh_replaces_rows_or_leaves_them(spark, customers, tmp_path):
    base = str(tmp_path / "customers")
    store.full_refresh(customers, "refreshed", base)
    store.full_refresh(customers.where("churn"), "refreshed", base)
    kept = spark.table("refreshed").count()
    assert kept == customers.where("churn").count()
    with pytest.raises(store.RejectedLoad, match="domain"):
        store.full_refresh(customers.withColumn("gender", F.lit("?")), "refreshed", base)
    assert spark.table("refreshed").count() == kept
    spark.sql("DROP TABLE refreshed")


def test_bucketed_tables_join_without_a_shuffle(spark, customers, scores, tmp_path):
    store.save_bucketed(customers.select(*CUSTOMER_COLUMNS), "bucketed_customers", 4, str(tmp_path / "c"))
    rows = decision.recommend(scores, 0.2)
    folder = store.replace_recommendations(rows, "bucketed_recommendations", str(tmp_path / "r"), 4)
    assert len(list(Path(folder).glob("part-*"))) <= 4 and len(list((tmp_path / "c").glob("part-*"))) <= 4
    joined = spark.table("bucketed_customers").hint("merge").join(spark.table("bucketed_recommendations"), "customer_id", "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == customers.count()
    spark.sql("DROP TABLE bucketed_customers")
    spark.sql("DROP TABLE bucketed_recommendations")


def test_recommendations_are_replaced(spark, scores, tmp_path):
    for threshold in (0.2, 0.5, 0.7, 0.9):
        rows = decision.recommend(scores, threshold)
        store.replace_recommendations(rows, "recs", str(tmp_path / "recs"))
        assert sorted(decision.action_counts(spark.table("recs")).collect()) == sorted(decision.action_counts(rows).collect())
    assert len(list((tmp_path / "recs").glob("load-*"))) == 2
    with pytest.raises(store.RejectedLoad, match="columns"):
        store.replace_table(rows.withColumn("clv", F.lit(1)), "recs", str(tmp_path / "recs"))
    spark.sql("DROP TABLE recs")


ENV = {"POSTGRES_HOST": "db", "POSTGRES_PORT": "5432", "POSTGRES_DB": "telecom", "POSTGRES_USER": "u", "POSTGRES_PASSWORD": "p"}


def test_connection_options():
    options = database.connection_options(ENV)
    assert options["url"] == "jdbc:postgresql://db:5432/telecom" and options["user"] == "u"


def test_absent_settings_are_named():
    with pytest.raises(RuntimeError, match="POSTGRES_DB, POSTGRES_PASSWORD"):
        database.connection_options({**ENV, "POSTGRES_DB": "", "POSTGRES_PASSWORD": ""})


def test_slices_cover_all_pages_whatever_the_keys():
    assert database.block_slices(10, 2) == ["ctid >= '(0,0)'::tid AND ctid < '(5,0)'::tid", "ctid >= '(5,0)'::tid"]
    assert database.block_slices(0, 8) == ["ctid >= '(0,0)'::tid"]
    assert len(database.block_slices(3, 64)) == 3


def test_a_load_is_staged_and_swapped_as_one_transaction():
    statements = database.swap_statements("t", "t_load_1")
    assert statements[0] == "BEGIN" and statements[-1] == "COMMIT"
    assert statements.index("TRUNCATE t") < statements.index("INSERT INTO t SELECT * FROM t_load_1")
    assert database.write_options({"url": "u"}, "t_load_1")["dbtable"] == "t_load_1"


def test_no_local_checkpoints_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from stayrate.session import checkpoint_dir

    def session(master, configured=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda folder: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: configured), sparkContext=context)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="checkpoint"):
            checkpoint_dir(session(master))
        assert checkpoint_dir(session(master, "s3a://b/c")) == "s3a://b/c"
    assert checkpoint_dir(session("local[2]"))
