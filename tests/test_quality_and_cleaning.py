"""Checks and cleaning on rows spoilt one way at a time."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayrate.operators import cleaning, quality
from stayrate.schema import COLUMN_MAP, WHITESPACE
from stayrate.sources import raw_csv, store

GOOD = {
    "customerID": "0001-AAAAA", "gender": "Female", "SeniorCitizen": "0", "Partner": "Yes", "Dependents": "No",
    "tenure": "10", "PhoneService": "Yes", "MultipleLines": "No", "InternetService": "DSL", "OnlineSecurity": "No",
    "OnlineBackup": "Yes", "DeviceProtection": "No", "TechSupport": "No", "StreamingTV": "No", "StreamingMovies": "No",
    "Contract": "Month-to-month", "PaperlessBilling": "Yes", "PaymentMethod": "Electronic check",
    "MonthlyCharges": "29.85", "TotalCharges": "298.50", "Churn": "No",
}


def _raw(spark, *changes):
    rows = [(i, *{**GOOD, "customerID": f"id-{i}", **change}.values()) for i, change in enumerate(changes)]
    return spark.createDataFrame(rows, "seq int, " + ", ".join(f"{c} string" for c in COLUMN_MAP))


def _load(spark, *changes):
    return raw_csv.load_and_coerce(_raw(spark, *changes))


def _found(report):
    return {(r["check_name"], r["column_name"]): r["n"] for r in report.collect() if r["n"]}


def test_types_of_a_good_row(spark):
    row = _load(spark, {}).first()
    assert (row["partner"], row["dependents"], row["senior_citizen"], row["tenure_months"]) == (True, False, False, 10)
    assert (row["monthly_charges"], row["total_charges"]) == (Decimal("29.85"), Decimal("298.50"))


def test_unreadable_cells_become_null(spark):
    row = _load(spark, {"TotalCharges": " ", "Partner": "Y", "MonthlyCharges": "n.a."}).first()
    assert (row["total_charges"], row["partner"], row["monthly_charges"]) == (None, None, None)


def test_good_rows_break_nothing(spark):
    assert _found(quality.constraint_report(_load(spark, {}, {"InternetService": None}))) == {}


@pytest.mark.parametrize(
    ("change", "broken"),
    [
        ({"Contract": "Weekly"}, ("domain", "contract_type")),
        ({"Partner": "Y"}, ("not_null", "partner")),
        ({"tenure": "-1"}, ("non_negative", "tenure_months")),
        ({"MonthlyCharges": "-1"}, ("non_negative", "monthly_charges")),
        ({"customerID": "x" * 21}, ("max_length", "customer_id")),
        ({"customerID": "id-0"}, ("unique", "customer_id")),
        ({"customerID": None}, ("not_null", "customer_id")),
    ],
)
def test_each_constraint(spark, change, broken):
    rows = _load(spark, {}, change)
    assert broken in _found(quality.constraint_report(rows))
    good, bad = quality.split_valid(rows)
    assert [r["seq"] for r in good.collect()] == [0]
    assert bad.where(F.array_contains("violations", ":".join(broken))).count() == 1
    with pytest.raises(store.RejectedLoad, match=broken[0]):
        store.require_valid(rows)


def test_missing_values_lists_only_columns_with_some(spark):
    report = quality.check_missing_values(_load(spark, {}, {"TotalCharges": " "}, {"InternetService": None}))
    assert _found(report) == {("missing_values", "total_charges"): 1, ("missing_values", "internet_service"): 1}


def test_duplicates_count_null_ids_as_one(spark):
    rows = _load(spark, {"customerID": "a"}, {"customerID": "a"}, {"customerID": None}, {"customerID": None}, {})
    assert quality.check_duplicate_ids(rows).first()["n"] == 2


def test_blank_totals_warn_only_with_tenure(spark):
    blank = {"TotalCharges": " "}
    fine = quality.check_blank_total_charges(_load(spark, {**blank, "tenure": "0"}))
    assert {r["status"] for r in fine.collect()} == {"ok"}
    odd = {r["value"]: (r["n"], r["status"]) for r in quality.check_blank_total_charges(_load(spark, {**blank, "tenure": "0"}, {**blank, "tenure": "5"})).collect()}
    assert odd == {"null total": (2, "ok"), "null total, tenure not 0": (1, "warn")}


def test_category_report(spark):
    rows = quality.check_categorical_values(_load(spark, {}, {"Contract": "Weekly"}, {"Contract": "Weekly"}))
    found = {r["column_name"]: (r["value"], r["n"], r["status"]) for r in rows.collect()}
    assert found["contract_type"] == ("Weekly", 2, "warn")
    assert found["gender"] == (None, 0, "ok") and len(found) == 11


def test_numeric_report(spark):
    raw = raw_csv.rename_columns(_raw(spark, {}, {"tenure": "ten"}, {"TotalCharges": " "}))
    assert _found(quality.check_dtypes(raw)) == {("numeric_type", "tenure_months"): 1}


def test_fill_only_unbilled(spark):
    blank = {"TotalCharges": " "}
    rows = _load(spark, {**blank, "tenure": "0"}, {**blank, "tenure": "5"}, {})
    filled = {r["seq"]: r["total_charges"] for r in cleaning.fill_total_charges(rows).collect()}
    assert filled == {0: Decimal("0.00"), 1: None, 2: Decimal("298.50")}
    assert cleaning.fill_report(rows).first()["updated_rows"] == 1


def test_trim_takes_every_kind_of_space(spark):
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
    row = cleaning.trim_text(_load(spark, {"InternetService": "\t DSL  ", "Contract": " One year\n"})).first()
    assert (row["internet_service"], row["contract_type"]) == ("DSL", "One year")


def test_first_of_repeated_ids_is_kept(spark):
    rows = _load(spark, {"customerID": "a", "MonthlyCharges": "1"}, {"customerID": "a", "MonthlyCharges": "2"}, {"customerID": "b"})
    kept = {r["customer_id"]: r["monthly_charges"] for r in cleaning.clean(rows).collect()}
    assert kept == {"a": Decimal("1.00"), "b": Decimal("29.85")}
    assert cleaning.dedup_report(rows).first()["dropped_rows"] == 1


def test_one_id_in_a_third_of_the_rows(spark):
    base = _load(spark, {})
    many = spark.range(3000).withColumn("hot", F.col("id") % 3 == 0).crossJoin(base.drop("seq", "customer_id"))
    rows = many.select(
        F.col("id").alias("seq"),
        F.when(F.col("hot"), "hot").otherwise(F.concat(F.lit("c"), "id")).alias("customer_id"),
        *[c for c in base.columns if c not in ("seq", "customer_id")],
    )
    kept = cleaning.keep_first(rows)
    assert kept.count() == 2001 and kept.where("customer_id = 'hot'").first()["seq"] == 0
    good, bad = quality.split_valid(rows)
    assert (good.count(), bad.count()) == (2001, 999)


def test_a_spoilt_first_row_does_not_cost_the_sound_second(spark):
    changes = [
        {"customerID": "a", "gender": "?"}, {"customerID": "a"}, {"customerID": "a"},
        {"customerID": "b", "gender": "?"}, {"customerID": "b", "gender": "!"}, {"customerID": "c"},
    ]
    good, bad = quality.split_valid(_load(spark, *changes))
    assert sorted((r["customer_id"], r["seq"]) for r in good.collect()) == [("a", 1), ("c", 5)]
    assert {r["seq"]: r["violations"] for r in bad.collect()} == {
        0: ["domain:gender"], 2: ["unique:customer_id"], 3: ["domain:gender"], 4: ["domain:gender"]
    }
