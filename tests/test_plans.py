"""Physical plans: what must and must not be in them at any size."""

from __future__ import annotations

import re

import pytest

from stayrate.operators import cleaning, metrics, modeling
from stayrate.plans import invariants
from stayrate.plans.registry import QUERIES
from stayrate.sources.derived import derive_customers, derive_raw
from stayrate.sources.raw_csv import load_and_coerce

PYTHON = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")
# Their plans read what they wrote or fitted on the way; only relations are looked at here, so none is left out.
ALL = QUERIES | invariants.QUERIES
SEARCHES = {"m10_tune_model", "m10_search_journal", "m10_search_is_whole"}


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(ALL) - SEARCHES))
def test_no_python_and_no_cross_join(spark, small_dir, name):
    plan = _plan(ALL[name](spark, small_dir))
    assert not any(operator in plan for operator in PYTHON)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _ran(frame):
    """The operators of the plan as it ran, scalar subqueries included; what is reused is named once."""
    frame.collect()
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    kept, final = [], True
    for line in frame._jdf.queryExecution().explainString(mode).split("\n"):
        final = "Final Plan" in line or line.startswith("Subquery") or (final and "Initial Plan" not in line)
        if final and (found := re.match(r"[\s:|+*-]*([A-Z][A-Za-z ]*?) +(?:parquet +)?\(\d+\)$", line)):
            kept.append(found[1])
    return kept


@pytest.mark.parametrize(("name", "unfolded"), [("e03_describe_charges", 0), ("e07_boxplots", 1), ("f06_cut_points", 1)])
def test_quantiles_move_rows_once(spark, small_dir, name, unfolded):
    """Customers are scanned, unfolded and counted once; ranks, moments and whiskers come from the counts."""
    from stayrate.operators import eda, features

    rows = cleaning.fill_total_charges(derive_customers(spark, small_dir))
    frame = {
        "e03_describe_charges": lambda: eda.group_describe(rows, "monthly_charges"),
        "e07_boxplots": lambda: eda.boxplots(rows),
        "f06_cut_points": lambda: features.charge_points(rows),
    }[name]()
    ran = _ran(frame)
    # Orders and customers.
    assert ran.count("Scan") == 2 and ran.count("Expand") + ran.count("Generate") == unfolded


def test_placing_rows_needs_no_shuffle(spark, small_dir):
    customers = derive_customers(spark, small_dir)
    before = _plan(customers).count("Exchange")
    assert _plan(metrics.spend_quartiles(customers)).count("Exchange") <= before
    assert _plan(modeling.stratified_split(customers)).count("Exchange") <= before
    assert "Window" not in _plan(metrics.spend_quartiles(customers))


def test_repeats_are_dropped_before_the_shuffle(spark, small_dir):
    plan = _plan(cleaning.keep_first(load_and_coerce(derive_raw(spark, small_dir))))
    partial = plan.index("row_number(), 1, Partial")
    exchange = plan.index("Exchange hashpartitioning(customer_id")
    assert plan.index("row_number(), 1, Final") < exchange < partial


def test_scans_are_pruned(spark, small_dir):
    plan = _plan(QUERIES["q07_churn_by_contract"](spark, small_dir))
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:" in plan and "o_totalprice" not in plan


def test_long_form_reads_its_input_once(spark, small_dir):
    for name in ("q02_churn_by_demographics", "q13_churn_by_add_on", "r03_threshold_sweep"):
        assert _plan(QUERIES[name](spark, small_dir)).count("FileScan") == 2  # orders and customer


def test_tables_in_the_same_buckets_join_where_they_are(spark, small_dir):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        plan = _plan(QUERIES["j01_bucketed_join"](spark, small_dir))
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert plan.count("Bucketed: true") == 2
    finally:
        spark.conf.set(threshold, before)
