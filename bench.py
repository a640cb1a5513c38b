"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stayrate.plans.registry import QUERIES  # noqa: E402
from stayrate.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))

HEADLINE = [
    "s01_csv_scan",
    "s04_full_refresh",
    "s08_recommendations_table",
    "c04_updated_table",
    "q01_overall_churn",
    "q02_churn_by_demographics",
    "q03_tenure_by_churn",
    "q04_revenue_totals",
    "q05_revenue_lost",
    "q06_revenue_by_contract",
    "q07_churn_by_contract",
    "q08_tenure_by_contract",
    "q09_churn_by_payment",
    "q10_churn_by_paperless",
    "q11_churn_by_risk_segment",
    "q12_churn_by_internet",
    "q13_churn_by_add_on",
    "q14_churn_by_tenure_bucket",
    "q15_churn_by_spend_quartile",
    "q16_churn_matrix",
    "w01_ntile",
    "v04_categorical_values",
    "v06_constraints",
    "c05_clean",
    "e05_correlations",
    "e07_boxplots",
    "f07_engineer_features",
    "m02_stratified_split",
    "m07_logistic_regression",
    "m10_stratified_folds",
    "m11_roc_auc",
    "m14_classification_rates",
    "r03_threshold_sweep",
    "r07_recommend_action",
    "d01_customer_dashboard",
    "d02_kpi_cards",
]


def main() -> None:
    spark = local_session(CPUS, "stayrate-bench")
    spark.sparkContext.setLogLevel("OFF")
    # One untimed query starts the engine.
    QUERIES["q07_churn_by_contract"](spark, SF_DIR).collect()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    line = {
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
