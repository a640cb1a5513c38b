"""Times the scalable forms beside the plain ones on customers replicated many times.

    python bench_scale.py 100 1000

Every copy of a customer gets its own id and slightly different charges; with ``--hot`` a third
of the rows share one charge, one score and, for cleaning, one id.
"""

from __future__ import annotations

import argparse
import json
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from stayrate.functions.ranks import tie_key, with_ntile  # noqa: E402
from stayrate.operators import cleaning, decision, evaluation, features, metrics, modeling, quality  # noqa: E402
from stayrate.plans.registry import scores  # noqa: E402
from stayrate.session import local_session  # noqa: E402

SOURCE = "/root/testdata/sf0.1"


def replicate(spark: SparkSession, copies: int, hot: bool, path: str) -> DataFrame:
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy")
    rows = scores(spark, SOURCE).repartition(spark.sparkContext.defaultParallelism * 4).select("*", copy)
    charge = F.col("monthly_charges") + (F.col("copy") % 100) / 100
    score = F.least(F.lit(0.99), F.col("churn_probability") + (F.col("copy") % 977) / 1e6)
    identifier = F.concat("customer_id", F.lit("-"), F.col("copy").cast("string"))
    if hot:
        third = F.pmod(F.xxhash64("customer_id", "copy"), F.lit(3)) == 0
        charge = F.when(third, F.lit(50.25)).otherwise(charge)
        score = F.when(third, F.lit(0.25)).otherwise(score)
    rows = rows.withColumns(
        {
            "seq": F.monotonically_increasing_id(),
            "customer_id": identifier,
            "monthly_charges": charge.cast("decimal(8,2)"),
            "churn_probability": score,
        }
    ).drop("copy", "clv")
    decision.with_clv(rows).write.parquet(path)
    return spark.read.parquet(path)


def plain_ntile(df: DataFrame) -> DataFrame:
    order = Window.orderBy("monthly_charges", tie_key(F.col("customer_id")))
    return df.select("customer_id", "monthly_charges", F.ntile(4).over(order).alias("spend_quartile"))


def plain_split(df: DataFrame) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("churn").orderBy(tie_key(F.col("customer_id"), "42")))
    return df.select("customer_id", "churn", place.alias("place"))


def plain_sweep(df: DataFrame) -> DataFrame:
    return decision.business_value(df, {f"t{i}": i / 100 for i in range(5, 96)})


def repeated_ids(df: DataFrame) -> DataFrame:
    third = F.pmod(F.xxhash64("customer_id"), F.lit(3)) == 0
    return df.withColumn("customer_id", F.when(third, "hot").otherwise(F.col("customer_id")))


CASES = {
    "q07 churn by contract": metrics.churn_by_contract,
    "q02 demographics": metrics.churn_by_demographics,
    "w01 ntile, cut search": lambda df: with_ntile(
        df.select("customer_id", "monthly_charges"), 4, "monthly_charges", "customer_id", "spend_quartile"
    ),
    "w01 ntile, plain window": plain_ntile,
    "m02 split, cut search": modeling.stratified_split,
    "m02 split, plain window": plain_split,
    "r03 sweep, one pass": decision.threshold_sweep,
    "r03 sweep, 91 sums": plain_sweep,
    "m11 exact auc": evaluation.roc_auc,
    "f07 features": features.engineer_features,
    "v06 constraints": quality.constraint_report,
    "c03 keep first": cleaning.keep_first,
    "c03 keep first, one id in a third": lambda df: cleaning.keep_first(repeated_ids(df)),
    "v06 quarantine, one id in a third": lambda df: quality.split_valid(repeated_ids(df))[1],
    "r07 recommend": lambda df: decision.recommend(df, decision.optimal_threshold(df)),
}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("copies", nargs="+", type=int)
    parser.add_argument("--hot", action="store_true")
    parser.add_argument("--skip-plain", action="store_true")
    args = parser.parse_args()
    spark = local_session(8, "stayrate-scale")
    spark.sparkContext.setLogLevel("OFF")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for copies in args.copies:
        rows = replicate(spark, copies, args.hot, f"{folder}/x{copies}")
        print(json.dumps({"copies": copies, "rows": rows.count(), "hot": args.hot}), flush=True)
        for name, case in CASES.items():
            if args.skip_plain and ("plain" in name or "91" in name):
                continue
            started = time.perf_counter()
            case(rows).write.format("noop").mode("overwrite").save()
            print(json.dumps({name: round(time.perf_counter() - started, 2)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
