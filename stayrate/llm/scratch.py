"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Unset, a local session gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="stayrate-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def in_small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """The same rows, with Arrow batches of so many rows where the session has Spark's default of 10,000.

    Texts can be long, and a Python worker holds a batch several times over.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, str(rows))
    return df


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, read back from a Parquet table written in the shared folder.

    This computes df once, cuts its lineage, and survives the loss of any executor.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
