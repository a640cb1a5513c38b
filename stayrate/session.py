"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def build_session(app: str = "stayrate", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; on a cluster leave ``master`` to spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        # The coercions rely on try_cast beside strict casts.
        .config("spark.sql.ansi.enabled", "true")
        # The JVM never compiles a generated method beyond this many bytes.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # Recording the Python call site of every expression makes building plans slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    else:
        # Many small shuffle partitions, put together at run time to about the advisory size.
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "2000")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int = 8, app: str = "stayrate-local") -> SparkSession:
    """A single-machine session for tests and the bench."""
    conf = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("STAYRATE_DRIVER_MEMORY", "8g"),
    }
    return build_session(app, f"local[{cores}]", **conf)


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for reliable checkpoints: the cluster's own, else, on one machine, a scratch one set here.

    On several machines a local folder would be another one on each, so there it has to be configured.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="stayrate-checkpoint-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder
