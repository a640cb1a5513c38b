"""Parquet datasets, catalog tables and fitted models."""

from __future__ import annotations

import time
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from stayrate.operators.quality import constraint_report
from stayrate.schema import RECOMMENDATION_COLUMNS


class RejectedLoad(ValueError):
    """The rows to load break constraints of the customer relation."""


def write_dataset(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_dataset(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """A Parquet dataset; passing the schema spares the footer read."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def require_valid(customers: DataFrame) -> None:
    """Raise unless every constraint holds (reads back one small row per broken constraint)."""
    broken = constraint_report(customers).where("n > 0").collect()
    if broken:
        raise RejectedLoad("; ".join(f"{r['check_name']}({r['column_name']}): {r['n']}" for r in broken))


def replace_table(rows: DataFrame, table: str, base_path: str, keep: int = 2, buckets: int | None = None) -> str:
    """Replace a table's rows as one step: write a new folder, then point the table at it.

    Readers see the old rows until the catalog entry moves, and a failed write leaves the table as it was. A
    table whose columns are not those of the rows is refused. The newest ``keep`` folders stay for
    readers that have begun; older ones are removed. With ``buckets`` the rows are first put together by
    customer_id, so there is one file a bucket, and the folder is one of a bucketed table.
    """
    spark = rows.sparkSession
    columns = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields]
    there = spark.catalog.tableExists(table)
    if there and (had := [(f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields]) != columns:
        raise RejectedLoad(f"{table} has columns {had}, the rows have {columns}")
    folder = f"{base_path.rstrip('/')}/load-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    if buckets:
        staging = f"{table}_{uuid.uuid4().hex[:8]}"
        save_bucketed(rows, staging, buckets, folder)
        spark.sql(f"DROP TABLE {staging}")
    else:
        rows.write.mode("errorifexists").parquet(folder)
    if there:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        names = ", ".join(f"`{name}` {kind}" for name, kind in columns)
        sorted_by = f"CLUSTERED BY (customer_id) SORTED BY (customer_id) INTO {buckets} BUCKETS" if buckets else ""
        spark.sql(f"CREATE TABLE {table} ({names}) USING parquet {sorted_by} LOCATION '{folder}'")
    _remove_old_loads(spark, base_path, keep)
    return folder


def _remove_old_loads(spark: SparkSession, base_path: str, keep: int) -> None:
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(base_path)
    files = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    loads = sorted((s.getPath() for s in files.listStatus(base)), key=lambda path: path.getName())
    for path in [x for x in loads if x.getName().startswith("load-")][:-keep]:
        files.delete(path, True)


def full_refresh(customers: DataFrame, table: str, base_path: str, keep: int = 2) -> str:
    """Check the constraints of the customer relation, then replace the table. Returns the new folder."""
    require_valid(customers)
    return replace_table(customers, table, base_path, keep)


def save_bucketed(df: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Replace a table stored bucketed and sorted by customer_id, one file a bucket.

    Customers and recommendations saved with the same number of buckets join without a shuffle.
    """
    dealt = df.repartition(buckets, "customer_id")
    writer = dealt.write.mode("overwrite").bucketBy(buckets, "customer_id").sortBy("customer_id")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def replace_recommendations(
    recommendations: DataFrame, table: str, base_path: str, buckets: int | None = None, keep: int = 2
) -> str:
    """Replace the recommendations table, bucketed by customer_id if asked."""
    return replace_table(recommendations.select(*RECOMMENDATION_COLUMNS), table, base_path, keep, buckets)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
