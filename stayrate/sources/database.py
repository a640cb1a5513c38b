"""Tables in a relational database over JDBC."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

# The settings a connection needs.
REQUIRED_SETTINGS = ["POSTGRES_HOST", "POSTGRES_PORT", "POSTGRES_DB", "POSTGRES_USER", "POSTGRES_PASSWORD"]


def connection_options(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """JDBC options from the environment; fails when a setting is absent."""
    env = os.environ if env is None else env
    absent = [name for name in REQUIRED_SETTINGS if not env.get(name)]
    if absent:
        raise RuntimeError(f"Connection settings not set: {', '.join(absent)}")
    host, port, database, user, password = (env[name] for name in REQUIRED_SETTINGS)
    return {
        "url": f"jdbc:postgresql://{host}:{port}/{database}",
        "driver": "org.postgresql.Driver",
        "user": user,
        "password": password,
    }


def block_slices(blocks: int, slices: int) -> list[str]:
    """WHERE clauses that cut a table into ranges of its pages, so that each slice reads only its own.

    Every row lies on one page, whatever its key, NULL included; the last range is open for pages
    that are added meanwhile.
    """
    slices = max(1, min(slices, blocks or 1))
    ends = [blocks * i // slices for i in range(slices + 1)]
    clauses = []
    for i in range(slices):
        low = f"ctid >= '({ends[i]},0)'::tid"
        clauses.append(low if i == slices - 1 else f"{low} AND ctid < '({ends[i + 1]},0)'::tid")
    return clauses


def blocks_query(table: str) -> str:
    """How many pages a table has."""
    quoted = table.replace("'", "''")
    return f"SELECT pg_relation_size('{quoted}') / current_setting('block_size')::bigint AS blocks"


def read_table(spark: SparkSession, table: str, options: Mapping[str, str], slices: int = 64) -> DataFrame:
    """Scan a table as parallel ranges of its pages."""
    found = spark.read.format("jdbc").options(**options).option("query", blocks_query(table)).load()
    properties = {k: v for k, v in options.items() if k != "url"} | {"fetchsize": "10000"}
    predicates = block_slices(int(found.first()["blocks"]), slices)
    return spark.read.jdbc(options["url"], table, predicates=predicates, properties=properties)


def swap_statements(table: str, staging: str) -> list[str]:
    """What puts the rows of a staging table in a table's place, as one transaction."""
    return ["BEGIN", f"TRUNCATE {table}", f"INSERT INTO {table} SELECT * FROM {staging}", f"DROP TABLE {staging}", "COMMIT"]


def write_options(options: Mapping[str, str], staging: str) -> dict[str, str]:
    return {**options, "dbtable": staging, "batchsize": "10000", "isolationLevel": "READ_COMMITTED"}


def replace_table(
    df: DataFrame,
    table: str,
    options: Mapping[str, str],
    execute: Callable[[list[str]], None],
    partitions: int = 64,
) -> None:
    """Replace a table's rows: load a staging table over a bounded number of connections, then swap.

    Each task of the load commits for itself, so a task that ran twice leaves rows twice in the
    staging table; its row count must equal that of ``df``, else nothing is swapped. ``execute`` runs statements on the database. Readers of the table see
    the old rows or the new ones.
    """
    staging = f"{table}_load_{uuid.uuid4().hex[:8]}"
    rows = df.persist()
    try:
        # The cluster computes; only the writing is held to so many connections.
        rows.repartition(partitions).write.format("jdbc").options(**write_options(options, staging)).save()
        loaded = df.sparkSession.read.format("jdbc").options(**options).option("dbtable", staging).load()
        expected, found = rows.count(), loaded.count()
        if expected != found:
            execute([f"DROP TABLE {staging}"])
            raise RuntimeError(f"{found} rows were loaded for {expected}; {table} is as it was")
        execute(swap_statements(table, staging))
    finally:
        rows.unpersist()
