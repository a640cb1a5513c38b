from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def documents_of(spark):
    """Builds documents from (doc_id, text) rows, with columns that an operator may use inside."""

    def build(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for name in ("row", "cell", "rank", "spans", "vertex", "block", "kind", "key", "of", "known", "owner", "shuffled", "length"):
            df = df.withColumn(name, F.lit("extra"))
        return df.withColumn("source", F.lit("s"))

    return build


def rows_by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
