"""Reading the raw CSV export and giving its texts types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayrate.schema import BILLED, COLUMN_MAP, FEATURES_SCHEMA, MONEY, NA_TEXTS, NUMBER_TYPES, YES_NO_COLUMNS

#: The column for the text of records that don't fit the header.
RECORD = "_record"
CSV_OPTIONS = {"header": "true", "escape": '"', "enforceSchema": "false"}


def read_raw_records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All columns as text, matched by header name, with ``seq`` giving the row order of the files and ``malformed``.

    A cell in quotes may hold line breaks. Such a file can't be cut, so each file is one task: an export of any size
    should be many files. Without ``multi_line`` files are cut, and a record ends at the end of its line. ``malformed`` is
    the text of a record with fewer or more fields than the header, else NULL; its missing columns are NULL.

    The header of one file is read first; no inference pass is made. Row order is file, then block, then position in
    the block, and so does not depend on how files are packed into tasks.
    """
    options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower()}
    names = spark.read.options(**options).csv(path).columns
    missing = [name for name in COLUMN_MAP if name not in names]
    if missing:
        raise ValueError(f"missing CSV column(s): {', '.join(missing)}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, RECORD]])
    raw = spark.read.schema(schema).options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD).csv(path)
    texts = [F.when(~F.col(c).isin(NA_TEXTS), F.col(c)).alias(c) for c in COLUMN_MAP]
    seq = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("position"),
    )
    return raw.select(seq.alias("seq"), *texts, F.col(RECORD).alias("malformed"))


def read_raw_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The columns of `read_raw_records`, malformed records with what they have."""
    return read_raw_records(spark, path, multi_line).drop("malformed")


def quarantined_records(records: DataFrame) -> DataFrame:
    """File, position, record and reason of malformed records.

    records: what `read_raw_records` gave, written and read again; Spark refuses to read a CSV for its malformed records alone.
    """
    return records.where("malformed IS NOT NULL").select(
        F.col("seq.file_path").alias("file"),
        F.col("seq.position").alias("position"),
        F.col("malformed").alias("record"),
        F.lit("fewer or more fields than the header").alias("reason"),
    )


def rename_columns(raw: DataFrame) -> DataFrame:
    """Raw header names to column names; other columns pass through."""
    return raw.withColumnsRenamed(COLUMN_MAP)


def coerce_types(renamed: DataFrame) -> DataFrame:
    """Texts to booleans and numbers; what cannot be read becomes NULL, for the constraints to find."""
    typed = {
        "tenure_months": "try_cast(tenure_months AS INT)",
        "monthly_charges": f"try_cast(monthly_charges AS {MONEY.simpleString()})",
        "total_charges": f"try_cast(total_charges AS {BILLED.simpleString()})",
        "senior_citizen": "CAST(try_cast(senior_citizen AS INT) AS BOOLEAN)",
    }
    typed |= {c: f"CASE {c} WHEN 'Yes' THEN true WHEN 'No' THEN false END" for c in YES_NO_COLUMNS}
    return renamed.selectExpr(*[f"{typed.get(c, c)} AS {c}" for c in renamed.columns])


def unreadable_numbers(renamed: DataFrame) -> Column:
    """The number columns whose text is neither blank nor a number."""

    def flagged(column: str, kind: str) -> Column:
        text = f"trim(CAST({column} AS STRING))"
        return F.when(F.expr(f"{text} != '' AND try_cast({text} AS {kind}) IS NULL"), column)

    return F.array_compact(F.array(*[flagged(c, kind) for c, kind in NUMBER_TYPES.items()]))


def load_and_flag(raw: DataFrame) -> DataFrame:
    """Raw text rows to typed customers, with ``unreadable``: the number columns whose text was lost in that."""
    renamed = rename_columns(raw)
    return coerce_types(renamed.withColumn("unreadable", unreadable_numbers(renamed)))


def load_and_coerce(raw: DataFrame) -> DataFrame:
    """Raw text rows to typed customers, keeping ``seq``."""
    return coerce_types(rename_columns(raw))


def write_csv(df: DataFrame, path: str) -> None:
    # By default the writer would trim texts.
    kept = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("overwrite").options(header="true", escape='"', **kept).csv(path)


def read_features_csv(spark: SparkSession, path: str) -> DataFrame:
    """A features CSV written by ``write_csv``, under its fixed schema."""
    return spark.read.schema(FEATURES_SCHEMA).options(**CSV_OPTIONS).csv(path)
