"""Data-quality checks in long form: check_name, column_name, value, n, status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.rates import flag
from stayrate.schema import (
    CUSTOMER_COLUMNS,
    DOMAINS,
    MAX_LENGTHS,
    NON_NEGATIVE_COLUMNS,
    NUMBER_COLUMNS,
    NUMBER_TYPES,
    REQUIRED_COLUMNS,
    TEXT_COLUMNS,
)

# What a number column of the raw text must parse as.
def _finding(df: DataFrame, check: str, column: Column, value: Column, n: Column, bad: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"),
        column.alias("column_name"),
        value.cast("string").alias("value"),
        n.cast("bigint").alias("n"),
        F.when(flag(bad), "warn").otherwise("ok").alias("status"),
    )


def _counts(df: DataFrame, conditions: dict[str, str], name: str = "column_name") -> DataFrame:
    """One scan that counts the rows meeting each named SQL condition, one output row per name."""
    row = df.selectExpr(*[f"count_if({condition}) AS `{key}`" for key, condition in conditions.items()])
    return row.unpivot([], list(conditions), name, "n")


def check_missing_values(df: DataFrame) -> DataFrame:
    """NULLs per column, for columns that have any."""
    columns = [c for c in CUSTOMER_COLUMNS if c in df.columns]
    missing = _counts(df, {c: f"{c} IS NULL" for c in columns}).where("n > 0")
    return _finding(missing, "missing_values", F.col("column_name"), F.lit(None), F.col("n"), F.lit(True))


def check_duplicate_ids(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each customer_id; NULL ids count as one id."""
    extra = df.groupBy("customer_id").agg((F.count(F.lit(1)) - 1).alias("extra"))
    total = extra.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("n"))
    return _finding(total, "duplicate_ids", F.lit("customer_id"), F.lit(None), F.col("n"), F.col("n") > 0)


def check_blank_total_charges(df: DataFrame) -> DataFrame:
    """NULL total_charges, and those of them that a zero tenure does not explain."""
    blank = "total_charges IS NULL"
    found = _counts(
        df, {"null total": blank, "null total, tenure not 0": f"{blank} AND tenure_months != 0"}, "value"
    )
    bad = (F.col("value") == "null total, tenure not 0") & (F.col("n") > 0)
    return _finding(found, "blank_total_charges", F.lit("total_charges"), F.col("value"), F.col("n"), bad)


def _outside_domain(column: str) -> str:
    allowed = ", ".join(f"'{value}'" for value in DOMAINS[column])
    return f"coalesce({column} NOT IN ({allowed}), false)"


def check_categorical_values(df: DataFrame) -> DataFrame:
    """Values outside a column's domain with their counts; one ``ok`` row for a clean column.

    Rows with nothing wrong are dropped by a plain filter before anything is unpivoted.
    """
    cells = [
        f"IF({_outside_domain(c)}, named_struct('column_name', '{c}', 'value', {c}), NULL)" for c in DOMAINS
    ]
    found = (
        df.where(" OR ".join(_outside_domain(c) for c in DOMAINS))
        .selectExpr(f"inline(array_compact(array({', '.join(cells)})))")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = ", ".join(f"'{c}'" for c in DOMAINS)
    columns = df.sparkSession.range(1).selectExpr(f"explode(array({names})) AS column_name")
    joined = columns.join(found, "column_name", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return _finding(joined, "categories", F.col("column_name"), F.col("value"), F.col("n"), F.col("n") > 0)


def check_dtypes(rows: DataFrame) -> DataFrame:
    """Per number column: non-blank cells of the raw text that are not numbers.

    Rows are raw texts, or loaded rows whose column `unreadable` says which of their texts were lost.
    """
    flagged = "unreadable" in rows.columns

    def unreadable(column: str) -> str:
        if flagged:
            return f"array_contains(unreadable, '{column}')"
        text = f"trim(CAST({column} AS STRING))"
        return f"{text} != '' AND try_cast({text} AS {NUMBER_TYPES[column]}) IS NULL"

    found = _counts(rows, {c: unreadable(c) for c in NUMBER_COLUMNS})
    return _finding(found, "numeric_type", F.col("column_name"), F.lit(None), F.col("n"), F.col("n") > 0)


# --- constraints -----------------------------------------------------------


def row_constraints() -> dict[tuple[str, str], str]:
    """(kind, column) -> SQL predicate that is true where a row breaks the constraint."""
    broken = {("not_null", c): f"{c} IS NULL" for c in REQUIRED_COLUMNS}
    broken |= {("domain", c): _outside_domain(c) for c in TEXT_COLUMNS}
    broken |= {("non_negative", c): f"coalesce({c} < 0, false)" for c in NON_NEGATIVE_COLUMNS}
    broken |= {("max_length", c): f"coalesce(length({c}) > {size}, false)" for c, size in MAX_LENGTHS.items()}
    return broken


def row_is_sound() -> str:
    """SQL predicate that is true where no row constraint is broken.

    Shorter than the list of constraints: a value in its domain is neither NULL nor too long.
    """
    def known(test: str, column: str) -> str:
        return f"coalesce({test}, {str(column not in REQUIRED_COLUMNS).lower()})"

    tests = []
    for column in CUSTOMER_COLUMNS:
        if column in DOMAINS:
            allowed = ", ".join(f"'{value}'" for value in DOMAINS[column])
            tests.append(known(f"{column} IN ({allowed})", column))
        elif column in NON_NEGATIVE_COLUMNS:
            tests.append(known(f"{column} >= 0", column))
        elif column in MAX_LENGTHS:
            tests.append(known(f"length({column}) <= {MAX_LENGTHS[column]}", column))
        else:
            tests.append(f"{column} IS NOT NULL")
    return " AND ".join(tests)


def constraint_report(df: DataFrame) -> DataFrame:
    """Rows breaking each constraint: all row-wise ones in one scan, key uniqueness by count."""
    constraints = row_constraints()
    names = {f"{kind}:{column}": predicate for (kind, column), predicate in constraints.items()}
    rows = _counts(df, names, "name").select(
        F.substring_index("name", ":", 1).alias("check_name"),
        F.substring_index("name", ":", -1).alias("column_name"),
        "n",
    )
    unique = check_duplicate_ids(df.where(F.col("customer_id").isNotNull())).select(
        F.lit("unique").alias("check_name"), "column_name", "n"
    )
    status = F.when(F.col("n") > 0, "warn").otherwise("ok").alias("status")
    return rows.unionByName(unique).select("check_name", "column_name", F.col("n").cast("bigint"), status)


def _with_first(df: DataFrame, order: str) -> DataFrame:
    """Add ``_first``, the first sound row of a repeated id (NULL for ids that occur once or are never sound).

    Ids are counted by partial aggregation and only repeated ones are joined back. They are
    normally few, so the join becomes a broadcast at run time and a much repeated id never fills
    one task; where they are many, the skew-join rule splits it.
    """
    repeated = (
        df.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.min(F.when(F.expr(row_is_sound()), F.col(order))).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    return df.join(repeated, "customer_id", "left")


def with_violations(df: DataFrame, order: str = "seq") -> DataFrame:
    """Every row with ``violations``, the names of the constraints it breaks; none for rows fit to load.

    Rows are told apart by a short predicate; only for bad ones is the long list of reasons looked at.
    Of the sound rows of an id the first is kept; what comes after it breaks ``unique``. A spoilt row
    never stands in the way of a sound one.
    """
    broken = {f"{kind}:{column}": predicate for (kind, column), predicate in row_constraints().items()}
    broken["unique:customer_id"] = f"coalesce({order} > _first, false)"
    sound = f"{row_is_sound()} AND NOT {broken['unique:customer_id']}"
    reasons = ", ".join(f"IF({predicate}, '{name}', NULL)" for name, predicate in broken.items())
    violations = F.expr(f"IF({sound}, CAST(array() AS array<string>), array_compact(array({reasons})))")
    return _with_first(df, order).select(*df.columns, violations.alias("violations"))


def split_valid(df: DataFrame, order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(rows fit to load, quarantined rows with their ``violations``); see ``with_violations``.

    Both sides compute the violations. To use both, write those once and read them twice.
    """
    placed = with_violations(df, order)
    sound = F.size("violations") == 0
    return placed.where(sound).drop("violations"), placed.where(~sound)
