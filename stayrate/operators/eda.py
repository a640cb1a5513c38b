"""The numbers behind exploratory charts."""

from __future__ import annotations

from collections.abc import Sequence
from math import pi, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayrate.functions.measures import churned, known_of, n_customers, total_of
from stayrate.functions.ranks import counted, quantiles_of
from stayrate.functions.rates import percent
from stayrate.operators.joint import correlation, moments

CORRELATED = [
    "tenure_months",
    "monthly_charges",
    "total_charges",
    "senior_citizen",
    "partner",
    "dependents",
    "paperless_billing",
    "churn",
]
BOXED = ["tenure_months", "monthly_charges", "total_charges"]
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def churn_counts(df: DataFrame) -> DataFrame:
    """Customers per churn value with their share of all, most frequent first."""
    counts = df.groupBy("churn").agg(n_customers(df).alias("customers"))
    whole = counts.agg(F.sum("customers")).scalar()
    return counts.withColumn("share_pct", percent(F.col("customers"), whole)).orderBy(F.desc("customers"))


def _units(df: DataFrame, value: str) -> tuple[Column, int]:
    """The value as a whole number of its smallest unit, and units per 1."""
    kind = df.schema[value].dataType
    if not isinstance(kind, (T.DecimalType, T.IntegralType)):
        raise TypeError(f"{value} is {kind.simpleString()}; exact numbers only, cast it to a decimal first")
    per_one = 10**kind.scale if isinstance(kind, T.DecimalType) else 1
    return (F.col(value) * per_one).cast("bigint"), per_one


def histogram(df: DataFrame, value: str, bins: int, by: str = "churn") -> DataFrame:
    """Equal-width bins over the whole range of an exact number, counted per group, zeros included.

    Bins are half open but for the last. The bin comes from whole-number arithmetic, so a value
    on an edge never lands in the wrong bin.
    """
    units, per_one = _units(df, value)
    span = df.agg(F.struct(F.min(units).alias("low"), F.max(units).alias("high")).alias("span")).scalar()
    low, width = F.col("_span.low"), F.col("_span.high") - F.col("_span.low")
    scaled = (units - low) * bins
    whole = (scaled - F.pmod(scaled, F.nullif(width, F.lit(0)))) / width
    position = F.when(width == 0, bins // 2).otherwise(F.least(whole.cast("int"), F.lit(bins - 1))) + 1
    counts = (
        df.where(F.col(value).isNotNull())
        .withColumn("_span", span)
        .withColumn("bin", position)
        .groupBy("bin", by)
        .agg(n_customers(df).alias("n"))
    )
    one = df.sparkSession.range(1).select(span.alias("_span"), F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    grid = one.select("_span", "bin", F.explode(F.array(F.lit(False), F.lit(True))).alias(by))
    start = F.when(width == 0, low - per_one / 2).otherwise(low)
    step = F.when(width == 0, F.lit(per_one)).otherwise(width) / bins

    def edge(index: Column) -> Column:
        return F.round((start + step * index) / per_one, 6)

    return (
        grid.join(counts, ["bin", by], "left")
        .select(
            "bin",
            by,
            edge(F.col("bin") - 1).alias("bin_start"),
            edge(F.col("bin")).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("customers"),
        )
        .orderBy("bin", by)
    )


def group_describe(df: DataFrame, value: str, by: str = "churn") -> DataFrame:
    """Mean, median and sample standard deviation per group.

    All three come from counts per distinct value, which are made once; the deviation is taken about the mean.
    """
    counts = counted(df, value, [by])
    number, rows = F.col(value).cast("double"), F.sum(F.when(F.col(value).isNotNull(), F.col("n")))
    means = counts.groupBy(by).agg((F.sum(number * F.col("n")) / rows).alias("mean"), rows.alias("rows"))
    medians = quantiles_of(counts, value, {"median": 0.5}, by=[by])
    # One mean a group.
    apart = counts.alias("l").join(F.broadcast(means).alias("r"), F.col(f"l.{by}").eqNullSafe(F.col(f"r.{by}")))
    squares = apart.groupBy(f"l.{by}", "mean", "rows").agg(F.sum(F.col("n") * F.pow(number - F.col("mean"), 2)).alias("squares"))
    std = F.sqrt(F.when(F.col("rows") > 1, F.col("squares") / (F.col("rows") - 1)))
    described = squares.alias("l").join(medians.alias("r"), F.col(f"l.{by}").eqNullSafe(F.col(f"r.{by}")), "left")
    return described.select(f"l.{by}", "mean", "median", std.alias("std")).orderBy(by)


def group_mean(df: DataFrame, value: str, by: str = "churn") -> DataFrame:
    mean = total_of(df, value).cast("double") / F.nullif(known_of(df, value), F.lit(0))
    return df.groupBy(by).agg(mean.alias("mean")).orderBy(by)


def correlations(df: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """Pearson correlation of every pair of columns, in long form; booleans count as 0 and 1.

    A pair is taken over the rows in which both are known, from one matrix of moments.
    """
    found = moments(df, columns).withColumn("r", correlation())

    def cell(a: Column, b: Column) -> Column:
        return F.struct(a.alias("column_a"), b.alias("column_b"), F.col("r").alias("correlation"))

    one, other = F.col("column_a"), F.col("column_b")
    own = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], "column_a string, column_b string, correlation double")
    return found.select(F.inline(F.array(cell(one, other), cell(other, one)))).unionByName(own)


def churn_share(df: DataFrame, by: str) -> DataFrame:
    """Unrounded churn percentage per category, highest first."""
    share = churned(df) * 100.0 / n_customers(df)
    return df.groupBy(by).agg(share.alias("churn_pct")).orderBy(F.desc("churn_pct"))


def boxplots(df: DataFrame, columns: Sequence[str] = BOXED, by: str = "churn") -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 quartile ranges) and outlier counts.

    Rows are counted per distinct value once, which is the only exchange of rows; all that follows, the quartiles'
    rank index too, works on those counts.
    """
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("decimal(12,2)").alias("value")) for c in columns]
    # Unfolded by inline: what an unpivot passes through has other names in each use, so its counts would be made twice.
    long = df.where(F.col(by).isNotNull()).select(by, F.inline(F.array(*cells)).alias("column_name", "value")).where("value IS NOT NULL")
    keys = ["column_name", by]
    counts = counted(long, "value", keys)
    boxes = quantiles_of(counts, "value", QUARTILES, by=keys)
    number = F.col("value").cast("double")
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = (number >= F.col("q1") - reach) & (number <= F.col("q3") + reach)
    # Null-safe, so that no filter on keys is pushed below one use of the counts and not below the others.
    same = F.col("l.column_name").eqNullSafe(F.col("r.column_name")) & F.col(f"l.{by}").eqNullSafe(F.col(f"r.{by}"))
    return (
        # One box per column and group, a handful of rows.
        counts.alias("l")
        .join(F.broadcast(boxes).alias("r"), same)
        .select(*[F.col(f"l.{c}") for c in keys], *QUARTILES, "value", "n")
        .groupBy(*keys, *QUARTILES)
        .agg(
            F.min(F.when(inside, number)).alias("low"),
            F.max(F.when(inside, number)).alias("high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).alias("outliers"),
        )
        .select(
            *keys,
            *QUARTILES,
            F.least("low", "q1").alias("whisker_low"),
            F.greatest("high", "q3").alias("whisker_high"),
            "outliers",
        )
        .orderBy(*keys)
    )


def _shape(counts: DataFrame, by: str) -> DataFrame:
    """size and bandwidth (Scott; NULL where values don't vary) of each group, from counts per value."""
    means = counts.groupBy(by).agg(F.sum("n").alias("size"), (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mean"))
    squares = F.sum(F.col("n") * F.pow(F.col("x") - F.col("mean"), 2))
    # One mean a group.
    sd = F.sqrt(F.when(F.col("size") > 1, squares / (F.col("size") - 1)))
    spread = counts.join(F.broadcast(means), by).groupBy(by, "size").agg(sd.alias("sd"))
    return spread.withColumn("bandwidth", F.nullif(F.col("sd") * F.pow("size", F.lit(-0.2)), F.lit(0.0)))


def _smoothed(masses: DataFrame, shape: DataFrame, span: Column, by: str, points: int) -> DataFrame:
    """The kernels of masses ``n`` at ``x``, summed on an even grid over the span."""
    spread = (
        # One shape per group, two rows.
        masses.join(F.broadcast(shape), by)
        .withColumn("_span", span)
        .withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    )
    grid = F.col("_span.low") + (F.col("_span.high") - F.col("_span.low")) * F.col("point") / (points - 1)
    z = (grid - F.col("x")) / F.col("bandwidth")
    weight = F.col("n") * F.exp(-z * z / 2) / (F.col("size") * F.col("bandwidth") * sqrt(2 * pi))
    return (
        spread.groupBy(by, "point", grid.alias("grid_value"))
        .agg(F.sum(weight).alias("density"))
        .orderBy(by, "point")
    )


def density(
    df: DataFrame, value: str = "monthly_charges", by: str = "churn", points: int = 200, bins: int | None = None
) -> DataFrame:
    """Gaussian kernel density per group on an even grid over the whole range (Scott bandwidth).

    The kernel is summed over distinct values weighted by their counts, so the work grows with
    the number of different charges and not with the number of customers. With ``bins`` each value's mass is first
    dealt to the two nearest of so many even places, in proportion to how near they are, and the kernel is summed over
    those: then the work has a fixed bound. A density is off by at most d * d / (8 * sqrt(2 pi) * h ** 3), where d is the
    distance of places and h the bandwidth.
    """
    number = F.col(value).cast("double")
    known = df.where(F.col(value).isNotNull())
    counts = known.groupBy(by, number.alias("x")).agg(n_customers(df).alias("n"))
    span = counts.agg(F.struct(F.min("x").alias("low"), F.max("x").alias("high"))).scalar()
    shape = _shape(counts, by)
    if bins is None:
        return _smoothed(counts, shape, span, by, points)
    step = (F.col("_span.high") - F.col("_span.low")) / (bins - 1)
    place = F.coalesce((F.col("x") - F.col("_span.low")) / F.nullif(step, F.lit(0.0)), F.lit(0.0))
    left = F.least(F.floor(place), F.lit(bins - 2)).cast("double")
    share = place - left

    def at(bin_: Column, mass: Column) -> Column:
        return F.struct(bin_.alias("bin"), mass.alias("mass"))

    dealt = F.inline(F.array(at(left, F.col("n") * (1 - share)), at(left + 1, F.col("n") * share)))
    masses = (
        counts.withColumn("_span", span)
        .select(by, "_span", dealt)
        .groupBy(by, "_span", "bin")
        .agg(F.sum("mass").alias("n"))
        .select(by, (F.col("_span.low") + F.col("bin") * step).alias("x"), "n")
    )
    return _smoothed(masses, shape, span, by, points)


def preview(df: DataFrame, rows: int = 5, order: str | None = None) -> DataFrame:
    """A few rows: any, or the first in an order."""
    return (df if order is None else df.orderBy(order)).limit(rows)


def shape(df: DataFrame) -> DataFrame:
    """Row and column counts."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))

