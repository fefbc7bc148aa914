"""Regional summaries: sums, pivot, histogram, densities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.functions.values import ratio, to_number


def with_densities(df: DataFrame) -> DataFrame:
    """Units and appraised value per acre; null on a lot of no size."""
    return df.withColumn("UNITS_PER_ACRE", ratio("UNITS", "CALCACRES")).withColumn(
        "VALPERACRE", ratio(to_number("APPRTOT"), to_number("CALCACRES"))
    )


def units_by(df: DataFrame, keys: list[str], since: float, units: str = "UNITS") -> DataFrame:
    """Sum of units per key for years from ``since``; a group without any is 0.

    Rows with a missing key are dropped.
    """
    df = df.where(F.col("YRBUILT") >= since)
    for key in keys:
        df = df.where(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(F.coalesce(F.sum(units), F.lit(0)).alias(units))


def count_by_year_wide(
    df: DataFrame,
    row: str,
    since: float,
    years: list | None = None,
    value: str = "geometry",
    year: str = "YRBUILT",
) -> DataFrame:
    """Non-null ``value`` per ``row``, one column per year; null where there is no row.

    Without ``years`` Spark first lists the distinct years.
    """
    wanted = df.where((F.col(year) >= since) & F.col(row).isNotNull())
    # only the presence of the value matters: a long geometry stays out of the shuffle
    wanted = wanted.select(
        row, F.col(year).cast("int").alias("_year"), F.col(value).isNotNull().alias("_has")
    )
    return wanted.groupBy(row).pivot("_year", years).agg(
        F.sum(F.col("_has").cast("bigint"))
    )


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Counts in ``bins`` equal intervals from the smallest to the largest value.

    Reads ``df`` twice: pass a written table where it is costly to compute.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v"))
    ends = values.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high")).alias("ends"))
    low, high = ends.scalar()["low"], ends.scalar()["high"]
    width = (high - low) / F.lit(float(bins))
    # the largest value belongs to the last bin
    bin_no = F.least(
        F.coalesce(F.floor(F.try_divide(F.col("v") - low, width)), F.lit(0)), F.lit(bins - 1)
    ).cast("int")
    return (
        values.withColumn("bin", bin_no)
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (low + F.col("bin") * width).alias("bin_start"), "n")
    )
