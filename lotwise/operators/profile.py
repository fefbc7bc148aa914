"""Column profile: one row per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.functions.values import count_with_percent, joined_text

SAMPLE_SIZE = 10


# What a value counts as, beside being distinct.
BLANK, NULL, ZERO_NUMBER, ZERO_TEXT, OTHER = "blank", "null", "zero number", "zero text", "other"


# Longer values are counted by their hash.
LONG = 64

# Types whose values are never longer.
SHORT_TYPES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)


def _text(f: T.StructField) -> Column:
    value = F.col(f"`{f.name}`")
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        value = value + F.lit(0.0)  # -0.0 is 0.0
    return value.cast("string")


def _md5(value: Column) -> Column:
    return F.md5(value.cast("binary"))


def value_counts(df: DataFrame) -> DataFrame:
    """(column_name, value, hash, kind, n) for every distinct value of every column.

    Cells are counted in the map tasks, so a frequent value costs nothing extra. A value
    of more than ``LONG`` characters is null and has its MD5 as ``hash``, so nothing long
    is shuffled.
    """

    def cell(f: T.StructField) -> Column:
        column, value = F.col(f"`{f.name}`"), _text(f)
        kind = F.when(value.isNull(), NULL)
        if isinstance(f.dataType, T.NumericType):
            kind = kind.when(column == 0, ZERO_NUMBER)
        else:
            kind = kind.when(value == " ", BLANK).when(value == "0", ZERO_TEXT)
        short = isinstance(f.dataType, SHORT_TYPES)
        is_long = F.length(value) > LONG
        return F.struct(
            F.lit(f.name).alias("column_name"),
            (value if short else F.when(~is_long, value)).alias("value"),
            (F.lit(None).cast("string") if short else F.when(is_long, _md5(value))).alias("hash"),
            kind.otherwise(OTHER).alias("kind"),
        )

    cells = df.select(F.inline(F.array(*[cell(f) for f in df.schema.fields])))
    return cells.groupBy("column_name", "value", "hash", "kind").agg(F.count(F.lit(1)).alias("n"))


def _long_texts(df: DataFrame, picked: DataFrame) -> DataFrame | None:
    """The texts of long values by their hashes, from a scan of their own."""
    fields = [f for f in df.schema.fields if not isinstance(f.dataType, SHORT_TYPES)]
    if not fields:
        return None
    cells = [F.struct(F.lit(f.name).alias("column_name"), _text(f).alias("v")) for f in fields]
    texts = df.select(F.inline(F.array(*cells))).where(F.length("v") > LONG)
    wanted = picked.where("hash is not null").select("column_name", "hash", "_rank")
    # columns times the sample size
    found = texts.withColumn("hash", _md5(F.col("v"))).join(F.broadcast(wanted), ["column_name", "hash"])
    return found.groupBy("column_name", "_rank").agg(F.min("v").alias("v"))


def column_counts(df: DataFrame) -> DataFrame:
    """Distinct values (a missing value is one) and blanks, nulls and zeros as numbers."""

    def total(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(F.lit(0)))

    return (
        value_counts(df)
        .groupBy("column_name")
        .agg(
            F.count(F.lit(1)).alias("unique_values"),
            total(BLANK).alias("n_empty"),
            total(NULL).alias("n_null"),
            total(ZERO_NUMBER).alias("n_zero_int"),
            total(ZERO_TEXT).alias("n_zero_chr"),
            F.sum("n").alias("n_rows"),
        )
    )


def column_samples(df: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """Up to ``size`` distinct values per column, the ones with the lowest MD5.

    Spark applies the rank limit in the map tasks too (window group limit), so a column
    of any number of distinct values sends few rows to the final ranking. The texts of
    picked values that are long, ``size`` for each column at most, come from a second scan.
    """
    order = Window.partitionBy("column_name").orderBy("_order")
    picked = (
        value_counts(df)
        # always true; with the count in use, a profile shuffles the pairs once
        .where(F.col("n") > 0)
        .withColumn("_order", F.coalesce("hash", _md5(F.col("value"))))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= size)
        .select("column_name", "value", "hash", "_rank")
    )
    texts = picked.where("hash is null").select(
        "column_name", "_rank", F.coalesce("value", F.lit("None")).alias("v")
    )
    longer = _long_texts(df, picked)
    if longer is not None:
        texts = texts.unionByName(longer)
    return (
        texts.groupBy("column_name")
        .agg(F.sort_array(F.collect_list(F.struct("_rank", "v"))).alias("picked"))
        .select("column_name", joined_text("; ", F.col("picked.v")).alias("column_sample"))
    )


def column_profile(df: DataFrame, size: int = SAMPLE_SIZE) -> DataFrame:
    """Per column: sample, distinct count, and count with percent of blank, null, 0, '0'."""
    counts = column_counts(df)
    rows = F.col("n_rows")
    texts = counts.select(
        "column_name",
        "unique_values",
        count_with_percent(F.col("n_empty"), rows).alias("is_empty"),
        count_with_percent(F.col("n_null"), rows).alias("is_null"),
        count_with_percent(F.col("n_zero_int"), rows).alias("is_zero_int"),
        count_with_percent(F.col("n_zero_chr"), rows).alias("is_zero_chr"),
    )
    return column_samples(df, size).join(texts, "column_name")
