"""Tables in files: parquet layers, delimited text, XML attribute records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.schema import require_columns
from lotwise.sources import delimited

# Cell texts that stand for a missing value in text tables.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def known(c: str) -> Column:
    return F.when(~F.col(f"`{c}`").isin(*MISSING_WORDS), F.col(f"`{c}`")).alias(c)


def pick(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """Column subset; a column the source lacks is an error."""
    if columns is None:
        return df
    require_columns(df.columns, columns)
    return df.select(*[F.col(f"`{c}`") for c in columns])


def read_layer(
    spark: SparkSession, path: str, columns: list[str] | None = None
) -> DataFrame:
    """Geometry layer: parquet with the shape as a nested column."""
    return pick(spark.read.parquet(path), columns)


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    columns: list[str] | None = None,
    line_breaks: bool = True,
) -> DataFrame:
    """Delimited text with a header, every column as text. Missing words become null.

    A quoted cell may hold line breaks: one more pass over the files finds where each
    split stands. Pass ``line_breaks=False`` for files known to have none, to spare it.
    Files of another header than the first are an error, not read by position.
    """
    if line_breaks:
        raw = delimited.read(spark, path, sep)
    else:
        raw = spark.read.csv(path, sep=sep, header=True, escape='"', enforceSchema=False)
    df = pick(raw, columns)
    return df.select(*[known(c) for c in df.columns])


def read_xml_records(
    spark: SparkSession, path: str, row_tag: str, columns: list[str] | None = None
) -> DataFrame:
    """One row per element, its attributes as text columns; all attributes by default.

    The names come from a pass over the files, so that a column which no record has is
    an error; one that only some records have is null in the others.
    """
    options = {"rowTag": row_tag, "attributePrefix": "", "inferSchema": "false"}
    found = spark.read.format("xml").options(**options).load(path)
    names = [f.name for f in found.schema.fields if isinstance(f.dataType, T.StringType)]
    if columns is not None:
        require_columns(names, columns)
        names = columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    return spark.read.format("xml").options(**options).schema(schema).load(path)


def read_counties(spark: SparkSession, path: str, counties: list[str] | None = None) -> DataFrame:
    """Standard county tables kept as ``COUNTY=<name>`` folders; other folders are not read."""
    df = spark.read.parquet(path)
    return df if counties is None else df.where(F.col("COUNTY").isin(*counties))


def union_tables(parts: list[DataFrame]) -> DataFrame:
    """Tables in one, columns by name; what a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_counties(tables: dict[str, DataFrame]) -> DataFrame:
    """County tables in one, each tagged with its name."""
    return union_tables([df.withColumn("COUNTY", F.lit(name)) for name, df in tables.items()])
