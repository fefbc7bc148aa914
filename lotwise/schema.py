"""Geometry types, the standard parcel schema and SRID metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING = T.ArrayType(POINT)
# parts -> rings (the first is the outer ring) -> points
SHAPE = T.ArrayType(T.ArrayType(RING))

# The standard county table.
PARCEL_SCHEMA = T.StructType(
    [
        T.StructField("OBJECTID", T.StringType()),
        T.StructField("CLASS", T.StringType()),
        T.StructField("YRBUILT", T.DoubleType()),
        T.StructField("ACRES", T.DoubleType()),
        T.StructField("APPRTOT", T.DoubleType()),
        T.StructField("UNITS", T.LongType()),
        T.StructField("geometry", SHAPE),
    ]
)

SRID_KEY = "srid"


def with_srid(df: DataFrame, srid: int, column: str = "geometry") -> DataFrame:
    """Declare the reference system of a geometry column; coordinates stay as they are."""
    return df.withMetadata(column, {SRID_KEY: srid})


def srid_of(df: DataFrame, column: str = "geometry") -> int:
    """The declared SRID of a geometry column; an undeclared one is an error."""
    metadata = df.schema[column].metadata
    if SRID_KEY not in metadata:
        raise ValueError(f"column {column!r} has no declared SRID")
    return int(metadata[SRID_KEY])


def to_parcel_schema(df: DataFrame, *more: str) -> DataFrame:
    """Cast to the standard columns, junk to null; columns a county lacks become null.

    ``more`` names further columns to keep. The SRID of the geometry column is kept.
    """
    from pyspark.sql import functions as F

    from lotwise.functions.values import to_number

    columns = []
    for field in PARCEL_SCHEMA.fields:
        if field.name not in df.columns:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif field.name == "geometry":
            columns.append(F.col("geometry"))
        elif isinstance(field.dataType, T.DoubleType):
            columns.append(to_number(field.name).alias(field.name))
        else:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
    return df.select(*columns, *more)


def require_columns(available: list[str], wanted: list[str]) -> None:
    """Fail when a wanted column does not exist in the source."""
    missing = [c for c in wanted if c not in available]
    if missing:
        raise ValueError(f"columns not in the source: {missing}; available: {list(available)}")
