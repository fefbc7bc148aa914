"""GeoJSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions import geometry as G

GEOMETRY = "struct<type:string,coordinates:string>"


def _decoded(features: DataFrame) -> DataFrame:
    g = F.col("geometry")
    return features.select(
        "properties.*", G.from_geojson(g["type"], g["coordinates"]).alias("geometry")
    )


def read_geojson(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """FeatureCollection files. One file is one document, hence one task: for large
    layers use one feature per line (``read_geojson_lines``)."""
    schema = f"features array<struct<properties:struct<{fields}>,geometry:{GEOMETRY}>>"
    files = spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")
    return _decoded(files.select(F.inline("features")))


def read_geojson_lines(spark: SparkSession, path: str, fields: str) -> DataFrame:
    """One GeoJSON feature per line: files split over any number of tasks. A line that
    is not JSON raises."""
    schema = f"properties struct<{fields}>, geometry {GEOMETRY}"
    return _decoded(spark.read.schema(schema).json(path, mode="FAILFAST"))


def feature_lines(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Rows as GeoJSON features, one text per row."""
    properties = F.struct(*[F.col(c) for c in df.columns if c != geometry])
    feature = F.struct(
        F.lit("Feature").alias("type"),
        properties.alias("properties"),
        G.to_geojson(geometry).alias("geometry"),
    )
    return df.select(F.to_json(feature).alias("value"))


def write_geojson(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write one feature per line, in parallel."""
    feature_lines(df).write.mode(mode).text(path)
