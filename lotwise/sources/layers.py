"""Layers that are read by window: Parquet whose files hold neighbouring shapes.

A layer is written in Z-order of the shapes' middles, with the bounds of each shape beside
it (``bbox``) and the bounds of each file in ``_bounds``, one row a file, which is written
last: a layer without it was never finished. A window then names the files whose bounds
meet it, Parquet skips row groups by the statistics of ``bbox``, and the rest is a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from lotwise.functions.once import with_computed
from lotwise.operators.spatial import grid_unit, z_order
from lotwise.sources.tables import pick

BOUNDS = "_bounds"
Window = tuple[float, float, float, float]  # xmin, ymin, xmax, ymax


def write_layer(
    df: DataFrame, path: str, geometry: str = "geometry", files: int | None = None, mode: str = "errorifexists"
) -> None:
    """Write ``df`` as a layer; without ``files`` Spark picks their number by size.

    Rows without a shape, or of an empty one, are kept but are in no window.
    """
    boxed = with_computed(df, bbox=G.bounding_box(geometry))
    middle = [(F.col(f"bbox.{a}min") + F.col(f"bbox.{a}max")) / 2 for a in "xy"]
    order = z_order(*middle, grid_unit(df, geometry))
    ranges = boxed.repartitionByRange(*([files] if files else []), order)
    ranges.sortWithinPartitions(order).write.mode(mode).parquet(path)
    spark = df.sparkSession
    sides = [F.min("bbox.xmin"), F.min("bbox.ymin"), F.max("bbox.xmax"), F.max("bbox.ymax")]
    names = ("xmin", "ymin", "xmax", "ymax")
    bounds = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(*[s.alias(n) for s, n in zip(sides, names, strict=True)])
    )
    bounds.write.mode("overwrite").parquet(f"{path}/{BOUNDS}")


def meets(window: Window, prefix: str = "") -> Column:
    """Whether bounds and window share a point, borders included."""
    xmin, ymin, xmax, ymax = window
    return (
        (F.col(f"{prefix}xmin") <= xmax)
        & (F.col(f"{prefix}xmax") >= xmin)
        & (F.col(f"{prefix}ymin") <= ymax)
        & (F.col(f"{prefix}ymax") >= ymin)
    )


def read_window(
    spark: SparkSession, path: str, window: Window, columns: list[str] | None = None
) -> DataFrame:
    """Rows whose shape's bounds meet the window, all columns but ``bbox`` by default."""
    found = spark.read.parquet(f"{path}/{BOUNDS}").where(meets(window)).select("file").collect()
    layer = spark.read.parquet(path)
    if found:
        layer = spark.read.schema(layer.schema).parquet(*sorted(f"{path}/{r['file']}" for r in found))
    else:
        layer = layer.where(F.lit(False))
    rows = layer.where(meets(window, "bbox."))
    return pick(rows, columns or [c for c in layer.columns if c != "bbox"])
