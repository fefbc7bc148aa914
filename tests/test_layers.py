"""Layers read by window: the rows of a full scan, from a fraction of the files."""

import os

import pytest
from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from lotwise.schema import srid_of, with_srid
from lotwise.sources import layers

WINDOW = (1000.0, 1000.0, 1500.0, 1400.0)


@pytest.fixture(scope="module")
def squares(spark):
    """100 x 100 squares of side 50 on a grid of 100, one without a shape, one very long."""
    x, y = (F.col("id") % 100) * 100.0, F.floor(F.col("id") / 100) * 100.0

    def box(x0, y0, x1, y1):
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
        return G.polygon(G.ring(*[G.point(a, b) for a, b in corners]))

    shape = F.when(F.col("id") == 7, F.lit(None)).otherwise(box(x, y, x + 50, y + 50))
    rows = spark.range(10_000).select("id", (F.col("id") % 3).alias("xmin"), shape.alias("geometry"))
    long = spark.range(10_000, 10_001).select(
        "id", F.lit(0).cast("bigint").alias("xmin"), box(F.lit(0.0), F.lit(1200.0), F.lit(9e3), F.lit(1210.0)).alias("geometry")
    )
    return with_srid(rows.unionByName(long), 3735)


def test_a_window_reads_few_files_and_all_its_rows(spark, squares, tmp_path):
    path = str(tmp_path / "layer")
    layers.write_layer(squares, path, files=50)
    found = layers.read_window(spark, path, WINDOW)
    assert found.columns == squares.columns
    assert srid_of(found) == 3735
    ids = {i + 100 * j for i in range(10, 16) for j in range(10, 15)} | {10_000}
    assert {r["id"] for r in found.collect()} == ids
    assert len(found.inputFiles()) <= 10 < len([f for f in os.listdir(path) if f.endswith(".parquet")])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "bbox.xmin" in plan.split("PushedFilters: [")[1]


def test_windows_of_nothing_and_all(spark, squares, tmp_path):
    path = str(tmp_path / "layer")
    layers.write_layer(squares, path)
    assert layers.read_window(spark, path, (-9.0, -9.0, -1.0, -1.0)).count() == 0
    everywhere = layers.read_window(spark, path, (0.0, 0.0, 1e5, 1e5), ["id"])
    assert (everywhere.columns, everywhere.count()) == (["id"], 10_000)  # all but the row without a shape
    assert spark.read.parquet(path).count() == 10_001
    with pytest.raises(ValueError):
        layers.read_window(spark, path, WINDOW, ["nothing"])
    layers.write_layer(squares.limit(0), path, mode="overwrite")
    assert layers.read_window(spark, path, WINDOW).count() == 0
