"""Helpers that build small geometry tables."""

from pyspark.sql import types as T

from lotwise.schema import POINT, SHAPE


def closed(points):
    points = [(float(x), float(y)) for x, y in points]
    return [*points, points[0]]


def rectangle(x0, y0, x1, y1):
    return [[closed([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])]]


def shape_table(spark, rows, *columns):
    """rows: (..., shape); columns: DDL of all but the shape."""
    fields = [T.StructField(*c) for c in columns] + [T.StructField("geometry", SHAPE)]
    return spark.createDataFrame(rows, T.StructType(fields))


def point_table(spark, points):
    schema = T.StructType(
        [T.StructField("pid", T.LongType()), T.StructField("point", POINT)]
    )
    return spark.createDataFrame([(i, p) for i, p in enumerate(points)], schema)


def on_segment(p, a, b):
    cross = (b[0] - a[0]) * (p[1] - a[1]) - (p[0] - a[0]) * (b[1] - a[1])
    return (
        cross == 0
        and min(a[0], b[0]) <= p[0] <= max(a[0], b[0])
        and min(a[1], b[1]) <= p[1] <= max(a[1], b[1])
    )


def covers(shape, p):
    """Brute force: border included, even-odd over all rings."""
    inside = False
    for part in shape:
        for ring in part:
            for a, b in zip(ring, ring[1:]):
                if on_segment(p, a, b):
                    return True
                if (a[1] > p[1]) != (b[1] > p[1]):
                    x = (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]
                    inside ^= p[0] < x
    return inside


def ring_area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) / 2


LONG = T.LongType()
STRING = T.StringType()
