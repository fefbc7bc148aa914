"""Geometry columns against formulas and brute force."""

import math
import random
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from tests.shapes import LONG, closed, covers, point_table, rectangle, ring_area, shape_table


def star(cx, cy, radii):
    n = len(radii)
    return closed(
        [
            (cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n))
            for i, r in enumerate(radii)
        ]
    )


HOLED = [
    [closed([(0, 0), (10, 0), (10, 10), (0, 10)]), closed([(2, 2), (2, 4), (4, 4), (4, 2)])],
    [closed([(20, 0), (30, 0), (30, 10), (20, 10)])],
]


def test_area_and_centroid_of_parts_and_holes(spark):
    df = shape_table(spark, [(1, HOLED)], ("id", LONG))
    row = df.select(G.area("geometry").alias("a"), G.centroid("geometry").alias("c")).first()
    assert row["a"] == 196.0
    assert math.isclose(row["c"]["x"], (100 * 5 - 4 * 3 + 100 * 25) / 196)
    assert math.isclose(row["c"]["y"], (100 * 5 - 4 * 3 + 100 * 5) / 196)


def test_centroid_of_many_parts_grows_with_their_number(spark):
    side = 4000
    lots = F.transform(
        F.sequence(F.lit(0), F.lit(side - 1)),
        lambda i: F.array(G.ring(*[G.point(x, y) for x, y in ((i, i), (i + 1, i), (i + 1, i + 1), (i, i + 1), (i, i))])),
    )
    df = spark.range(1).select(lots.alias("geometry"))
    begun = time.monotonic()
    c = df.select(G.centroid("geometry").alias("c")).first()["c"]
    # all points looked up for every edge took minutes
    assert time.monotonic() - begun < 20
    assert math.isclose(c["x"], side / 2) and math.isclose(c["y"], side / 2)


def test_flat_and_missing_shapes(spark):
    flat = [[closed([(0, 0), (1, 1), (2, 2)])]]
    df = shape_table(spark, [(1, flat), (2, None), (3, [])], ("id", LONG))
    rows = df.select(
        G.area("geometry").alias("a"),
        G.centroid("geometry").alias("c"),
        G.is_valid_shape("geometry").alias("v"),
    ).collect()
    assert [r["a"] for r in rows] == [0.0, None, 0.0]
    assert [r["c"] for r in rows] == [None, None, None]
    assert [r["v"] for r in rows] == [True, False, False]


def test_validity(spark):
    open_ring = [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]]]
    short = [[[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]]]
    not_finite = [[closed([(0, 0), (float("nan"), 0), (1, 1)])]]
    good = rectangle(0, 0, 1, 1)
    rows = [(i, s) for i, s in enumerate([open_ring, short, not_finite, good])]
    df = shape_table(spark, rows, ("id", LONG))
    assert [r[0] for r in df.select(G.is_valid_shape("geometry")).collect()] == [
        False, False, False, True,
    ]


def test_border_points_are_covered(spark):
    shape = [
        [closed([(0, 0), (8, 0), (8, 8), (4, 4), (0, 8)]), closed([(1, 1), (3, 1), (3, 2), (1, 2)])]
    ]
    points = [(float(x) / 2, float(y) / 2) for x in range(-2, 19) for y in range(-2, 19)]
    df = point_table(spark, points).crossJoin(shape_table(spark, [(1, shape)], ("id", LONG)))
    rows = df.select("point", G.covers("geometry", "point.x", "point.y").alias("in")).collect()
    assert len(rows) == len(points)
    for r in rows:
        assert r["in"] == covers(shape, tuple(r["point"])), r["point"]


@settings(max_examples=8, deadline=None)
@given(
    st.lists(st.floats(1, 50), min_size=3, max_size=12),
    st.floats(-1e6, 1e6),
    st.floats(-1e6, 1e6),
    st.integers(0, 11),
)
def test_area_does_not_depend_on_place_start_or_direction(spark, radii, cx, cy, turn):
    ring = star(0.0, 0.0, radii)
    moved = [(x + cx, y + cy) for x, y in ring]
    body = ring[:-1]
    turn %= len(body)
    turned = closed(body[turn:] + body[:turn])
    rows = [(i, [[r]]) for i, r in enumerate([ring, moved, turned, ring[::-1]])]
    df = shape_table(spark, rows, ("id", LONG))
    areas = [r[0] for r in df.orderBy("id").select(G.area("geometry")).collect()]
    assert all(math.isclose(a, ring_area(ring), rel_tol=1e-6, abs_tol=1e-6) for a in areas)


def test_geojson_both_ways(spark):
    df = shape_table(spark, [(1, HOLED), (2, rectangle(0, 0, 1, 2)), (3, None)], ("id", LONG))
    text = df.select("id", "geometry", F.to_json(G.to_geojson("geometry")).alias("j"))
    back = text.withColumn(
        "g", F.from_json("j", "type string, coordinates string")
    ).withColumn("back", G.from_geojson(F.col("g.type"), F.col("g.coordinates")))
    assert back.where(~F.col("geometry").eqNullSafe(F.col("back"))).count() == 0
    one = spark.sql("select 'Polygon' as t, '[[[0,0],[1,0],[1,1],[0,0]]]' as c")
    shape = one.select(G.from_geojson(F.col("t"), F.col("c")).alias("g")).first()["g"]
    assert [[[tuple(p) for p in r] for r in part] for part in shape] == [
        [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)]]
    ]


def test_orientation(spark):
    rng = random.Random(3)
    holed = [[HOLED[0][0][::-1], HOLED[0][1][::-1]]]
    shapes = [HOLED, holed, [[star(0, 0, [rng.uniform(1, 2) for _ in range(7)])[::-1]]]]
    df = shape_table(spark, list(enumerate(shapes)), ("id", LONG))
    for r in df.select(G.oriented("geometry").alias("g")).collect():
        for part in r["g"]:
            signs = [ring_area([tuple(p) for p in ring]) > 0 for ring in part]
            assert signs == [i == 0 for i in range(len(part))]
