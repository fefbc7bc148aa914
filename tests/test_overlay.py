"""Unions of overlapping shapes against counting unit squares."""

import random

import pytest
from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from lotwise.operators import overlay
from tests.shapes import LONG, closed, rectangle, shape_table


def squares(box):
    x0, y0, x1, y1 = box
    return {(x, y) for x in range(x0, x1) for y in range(y0, y1)}


def random_boxes(rng, n, reach=12):
    out = []
    for _ in range(n):
        x, y = rng.randrange(reach), rng.randrange(reach)
        out.append((x, y, x + rng.randrange(1, 7), y + rng.randrange(1, 7)))
    return out


def test_random_boxes_by_counting_squares(spark):
    rng = random.Random(9)
    boxes = {key: random_boxes(rng, rng.randrange(1, 9)) for key in range(60)}
    boxes[60] = [(0, 0, 6, 1), (0, 5, 6, 6), (0, 0, 1, 6), (5, 0, 6, 6)]  # a frame: a hole
    boxes[61] = [(0, 0, 4, 4)] * 3  # copies are one shape
    boxes[62] = [(0, 0, 4, 4), (4, 4, 8, 8)]  # touch in a corner
    rows = [(k, rectangle(*b)) for k, own in boxes.items() for b in own] + [(None, rectangle(0, 0, 1, 1)), (63, None)]
    df = shape_table(spark, rows, ("id", LONG)).withColumn("note", F.lit("x"))
    want = {}
    for key, own in boxes.items():
        own = set(own)
        covered = set().union(*map(squares, own))
        want[key] = (float(len(covered)), len(covered) < sum(len(squares(b)) for b in own))
    got = {r["id"]: (r["area"], r["overlaps"]) for r in overlay.covered_area(df, "id").collect()}
    assert got == want
    whole = overlay.dissolve_exact(df, "id")
    rows = whole.select("id", G.area("geometry").alias("area"), "overlaps", F.size("geometry").alias("parts"),
                        F.size(F.flatten("geometry")).alias("rings"), G.is_valid_shape("geometry").alias("valid")).collect()
    assert {r["id"]: (r["area"], r["overlaps"]) for r in rows} == want and all(r["valid"] for r in rows)
    parts = {r["id"]: (r["parts"], r["rings"]) for r in rows}
    assert parts[60] == (1, 2) and parts[61] == (1, 1) and parts[62] == (2, 2)


def test_points_stay_inside(spark):
    """Crossing triangles: a point is in the union where it is in one of them."""
    from tests.shapes import covers

    rng = random.Random(10)
    rows, shapes = [], {}
    for key in range(25):
        for _ in range(rng.randrange(2, 6)):
            corners = [(rng.randrange(20), rng.randrange(20)) for _ in range(3)]
            (ax, ay), (bx, by), (cx, cy) = corners
            if (bx - ax) * (cy - ay) != (by - ay) * (cx - ax):
                shape = [[closed(corners)]]
                rows.append((key, shape))
                shapes.setdefault(key, []).append(shape)
    merged = overlay.dissolve_exact(shape_table(spark, rows, ("id", LONG)), "id").collect()
    assert {r["id"] for r in merged} == set(shapes)
    for r in merged:
        union = [[[(p["x"], p["y"]) for p in ring] for ring in part] for part in r["geometry"]]
        for _ in range(60):
            p = (rng.randrange(200) / 10 + 0.0137, rng.randrange(200) / 10 + 0.0211)
            assert covers(union, p) == any(covers(s, p) for s in shapes[r["id"]]), (r["id"], p)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(None, rectangle(0, 0, 1, 1))]])
def test_nothing_to_dissolve(spark, rows):
    df = shape_table(spark, rows, ("id", LONG))
    assert overlay.covered_area(df, "id").count() == 0 and overlay.dissolve_exact(df, "id").count() == 0


def test_cells_follow_the_edges(spark):
    """A cell holds every edge that passes it, also along borders and steep slopes."""
    rng = random.Random(11)
    rows = [tuple(float(rng.randrange(-9, 10)) for _ in range(4)) for _ in range(200)]
    df = spark.createDataFrame(rows, "ax double, ay double, bx double, by double")
    found = df.select("*", overlay._cells(2.0).alias("cells")).collect()
    for r in found:
        cells = {(c["_cx"], c["_cy"]) for c in r["cells"]}
        for i in range(101):
            t = i / 100
            x, y = r["ax"] + t * (r["bx"] - r["ax"]), r["ay"] + t * (r["by"] - r["ay"])
            near = {(int((x + dx) // 2), int((y + dy) // 2)) for dx in (-1e-9, 1e-9) for dy in (-1e-9, 1e-9)}
            assert near & cells
