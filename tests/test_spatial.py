"""Spatial joins against brute force."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotwise.operators import cover, skew, spatial
from lotwise.schema import with_srid
from tests.shapes import LONG, STRING, closed, covers, point_table, rectangle, shape_table

SHAPES = pa.list_(pa.list_(pa.list_(pa.struct({"x": pa.float64(), "y": pa.float64()}))))


def brute(points, shapes):
    return sorted(
        (i, j) for i, p in enumerate(points) for j, s in enumerate(shapes) if s and covers(s, p)
    )


def found(pairs):
    return sorted((r["pid"], r["id"]) for r in pairs.select("pid", "id").collect())


def mixed_shapes():
    """Small, large, many-edged, holed, several parts, stacked, overlapping, empty."""
    rng = random.Random(7)
    wheel = closed(
        [
            (60 + r * math.cos(2 * math.pi * i / 700), 60 + r * math.sin(2 * math.pi * i / 700))
            for i, r in ((i, 40 + 5 * math.sin(i)) for i in range(700))
        ]
    )
    shapes = [
        rectangle(0, 0, 4, 4),
        rectangle(4, 0, 8, 4),
        rectangle(4, 0, 8, 4),
        rectangle(-300, -300, 300, 300),
        [[closed([(0, 0), (50, 0), (50, 50), (0, 50)]), closed([(10, 10), (20, 10), (20, 20)])]],
        [[closed([(0, 0), (2, 0), (2, 2)])], [closed([(100, 100), (130, 100), (130, 130)])]],
        [[wheel]],
        None,
        [],
    ]
    for _ in range(15):
        x, y, s = rng.randrange(-40, 90), rng.randrange(-40, 90), 2 ** rng.randrange(0, 7)
        shapes.append([[closed([(x, y), (x + s, y), (x + s // 2, y + s)])]])
    return list(enumerate(shapes))


def many_points():
    rng = random.Random(11)
    points = [(float(rng.randrange(-45, 140)), float(rng.randrange(-45, 140))) for _ in range(300)]
    points += [(rng.uniform(-50, 140), rng.uniform(-50, 140)) for _ in range(150)]
    return points + [(0.0, 0.0), (4.0, 2.0), (8.0, 4.0), (300.0, 300.0), (-300.0, 0.0)]


def test_pairs_equal_brute_force(spark):
    shapes, points = mixed_shapes(), many_points()
    polygons = shape_table(spark, shapes, ("id", LONG))
    pairs = spatial.points_in_polygons(point_table(spark, points), polygons)
    assert found(pairs) == brute(points, [s for _, s in shapes])


def test_hot_places_and_hot_shapes_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(spatial, "LEAST_COPIES", 10)
    shapes = [s for _, s in mixed_shapes() if s]
    shapes = list(enumerate(shapes + [rectangle(0, 0, 4, 4)] * 150))
    points = [(1.0, 1.0)] * 400 + many_points()
    polygons = shape_table(spark, shapes, ("id", LONG)).repartition(5)
    table = point_table(spark, points).repartition(5)
    unit = spatial.grid_unit(polygons, "geometry")
    coded = table.withColumn("_code", spatial.z_order(F.col("point")["x"], F.col("point")["y"], unit))
    dealt, cells = spatial._dealt(coded, spatial._cells(polygons, "geometry", unit))
    keys = [spatial.BUCKET, spatial.SALT]
    assert dealt.where("point.x = 1 and point.y = 1").select(*keys).distinct().count() > 4
    assert cells.where("id > 100").select(spatial.SALT).distinct().count() > 4
    pairs = spatial.points_in_polygons(table, polygons)
    assert found(pairs) == brute(points, [s for _, s in shapes])


def test_one_row_a_point_whatever_the_sizes(spark):
    polygons = shape_table(spark, [(i, s) for i, s in mixed_shapes() if s], ("id", LONG))
    table = point_table(spark, many_points())
    unit = spatial.grid_unit(polygons, "geometry")
    coded = table.withColumn("_code", spatial.z_order(F.col("point")["x"], F.col("point")["y"], unit))
    dealt, _ = spatial._dealt(coded, spatial._cells(polygons, "geometry", unit))
    assert dealt.count() == table.count() == dealt.select("pid").distinct().count()


@pytest.mark.parametrize("edges", [1, 24])
def test_cells_of_random_shapes_decide_every_point(monkeypatch, edges):
    """Rings that cross themselves, shared corners, points on corners, edges and borders."""
    monkeypatch.setattr(cover, "EDGES_PER_CELL", edges)
    rng = random.Random(5)
    for _ in range(10):
        shape = [
            [closed([(rng.randrange(-8, 9), rng.randrange(-8, 9)) for _ in range(rng.randrange(3, 30))])
             for _ in range(rng.randrange(1, 3))]
            for _ in range(rng.randrange(1, 3))
        ]
        points = [(x / 2, y / 2) for x in range(-18, 19) for y in range(-18, 19)]
        rows = [None, [[[{"x": x, "y": y} for x, y in ring] for ring in part] for part in shape]]
        cells = cover.cover(pa.array(rows, SHAPES), 0.25)
        x, y = np.array(points).T
        inside = set()
        for p, _ in cover.Covered(x, y, 0.25, cells.columns()).pairs():
            assert not inside & set(p.tolist())
            inside |= set(p.tolist())
        assert inside == {i for i, q in enumerate(points) if covers(shape, q)}


@pytest.mark.parametrize(
    "unit, points_per_cell, at_once", [(0.25, 0, 1000), (0.25, 3, 1 << 17), (2.0**-20, 16, 1 << 17)]
)
def test_counts_of_cells_equal_their_pairs(monkeypatch, points_per_cell, at_once, unit):
    """Rings that cross themselves, holes, several parts, also beyond the grid's end."""
    monkeypatch.setattr(cover, "POINTS_PER_CELL", points_per_cell)
    monkeypatch.setattr(cover, "PIECES_AT_ONCE", at_once)
    rng = random.Random(9)
    shapes = [None, []]
    for n in (4, 7, 30) if unit == 0.25 else (4, 7):
        rings = [closed([(rng.randrange(-8, 9), rng.randrange(-8, 9)) for _ in range(n)]) for _ in range(3)]
        shapes.append([[[{"x": x, "y": y} for x, y in ring] for ring in rings[:2]], [[{"x": x, "y": y} for x, y in rings[2]]]])
        shapes.append([[[{"x": x, "y": y} for x, y in rings[0]]]])
    x, y = np.array([(x / 2, y / 2) for x in range(-18, 19) for y in range(-18, 19)]).T
    ones = np.array([rng.randrange(2) for _ in x])
    covered = cover.Covered(x, y, unit, cover.cover(pa.array(shapes, SHAPES), unit).columns())
    want = np.zeros((2, len(covered.level)), np.int64)
    for p, c in covered.pairs():
        np.add.at(want, (0, c), ones[p])
        np.add.at(want, (1, c), 1)
    assert want.any() and np.array_equal(covered.counted(ones), want)
    nowhere = np.zeros(0)
    assert not np.any(cover.Covered(nowhere, nowhere, unit, cover.cover(pa.array(shapes, SHAPES), unit).columns()).counted(ones[:0]))


def test_counting_tests_points_near_edges_only(monkeypatch):
    """Shapes piled up over many points: most points are inside or outside with a whole part."""
    rng = np.random.default_rng(3)
    x, y = rng.uniform(0, 1000, (2, 20_000))
    boxes = []
    for i in range(50):
        ring = closed([(10.0 + i, 5.0 + i), (900.0 + i, 5.0 + i), (900.0 + i, 910.0 + i), (10.0 + i, 910.0 + i)])
        boxes.append([[[{"x": p, "y": q} for p, q in ring]]])
    covered = cover.Covered(x, y, 0.5, cover.cover(pa.array(boxes, SHAPES), 0.5).columns())
    made, plain = [], cover.tested

    def watched(x, *more):
        made.append(len(x))
        return plain(x, *more)

    monkeypatch.setattr(cover, "tested", watched)
    total, seen = covered.counted(np.ones(len(x), np.int64))
    want = sum(int(((x >= 10 + i) & (x <= 900 + i) & (y >= 5 + i) & (y <= 910 + i)).sum()) for i in range(50))
    assert total.sum() == seen.sum() == want > 750_000
    assert sum(made) < want / 4


def test_most_points_of_a_region_need_no_edge(spark):
    turn = [2 * math.pi * i / 5000 for i in range(5000)]
    circle = closed([(60 + 40 * math.cos(t), 60 + 40 * math.sin(t)) for t in turn])
    rows = [[[[{"x": x, "y": y} for x, y in circle]]]]
    cells = cover.cover(pa.array(rows, SHAPES), 2.0**-12)
    sizes = [len(e) // 32 for e in cells.edges]
    assert max(sizes) <= cover.EDGES_PER_CELL < 5000
    whole = sum(4**k for k, e in zip(cells.level, cells.edges, strict=True) if not e)
    assert 0.9 < whole * 2.0**-24 / (math.pi * 40**2) < 1  # of the circle's area


def test_hot_keys_lists_and_salts(spark):
    key = F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k")
    df = spark.range(1000).select(key, F.col("id").alias("n"))
    hot = skew.hot_keys(skew.key_counts(df, ["k"]), ["k"], rows_per_task=100)
    assert [tuple(r) for r in hot.collect()] == [(0, 4)]
    spread = skew.spread(df, ["k"], hot, F.xxhash64("n"))
    assert spread.where("k = 0").select("_salt").distinct().count() == 4
    assert spread.where("k <> 0 and _salt <> 0").count() == 0


def test_spread_join_with_hot_keys(spark, monkeypatch):
    original = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda counts, keys: original(counts, keys, 10))
    left = spark.range(300).select(F.when(F.col("id") < 100, 0).otherwise(F.col("id")).alias("k"), "id")
    right = spark.range(250).select(
        F.when(F.col("id") > 230, 7).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 2).alias("v"),
        F.create_map(F.lit("m"), F.col("id")).alias("m"),
    ).unionByName(spark.range(15).selectExpr("0l as k", "id as v", "map('m', id) as m"))
    got = skew.spread_join(left, right, ["k"])
    want = left.join(right, "k")
    assert got.select("id", "v").exceptAll(want.select("id", "v")).count() == 0
    assert got.count() == want.count()


def test_join_without_hot_keys_stays_plain(spark):
    left, right = spark.range(50), spark.range(50).withColumn("v", F.lit(1))
    assert skew.find_hot(skew.key_counts(left, ["id"]), ["id"]) is None
    joined = skew.spread_join(left, right, ["id"])
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" not in plan and joined.count() == 50


def test_no_polygons(spark):
    polygons = shape_table(spark, [(1, None)], ("id", LONG))
    pairs = spatial.points_in_polygons(point_table(spark, [(1.0, 1.0)]), polygons)
    assert pairs.count() == 0 and pairs.columns == ["pid", "point", "id"]


def test_points_that_are_nowhere_are_ignored(spark):
    polygons = shape_table(spark, [(1, rectangle(0, 0, 4, 4))], ("id", LONG))
    points = [(float("nan"), 1.0), (1.0, float("inf")), None, (1.0, 1.0)]
    pairs = spatial.points_in_polygons(point_table(spark, points), polygons)
    assert found(pairs) == [(3, 1)]


def test_shapes_that_are_nowhere_cover_nothing(spark):
    nowhere = [[closed([(0, 0), (float("nan"), 0), (4, 4)])]]
    endless = [[closed([(0, 0), (float("inf"), 0), (4, 4)])]]
    shapes = [(1, nowhere), (2, endless), (3, [[]]), (4, rectangle(0, 0, 4, 4))]
    polygons = shape_table(spark, shapes, ("id", LONG))
    pairs = spatial.points_in_polygons(point_table(spark, [(1.0, 1.0)]), polygons)
    assert found(pairs) == [(0, 4)]


def test_counts_by_key_with_stacked_shapes(spark):
    square, other = rectangle(0, 0, 4, 4), rectangle(10, 0, 14, 4)
    rows = [("a", square), ("a", square), ("b", square), ("c", other), (None, square), ("d", None)]
    polygons = shape_table(spark, rows, ("id", STRING))
    points = point_table(spark, [(1.0, 1.0), (1.0, 1.0), (2.0, 2.0), (4.0, 4.0), (11.0, 1.0)])
    points = points.withColumn("lsn", F.when(F.col("pid") != 2, F.col("pid")))
    points = points.withColumn("lsn", F.when(F.col("pid") != 4, F.col("lsn")))
    want = {"a": 6, "b": 3, "c": 0}
    got = spatial.count_points(polygons, points, "id", "lsn")
    assert {r["id"]: r["UNITS"] for r in got.collect()} == want


def test_systems_are_aligned_or_refused(spark):
    polygons = with_srid(
        shape_table(spark, [(1, rectangle(1828000, 714000, 1829000, 715000))], ("id", LONG)), 3735
    )
    degrees = with_srid(point_table(spark, [(-83.0, 39.96), (-84.0, 39.96)]), 4269, "point")
    assert found(spatial.points_in_polygons(degrees, polygons)) == [(0, 1)]
    with pytest.raises(ValueError):
        spatial.points_in_polygons(point_table(spark, [(0.0, 0.0)]), polygons)


def test_region_of_a_shared_border_point(spark):
    regions = shape_table(
        spark, [("A", rectangle(0, 0, 4, 4)), ("B", rectangle(4, 0, 8, 4))], ("name", STRING)
    )
    points = point_table(spark, [(1.0, 1.0), (4.0, 2.0), (9.0, 9.0)]).withColumnRenamed(
        "point", "centroid"
    )
    rows = spatial.assign_region(points, regions, "name").select("pid", "name").collect()
    assert sorted(map(tuple, rows)) == [(0, "A"), (1, "A"), (1, "B")]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_no_nested_loops(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        polygons = shape_table(spark, mixed_shapes(), ("id", LONG))
        pairs = spatial.points_in_polygons(point_table(spark, many_points()), polygons)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_many_parts_are_cut_one_by_one(spark):
    side = F.col("id") * 3.0
    ring = F.array(*[
        F.struct((side + dx).alias("x"), F.lit(dy).alias("y"))
        for dx, dy in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0))
    ])
    rows = spark.range(10_000).select(F.col("id"), F.array(ring).alias("part"))
    one = rows.agg(F.sort_array(F.collect_list("part")).alias("geometry")).withColumn("k", F.lit("a"))
    shapes = one.unionByName(one)  # equal rows stay two
    cells = spatial._cells(shapes, "geometry", spatial.grid_unit(shapes, "geometry"))
    assert cells.count() <= 2 * 4 * 10_000
    points = spark.range(30_000).select(
        "id", F.struct((F.col("id") + 0.5).alias("x"), F.lit(0.5).alias("y")).alias("point")
    )
    pairs = spatial.points_in_polygons(points, shapes)
    assert pairs.count() == 20_000 and pairs.where("id % 3 = 0").count() == 20_000
