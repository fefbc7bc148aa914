"""Geometry as nested columns.

A point is ``struct<x, y>``; a shape is parts -> rings (first is outer) -> points.
Everything here is a Column built from Spark's array functions, so it runs in the
JVM next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- construction -----------------------------------------------------------


def point(x: Column | str, y: Column | str) -> Column:
    return F.struct(_col(x).cast("double").alias("x"), _col(y).cast("double").alias("y"))


def ring(*points: Column) -> Column:
    return F.array(*points)


def polygon(outer: Column, *holes: Column) -> Column:
    """A shape of one part."""
    return F.array(F.array(outer, *holes))


def x_of(p: Column | str) -> Column:
    return _col(p)["x"]


def y_of(p: Column | str) -> Column:
    return _col(p)["y"]


# --- walking ----------------------------------------------------------------


def points_of(shape: Column | str) -> Column:
    return F.flatten(F.flatten(_col(shape)))


def ring_edges(r: Column) -> Column:
    """Consecutive point pairs of a closed ring."""
    n = F.greatest(F.size(r) - 1, F.lit(0))
    return F.zip_with(
        F.slice(r, F.lit(1), n),
        F.slice(r, F.lit(2), n),
        lambda a, b: F.struct(
            a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")
        ),
    )


def edges_of(shape: Column | str) -> Column:
    return F.flatten(F.transform(F.flatten(_col(shape)), ring_edges))


# --- measures ---------------------------------------------------------------


def _ring_moments(r: Column, ox: Column, oy: Column) -> Column:
    """Twice the signed area and its first moments (times 3) about (ox, oy)."""

    def add(acc: Column, e: Column) -> Column:
        ax, ay = e["ax"] - ox, e["ay"] - oy
        bx, by = e["bx"] - ox, e["by"] - oy
        cross = ax * by - bx * ay
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["mx"] + (ax + bx) * cross).alias("mx"),
            (acc["my"] + (ay + by) * cross).alias("my"),
        )

    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    return F.aggregate(ring_edges(r), zero, add)


def ring_area(r: Column) -> Column:
    """Signed area: positive for a counter-clockwise ring."""
    first = F.get(r, F.lit(0))
    return F.aggregate(
        ring_edges(r),
        F.lit(0.0),
        lambda acc, e: acc
        + (e["ax"] - first["x"]) * (e["by"] - first["y"])
        - (e["bx"] - first["x"]) * (e["ay"] - first["y"]),
        lambda acc: acc / 2.0,
    )


def area(shape: Column | str) -> Column:
    """Outer rings minus holes, whatever way the rings run."""
    signed = F.transform(
        _col(shape),
        lambda part: F.aggregate(
            F.transform(
                part, lambda r, i: F.abs(ring_area(r)) * F.when(i == 0, 1.0).otherwise(-1.0)
            ),
            F.lit(0.0),
            lambda acc, v: acc + v,
        ),
    )
    return F.aggregate(signed, F.lit(0.0), lambda acc, v: acc + v)


def centroid(shape: Column | str) -> Column:
    """Area-weighted centroid; null for an empty or flat shape.

    Sums are taken about the first vertex: projected coordinates are large and
    parcels small.
    """
    s = _col(shape)
    first = F.get(points_of(s), F.lit(0))
    # bound as a variable: as an expression it would be computed for every edge
    return F.get(F.transform(F.array(first), lambda origin: _centroid_about(s, origin)), F.lit(0))


def _centroid_about(s: Column, origin: Column) -> Column:
    def upright(m: Column, i: Column) -> Column:
        sign = F.signum(m["a"]) * F.when(i == 0, 1.0).otherwise(-1.0)
        return F.struct(
            (m["a"] * sign).alias("a"), (m["mx"] * sign).alias("mx"), (m["my"] * sign).alias("my")
        )

    moments = F.flatten(
        F.transform(
            s,
            lambda part: F.transform(
                F.transform(part, lambda r: _ring_moments(r, origin["x"], origin["y"])), upright
            ),
        )
    )
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))
    return F.aggregate(
        moments,
        zero,
        lambda acc, m: F.struct(
            (acc["a"] + m["a"]).alias("a"),
            (acc["mx"] + m["mx"]).alias("mx"),
            (acc["my"] + m["my"]).alias("my"),
        ),
        lambda acc: F.when(
            acc["a"] != 0.0,
            F.struct(
                (origin["x"] + F.try_divide(acc["mx"], acc["a"] * 3.0)).alias("x"),
                (origin["y"] + F.try_divide(acc["my"], acc["a"] * 3.0)).alias("y"),
            ),
        ),
    )


def box_of_points(points: Column) -> Column:
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("xmin"),
        F.array_min(ys).alias("ymin"),
        F.array_max(xs).alias("xmax"),
        F.array_max(ys).alias("ymax"),
    )


def bounding_box(shape: Column | str) -> Column:
    return box_of_points(points_of(shape))


# --- predicates -------------------------------------------------------------


def edges_cover(edges: Column | str, x: Column | str, y: Column | str) -> Column:
    """Does the area bounded by the edges hold the point, its border included?

    Even-odd rule over all rings, so holes and several parts need no care. One
    pass: the count turns negative, and stays so, once the point is on an edge.
    No division, so horizontal edges are no special case.
    """
    px, py = _col(x), _col(y)

    def step(acc: Column, e: Column) -> Column:
        ax, ay, bx, by = e["ax"], e["ay"], e["bx"], e["by"]
        side = (bx - ax) * (py - ay) - (px - ax) * (by - ay)
        on_edge = (
            (py >= F.least(ay, by))
            & (py <= F.greatest(ay, by))
            & (px >= F.least(ax, bx))
            & (px <= F.greatest(ax, bx))
            & (side == 0.0)
        )
        crosses = ((ay <= py) & (by > py) & (side > 0.0)) | (
            (by <= py) & (ay > py) & (side < 0.0)
        )
        return (
            F.when(acc < 0, acc)
            .when(on_edge, F.lit(-1))
            .when(crosses, acc + F.lit(1))
            .otherwise(acc)
        )

    return F.aggregate(
        _col(edges), F.lit(0), step, lambda acc: (acc < 0) | (acc.bitwiseAND(F.lit(1)) == 1)
    )


def covers(shape: Column | str, x: Column | str, y: Column | str) -> Column:
    return edges_cover(edges_of(shape), x, y)


def is_finite(v: Column) -> Column:
    return F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))


def is_valid_point(p: Column | str) -> Column:
    c = _col(p)
    return is_finite(c["x"]) & is_finite(c["y"])


def is_valid_shape(shape: Column | str) -> Column:
    """At least one ring; every ring closed, of four or more finite points."""
    rings = F.flatten(_col(shape))

    def good(r: Column) -> Column:
        return (
            (F.size(r) >= 4)
            & (F.get(r, F.lit(0)) == F.element_at(r, -1))
            & F.forall(r, is_valid_point)
        )

    return F.coalesce((F.size(rings) > 0) & F.forall(rings, good), F.lit(False))


# --- orientation and identity -----------------------------------------------


def oriented(shape: Column | str) -> Column:
    """Outer rings counter-clockwise, holes clockwise: the inside is on the left."""

    def turn(r: Column, i: Column) -> Column:
        return F.when((ring_area(r) >= 0) == (i == 0), r).otherwise(F.reverse(r))

    return F.transform(_col(shape), lambda part: F.transform(part, turn))


def canonical(shape: Column | str) -> Column:
    """Oriented, closed rings from their lowest point on, holes and parts in order: equal
    for shapes that differ only in where rings start, how they turn, or order."""

    def from_lowest(r: Column) -> Column:
        ends = F.get(r, F.lit(0)) == F.get(r, F.size(r) - 1)
        points = F.slice(r, 1, F.greatest(F.size(r) - 1, F.lit(0)))

        def turned(o: Column) -> Column:
            at = F.array_position(o, F.array_min(o)).cast("int")
            return F.concat(F.slice(o, at, F.size(o)), F.slice(o, 1, at))

        moved = F.transform(F.array(points), turned)[0]
        return F.when(ends & (F.size(r) > 1), moved).otherwise(r)

    def part(p: Column) -> Column:
        rings = F.transform(p, from_lowest)
        holes = F.sort_array(F.slice(rings, 2, F.greatest(F.size(p), F.lit(1))))
        return F.concat(F.slice(rings, 1, 1), holes)

    return F.sort_array(F.transform(oriented(shape), part))


def fingerprint(shape: Column | str) -> Column:
    """SHA-256 of the coordinates in order: equal exactly for equal vertex lists."""
    return F.sha2(_col(shape).cast("string"), 256)


# --- GeoJSON ----------------------------------------------------------------


def _positions(r: Column) -> Column:
    return F.transform(r, lambda p: F.array(p["x"], p["y"]))


def to_geojson(shape: Column | str) -> Column:
    """GeoJSON geometry object, always a MultiPolygon."""
    coordinates = F.transform(_col(shape), lambda part: F.transform(part, _positions))
    return F.when(
        _col(shape).isNotNull(),
        F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates")),
    )


def _points(positions: Column) -> Column:
    return F.transform(
        positions, lambda xy: F.struct(xy[0].alias("x"), xy[1].alias("y"))
    )


def shape_of_positions(rings: Column) -> Column:
    """One part from rings given as position arrays."""
    return F.transform(rings, _points)


def from_geojson(kind: Column, coordinates: Column) -> Column:
    """Shape from a geometry's type and the JSON text of its coordinates."""
    one = F.from_json(coordinates, "array<array<array<double>>>")
    many = F.from_json(coordinates, "array<array<array<array<double>>>>")
    return F.when(kind == "Polygon", F.array(shape_of_positions(one))).when(
        kind == "MultiPolygon", F.transform(many, shape_of_positions)
    )


def point_from_geojson(kind: Column, coordinates: Column) -> Column:
    xy = F.from_json(coordinates, "array<double>")
    return F.when(kind == "Point", F.struct(xy[0].alias("x"), xy[1].alias("y")))
