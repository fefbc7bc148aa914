"""Projections: published parameters, round trips, area."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from lotwise.functions.projection import (
    ACRES_PER_SQ_METRE,
    EQUAL_AREA,
    GEOGRAPHIC,
    OHIO_SOUTH,
    SYSTEMS,
    reproject_shape,
    srid_from_name,
    to_srid,
)
from lotwise.schema import srid_of, with_srid
from tests.shapes import LONG, point_table, rectangle, shape_table


def at(spark, points, source, target):
    df = with_srid(point_table(spark, points), source, "point")
    rows = to_srid(df, target, "point").orderBy("pid").collect()
    return [tuple(r["point"]) for r in rows]


def test_origin_maps_to_the_false_origin(spark):
    for srid in (3734, 3735):
        c = SYSTEMS[srid]
        x, y = at(spark, [(c.lon0, c.lat0)], GEOGRAPHIC, srid)[0]
        assert abs(x - c.easting / c.unit) < 1e-6 and abs(y) < 1e-6


def test_known_point(spark):
    x, y = at(spark, [(-83.0, 39.96)], GEOGRAPHIC, OHIO_SOUTH)[0]
    assert abs(x - 1828339.4257) < 1e-3 and abs(y - 714269.7836) < 1e-3
    x, y = at(spark, [(-83.0, 39.96)], GEOGRAPHIC, EQUAL_AREA)[0]
    assert abs(x - 1097277.6502) < 1e-3 and abs(y - 1957663.5755) < 1e-3


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.floats(-85, -80), st.floats(38, 42)), min_size=1, max_size=20))
def test_round_trips(spark, points):
    for srid in (3734, 3735, 5070):
        there = at(spark, points, GEOGRAPHIC, srid)
        back = at(spark, there, srid, GEOGRAPHIC)
        for (a, b), (c, d) in zip(points, back):
            assert abs(a - c) < 1e-11 and abs(b - d) < 1e-11


def test_equal_area_of_a_square(spark):
    square = rectangle(1828339, 714269, 1829339, 715269)
    df = shape_table(spark, [(1, square)], ("id", LONG))
    flat = reproject_shape("geometry", OHIO_SOUTH, EQUAL_AREA)
    acres = df.select(G.area(flat) * ACRES_PER_SQ_METRE).first()[0]
    assert abs(acres - 22.95754) < 1e-4


def test_names_and_declarations(spark):
    assert [srid_from_name(n) for n in ("epsg:3735", 3735, "3735", "NAD83", "epsg:9822")] == [
        3735, 3735, 3735, 4269, 5070,
    ]
    with pytest.raises(ValueError):
        srid_from_name("epsg:1")
    df = point_table(spark, [(0.0, 0.0)])
    with pytest.raises(ValueError):
        to_srid(df, 3735, "point")
    same = to_srid(with_srid(df, 3735, "point"), 6549, "point")
    assert srid_of(same, "point") == 6549
    assert same.first()["point"] == (0.0, 0.0)


def test_missing_geometry_stays_missing(spark):
    df = with_srid(shape_table(spark, [(1, None)], ("id", LONG)), 4269)
    assert to_srid(df, 3735).where(F.col("geometry").isNull()).count() == 1
