"""Reprojection by closed-form column math.

Formulas: J. P. Snyder, *Map Projections: A Working Manual*, USGS PP 1395 (1987),
on the GRS80 ellipsoid. Inverses use the series for latitude and one exact step after
it, which leaves errors below a millionth of a foot; nothing iterates.
Only the reference systems below are known, and no datum shift is applied.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.once import with_computed
from lotwise.schema import srid_of, with_srid

# GRS80, the US survey foot and acres per square metre / foot.
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
US_FOOT = 1200.0 / 3937.0
ACRES_PER_SQ_METRE = 0.0002471054
SQ_FEET_PER_ACRE = 43560.0

E2 = (2.0 - 1.0 / INVERSE_FLATTENING) / INVERSE_FLATTENING
E1 = math.sqrt(E2)


@dataclass(frozen=True)
class Conic:
    """Two standard parallels, origin, false easting, unit in metres."""

    kind: str  # "conformal" or "equal_area"
    south: float
    north: float
    lat0: float
    lon0: float
    easting: float
    unit: float


def _dm(degrees: int, minutes: int) -> float:
    return degrees + minutes / 60.0


# Public EPSG definitions. 4269 is geographic (lon, lat).
GEOGRAPHIC = 4269
EQUAL_AREA = 5070
OHIO_SOUTH = 3735
SYSTEMS = {
    3734: Conic("conformal", _dm(40, 26), _dm(41, 42), _dm(39, 40), -82.5, 600000.0, US_FOOT),
    3735: Conic("conformal", _dm(38, 44), _dm(40, 2), 38.0, -82.5, 600000.0, US_FOOT),
    6549: Conic("conformal", _dm(38, 44), _dm(40, 2), 38.0, -82.5, 600000.0, US_FOOT),
    5070: Conic("equal_area", 29.5, 45.5, 23.0, -96.0, 0.0, 1.0),
}
# 9822 is the code of the equal-area method; the continental-US parameters are meant.
NAMES = {"NAD83": GEOGRAPHIC, "EPSG:9822": EQUAL_AREA}


def srid_from_name(name: str | int) -> int:
    """SRID of ``3735``, ``'3735'``, ``'epsg:3735'`` or ``'NAD83'``."""
    text = str(name).strip().upper()
    srid = NAMES.get(text)
    if srid is None:
        srid = int(text.removeprefix("EPSG:"))
    if srid != GEOGRAPHIC and srid not in SYSTEMS:
        raise ValueError(f"unknown reference system {name!r}")
    return srid


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1.0 - E2 * math.sin(lat) ** 2)


def _t(lat: float) -> float:
    s = E1 * math.sin(lat)
    return math.tan(math.pi / 4 - lat / 2) / ((1.0 - s) / (1.0 + s)) ** (E1 / 2)


def _q(lat: float) -> float:
    s = math.sin(lat)
    log = math.log((1.0 - E1 * s) / (1.0 + E1 * s))
    return (1.0 - E2) * (s / (1.0 - E2 * s * s) - log / (2.0 * E1))


@dataclass(frozen=True)
class ConicConstants:
    n: float
    scale: float  # F of the conformal, C of the equal-area conic
    rho0: float


def conic_constants(c: Conic) -> ConicConstants:
    p1, p2, p0 = (math.radians(v) for v in (c.south, c.north, c.lat0))
    if c.kind == "conformal":
        n = (math.log(_m(p1)) - math.log(_m(p2))) / (math.log(_t(p1)) - math.log(_t(p2)))
        scale = _m(p1) / (n * _t(p1) ** n)
        return ConicConstants(n, scale, SEMI_MAJOR * scale * _t(p0) ** n)
    n = (_m(p1) ** 2 - _m(p2) ** 2) / (_q(p2) - _q(p1))
    scale = _m(p1) ** 2 + n * _q(p1)
    return ConicConstants(n, scale, SEMI_MAJOR * math.sqrt(scale - n * _q(p0)) / n)


# Series coefficients of sin(2a), sin(4a), ... that lead from the auxiliary
# latitude a to the geodetic one (Snyder 3-5 conformal, 3-18 authalic).
CONFORMAL_SERIES = (
    E2 / 2 + 5 * E2**2 / 24 + E2**3 / 12 + 13 * E2**4 / 360,
    7 * E2**2 / 48 + 29 * E2**3 / 240 + 811 * E2**4 / 11520,
    7 * E2**3 / 120 + 81 * E2**4 / 1120,
    4279 * E2**4 / 161280,
)
AUTHALIC_SERIES = (
    E2 / 3 + 31 * E2**2 / 180 + 517 * E2**3 / 5040,
    23 * E2**2 / 360 + 251 * E2**3 / 3780,
    761 * E2**3 / 45360,
)


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def _to_plane(srid: int):
    """Steps that take a point (lon, lat) in degrees to the plane."""
    c = SYSTEMS[srid]
    k = conic_constants(c)

    def polar(p: Column) -> Column:
        lat = F.radians(p["y"])
        s = F.sin(lat)
        if c.kind == "conformal":
            t = F.tan(F.lit(math.pi / 4) - lat / 2.0) / F.pow(
                (1.0 - E1 * s) / (1.0 + E1 * s), F.lit(E1 / 2)
            )
            rho = SEMI_MAJOR * k.scale * F.pow(t, F.lit(k.n))
        else:
            q = (1.0 - E2) * (
                s / (1.0 - E2 * s * s) - F.ln((1.0 - E1 * s) / (1.0 + E1 * s)) / (2.0 * E1)
            )
            rho = SEMI_MAJOR * F.sqrt(k.scale - k.n * q) / k.n
        return _point(rho, k.n * (F.radians(p["x"]) - math.radians(c.lon0)))

    def plane(p: Column) -> Column:
        rho, theta = p["x"], p["y"]
        return _point(
            (c.easting + rho * F.sin(theta)) / c.unit,
            (k.rho0 - rho * F.cos(theta)) / c.unit,
        )

    return [polar, plane]


def _from_plane(srid: int):
    """Steps that take a plane point to (lon, lat) in degrees."""
    c = SYSTEMS[srid]
    k = conic_constants(c)
    series = CONFORMAL_SERIES if c.kind == "conformal" else AUTHALIC_SERIES
    qp = _q(math.pi / 2)

    def auxiliary(p: Column) -> Column:
        dx = p["x"] * c.unit - c.easting
        dy = k.rho0 - p["y"] * c.unit
        rho = F.sqrt(dx * dx + dy * dy)
        if c.kind == "conformal":
            t = F.pow(rho / (SEMI_MAJOR * k.scale), F.lit(1.0 / k.n))
            lat = F.lit(math.pi / 2) - 2.0 * F.atan(t)
        else:
            ratio = rho * k.n / SEMI_MAJOR
            lat = F.asin((k.scale - ratio * ratio) / (k.n * qp))
        return _point(F.degrees(F.atan2(dx, dy) / k.n) + c.lon0, lat)

    def geodetic(p: Column) -> Column:
        lat = p["y"]
        for i, coefficient in enumerate(series, start=1):
            lat = lat + coefficient * F.sin(p["y"] * float(2 * i))
        return F.struct(p["x"].alias("x"), lat.alias("y"), p["y"].alias("auxiliary"))

    def refined(p: Column) -> Column:
        """One step of the exact equation, started from the series."""
        s = F.sin(p["y"])
        if c.kind == "conformal":
            grown = F.pow((1.0 + E1 * s) / (1.0 - E1 * s), F.lit(E1 / 2))
            t = F.tan(F.lit(math.pi / 4) + p["auxiliary"] / 2.0) * grown
            lat = 2.0 * F.atan(t) - math.pi / 2
        else:
            q = F.sin(p["auxiliary"]) * qp
            lost = q / (1.0 - E2) - s / (1.0 - E2 * s * s)
            lost = lost + F.ln((1.0 - E1 * s) / (1.0 + E1 * s)) / (2.0 * E1)
            slope = F.pow(1.0 - E2 * s * s, F.lit(2.0)) / (2.0 * F.cos(p["y"]))
            lat = p["y"] + slope * lost
        return _point(p["x"], F.degrees(lat))

    return [auxiliary, geodetic, refined]


def _steps(source: int, target: int):
    if source == target or (source in SYSTEMS and SYSTEMS[source] == SYSTEMS.get(target)):
        return []
    steps = [] if source == GEOGRAPHIC else _from_plane(source)
    return steps + ([] if target == GEOGRAPHIC else _to_plane(target))


def reproject_points(points: Column, source: int, target: int) -> Column:
    """Reproject an array of points. Each step is one pass, so that a middle value
    is computed once and not repeated inside a growing expression."""
    for step in _steps(source, target):
        points = F.transform(points, step)
    return points


def reproject_shape(shape: Column | str, source: int, target: int) -> Column:
    s = F.col(shape) if isinstance(shape, str) else shape
    if not _steps(source, target):
        return s
    return F.transform(
        s, lambda part: F.transform(part, lambda r: reproject_points(r, source, target))
    )


def reproject_point(p: Column | str, source: int, target: int) -> Column:
    c = F.col(p) if isinstance(p, str) else p
    if not _steps(source, target):
        return c
    return F.when(c.isNotNull(), F.get(reproject_points(F.array(c), source, target), F.lit(0)))


def to_srid(df: DataFrame, target: str | int, column: str = "geometry") -> DataFrame:
    """Reproject a point or shape column from its declared system and declare the new one."""
    source, goal = srid_of(df, column), srid_from_name(target)
    if not _steps(source, goal):
        return with_srid(df, goal, column)
    is_point = df.schema[column].dataType.typeName() == "struct"
    change = reproject_point if is_point else reproject_shape
    changed = with_computed(df, **{column: change(column, source, goal)})
    return with_srid(changed.select(*df.columns), goal, column)
