"""Point-in-polygon joins (border included) over ranges of Z-order numbers.

A point is one number, and one row whatever the sizes of the shapes; a shape is a few
cells, each a range of numbers (``cover``). The numbers are cut into buckets that hold
about the same share of the points and of the cells, found by quantiles over all rows in
one job. A point goes to its bucket, a cell to each bucket that its range meets, and each
bucket is one cogroup, joined by whole arrays.

A number that many points share is several buckets, over which its points are dealt;
its cells are copied to them. A cell that many shapes share is dealt over salts, and the
few points in it are copied. Nothing is broadcast, and there is no switch by size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.functions import geometry as G
from lotwise.functions.projection import GEOGRAPHIC, to_srid
from lotwise.operators.cover import BITS, SPREAD, Covered, cover
from lotwise.schema import SRID_KEY, srid_of

# Side of a grid square: three metres of latitude, half a foot or metre.
DEGREES, LENGTHS = 2.0**-15, 2.0**-1
# Each bucket holds at most this part of a shuffle partition's share.
BUCKETS_PER_PARTITION = 4
LEAST_COPIES = 1000

CELL = [
    T.StructField("_level", T.IntegerType()),
    T.StructField("_first", T.LongType()),
    T.StructField("_odd", T.BooleanType()),
    T.StructField("_edges", T.BinaryType()),
    T.StructField("_turns", T.BinaryType()),
]
BUCKET, SALT = "_bucket", "_salt"
LEVEL_BITS = 5


def aligned(df: DataFrame, other: DataFrame, column: str, other_column: str) -> DataFrame:
    """``df`` in the reference system of ``other``; an unknown system on one side only
    is an error. Two undeclared sides are taken to agree."""
    known = [SRID_KEY in d.schema[c].metadata for d, c in ((df, column), (other, other_column))]
    if not any(known):
        return df
    return to_srid(df, srid_of(other, other_column), column)


def grid_unit(polygons: DataFrame, shape: str) -> float:
    """Side of the grid's squares: by the reference system, or where that is not declared
    by the largest coordinate."""
    declared = polygons.schema[shape].metadata.get(SRID_KEY)
    if declared is not None:
        return DEGREES if int(declared) == GEOGRAPHIC else LENGTHS
    reach = F.array_max(F.transform(G.points_of(shape), lambda p: F.greatest(F.abs(p["x"]), F.abs(p["y"]))))
    most = polygons.agg(F.max(F.when(G.is_finite(reach), reach))).first()[0] or 1.0
    return 2.0 ** (np.ceil(np.log2(max(most, 2.0**-900))) + 1 - (BITS - 1))


def _grid(v: Column, unit: float) -> Column:
    half = 1 << (BITS - 1)
    held = F.least(F.greatest(v / F.lit(unit), F.lit(float(-half))), F.lit(float(half - 1)))
    return F.floor(held).cast("bigint") + F.lit(half)


def z_order(x: Column, y: Column, unit: float) -> Column:
    """The number of a point's grid square."""

    def apart(v: Column) -> Column:
        for shift, mask in SPREAD:
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return apart(_grid(x, unit)).bitwiseOR(F.shiftleft(apart(_grid(y, unit)), 1))


def _at_most(bounds: list[int], code: Column) -> Column:
    """How many of the sorted bounds are at most ``code``: a binary search."""
    if not bounds:
        return F.lit(0)
    array = F.array(*[F.lit(b) for b in bounds]).cast("array<bigint>")
    steps = F.array(*[F.lit(1 << s) for s in range(len(bounds).bit_length() - 1, -1, -1)])

    def step(found: Column, size: Column) -> Column:
        there = F.get(array, found + size - 1)
        return F.when(F.coalesce(there <= code, F.lit(False)), found + size).otherwise(found)

    return F.aggregate(steps, F.lit(0), step)


def _cells(polygons: DataFrame, shape: str, unit: float) -> DataFrame:
    """The polygons without their shape, one row for each cell that covers it."""
    kept = [f for f in polygons.schema.fields if f.name != shape]
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in kept], *CELL])
    names = [f.name for f in schema.fields]

    def covered(batches):
        for batch in batches:
            cells = cover(batch.column(0), unit)
            row = cells.rows()
            if len(row):
                rest = batch.select(range(1, batch.num_columns)).take(row)
                yield pa.RecordBatch.from_arrays([*rest.columns, *cells.columns()], names=names)

    ordered = polygons.where(F.size(shape) > 0).select(shape, *[F.col(f"`{f.name}`") for f in kept])
    return ordered.mapInArrow(covered, schema)


def _quantiles(points: DataFrame, cells: DataFrame) -> tuple[list[int], list[int], float]:
    """Numbers that cut the points, and cells that cut the cells, into equal shares, and
    the cells in a share; the one job in which both sides are looked over."""
    conf = points.sparkSession.conf
    shares = BUCKETS_PER_PARTITION * int(conf.get("spark.sql.shuffle.partitions"))
    at = [i / shares for i in range(1, shares)]
    none = F.lit(None).cast("bigint")
    keyed = F.shiftleft(F.col("_first"), LEVEL_BITS).bitwiseOR(F.col("_level").cast("bigint"))
    both = points.select(F.col("_code").alias("p"), none.alias("c")).unionByName(
        cells.select(none.alias("p"), keyed.alias("c"))
    )
    quantiles = [F.percentile_approx(c, at, 10 * shares).alias(c) for c in ("p", "c")]
    row = both.agg(*quantiles, F.count("c").alias("n")).first()
    return list(row["p"] or []), list(row["c"] or []), row["n"] / shares


def _hot(keyed: list[int], per_share: float) -> list[tuple[int, int, int]]:
    """First number, level and salts of the cells that fill more than one share with
    copies. A few copies are no load, whatever their share: points are not copied for them."""
    values, times = np.unique(np.array(keyed, np.int64), return_counts=True)
    mask = (1 << LEVEL_BITS) - 1
    return [
        (int(v) >> LEVEL_BITS, int(v) & mask, int(n))
        for v, n in zip(values, times, strict=True)
        if n > 1 and n * per_share >= LEAST_COPIES
    ]


def _row_hash(df: DataFrame) -> Column:
    """Differs between rows, and between equal rows of different tasks; a task that runs
    again gives the same."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.xxhash64(F.spark_partition_id(), *plain)


def _dealt(points: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with bucket and salt: each pair of a point and a cell of its number meets
    in exactly one."""
    of_points, of_cells, per_share = _quantiles(points, cells)
    hot = _hot(of_cells, per_share)
    more = {c >> LEVEL_BITS for c in of_cells} - set(of_points)
    bounds = sorted([*of_points, *more])
    code = F.col("_code")
    upto, below = _at_most(bounds, code), _at_most(bounds, code - 1)
    placed = points.select("*", upto.alias("_upto"), below.alias("_below"), _row_hash(points).alias("_hash"))
    dealt = F.when(F.col("_upto") == F.col("_below"), F.col("_upto")).otherwise(
        F.col("_below") + 1 + F.pmod("_hash", (F.col("_upto") - F.col("_below")).cast("bigint"))
    )
    salts = F.lit(1)
    for first, level, n in hot:
        inside = F.shiftright(code, 2 * level) == F.lit(first >> 2 * level)
        salts = F.greatest(salts, F.when(inside, n).otherwise(1))
    salt = F.explode(F.sequence(F.lit(0), salts - 1)) if hot else F.lit(0)
    kept = [f"`{c}`" for c in points.columns if c != "_code"]
    points = placed.select(*kept, dealt.cast("int").alias(BUCKET), salt.alias(SALT))

    first, level = F.col("_first"), F.col("_level")
    own = F.lit(0)
    for number, k, n in hot:
        own = F.when((first == number) & (level == k), F.pmod(F.col("_hash"), F.lit(n))).otherwise(own)
    last = first + F.pow(F.lit(4.0), level).cast("bigint") - 1
    low = F.when(_at_most(bounds, first) == _at_most(bounds, first - 1), _at_most(bounds, first)).otherwise(
        _at_most(bounds, first - 1) + 1
    )
    buckets = F.sequence(low, _at_most(bounds, last))
    names = [f"`{c}`" for c in cells.columns]
    cells = cells.withColumn("_hash", _row_hash(cells)).select(*names, own.cast("int").alias(SALT), F.explode(buckets).alias(BUCKET))
    return points, cells


def _coordinates(points: pa.Table, column: str) -> tuple[np.ndarray, np.ndarray]:
    values = points.column(column).combine_chunks()
    return tuple(pc.struct_field(values, i).to_numpy(zero_copy_only=False) for i in (0, 1))


def _covered(points: pa.Table, cells: pa.Table, point: str, unit: float) -> Covered:
    parts = [cells.column(f.name).combine_chunks() for f in CELL]
    return Covered(*_coordinates(points, point), unit, parts)


def _agreement(points: pa.Table, cells: pa.Table, same: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray] | None:
    """A number for the ``same`` columns of each row: equal for equal, present values."""
    if not same:
        return None
    n = points.num_rows
    out, known = np.zeros(n + cells.num_rows, np.int64), np.ones(n + cells.num_rows, bool)
    for c in same:
        values = pa.chunked_array([*points.column(c).chunks, *cells.column(c).chunks], points.schema.field(c).type)
        coded = values.combine_chunks().dictionary_encode()
        known &= coded.is_valid().to_numpy(zero_copy_only=False)
        index = pc.fill_null(coded.indices, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        _, out = np.unique(out * (len(coded.dictionary) + 1) + index, return_inverse=True)
    # unknown values agree with nothing
    out[~known] = -1
    out[n:][~known[n:]] = -2
    return out[:n] + 2, out[n:] + 2


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    point: str = "point",
    shape: str = "geometry",
    same: tuple[str, ...] = (),
) -> DataFrame:
    """All (point, polygon) pairs where the polygon covers the point, border included.

    Columns of both sides are kept, the shape excepted; ``same`` names columns both
    sides have that must also be equal.

    Both sides are read twice, once for the quantiles: pass written tables where they
    are costly to compute.
    """
    points = aligned(points, polygons, point, shape)
    own = [c for c in points.columns if c not in same]
    clash = set(own) & set(polygons.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    unit = grid_unit(polygons, shape)
    valid = points.where(G.is_valid_point(point))
    coded = valid.withColumn("_code", z_order(F.col(point)["x"], F.col(point)["y"], unit))
    dealt, cells = _dealt(coded, _cells(polygons, shape, unit))
    added = [f for f in polygons.schema.fields if f.name != shape and f.name not in same]
    fields = [*points.schema.fields, *added]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    names, more = points.columns, [f.name for f in added]

    def met(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [(np.zeros(0, np.int64),) * 2]
        if left.num_rows and right.num_rows:
            found += list(_covered(left, right, point, unit).pairs(_agreement(left, right, same)))
        p, c = (np.concatenate(x) for x in zip(*found, strict=True))
        sides = left.select(names).take(p), right.select(more).take(c)
        return pa.table({name: t.column(name) for t in sides for name in t.column_names})

    keys = (BUCKET, SALT)
    pairs = dealt.groupBy(*keys).cogroup(cells.groupBy(*keys)).applyInArrow(met, schema)
    for f in fields:
        if f.metadata:
            pairs = pairs.withMetadata(f.name, f.metadata)
    return pairs


def count_points(
    polygons: DataFrame,
    points: DataFrame,
    key: str,
    value: str,
    out: str = "UNITS",
    shape: str = "geometry",
    point: str = "point",
) -> DataFrame:
    """Per ``key``: how many points with a non-null ``value`` lie in its polygons.

    Keys without any point have no row. A bucket hands on one count for each key in it.
    """
    points = aligned(points, polygons, point, shape)
    unit = grid_unit(polygons, shape)
    places = points.where(G.is_valid_point(point)).select(
        F.col(point).alias("_point", metadata={}), F.col(value).isNotNull().cast("int").alias("_one")
    )
    coded = places.withColumn("_code", z_order(F.col("_point")["x"], F.col("_point")["y"], unit))
    owners = polygons.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), F.col(shape).alias("_shape", metadata=polygons.schema[shape].metadata)
    )
    dealt, cells = _dealt(coded, _cells(owners, "_shape", unit))
    kind = polygons.schema[key].dataType
    schema = T.StructType([T.StructField("_key", kind), T.StructField("_n", T.LongType())])

    def counted(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            empty = right.column("_key").slice(0, 0)
            return pa.table({"_key": empty, "_n": pa.array([], pa.int64())})
        ones = left.column("_one").to_numpy()
        coded = right.column("_key").combine_chunks().dictionary_encode()
        index = coded.indices.to_numpy()
        totals, seen = np.zeros((2, len(coded.dictionary)), np.int64)
        for of_key, of_cell in zip((totals, seen), _covered(left, right, "_point", unit).counted(ones), strict=True):
            np.add.at(of_key, index, of_cell)
        held = np.flatnonzero(seen)
        return pa.table({"_key": coded.dictionary.take(pa.array(held)), "_n": pa.array(totals[held])})

    keys = (BUCKET, SALT)
    counts = dealt.groupBy(*keys).cogroup(cells.groupBy(*keys)).applyInArrow(counted, schema)
    return counts.groupBy(F.col("_key").alias(key)).agg(F.sum("_n").alias(out))


def assign_region(
    df: DataFrame,
    regions: DataFrame,
    label: str,
    point: str = "centroid",
    shape: str = "geometry",
) -> DataFrame:
    """Inner join of points to the region that covers them; adds the region's label.

    A point on a shared border gets one row per region, as an intersects join gives.
    Most points fall into cells that lie wholly inside a region, and need no edge test.
    """
    metadata = regions.schema[shape].metadata
    sides = regions.select(label, F.col(shape).alias("_region", metadata=metadata))
    return points_in_polygons(df, sides, point, "_region")
