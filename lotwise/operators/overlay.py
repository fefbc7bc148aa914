"""Exact dissolve: the union of each key's shapes, also where they overlap.

Edges of one key that cross or lie on each other are found by a join on grid cells whose
side is the mean edge length, so that all edges together touch a few cells each. Both are
cut at the same point. A piece of an edge is on the union's border unless another shape
of the key has it the other way round (both sides are covered) or holds it inside (found
by the point join, with the piece's middle). Pieces that several shapes have the same way
count once. The border is traced to rings as in ``dissolve``.

Cut points are rounded to doubles, once for both edges; crossings that are closer to each
other than that are one. Shapes are taken to be valid: their own edges do not cross.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from lotwise.operators.dissolve import assemble_parts, border_area, trace_rings
from lotwise.operators.spatial import points_in_polygons
from lotwise.session import durable

EDGE = ["ax", "ay", "bx", "by"]
LINE = ["lx", "ly", "hx", "hy"]


def keyed_shapes(df: DataFrame, key: str, shape: str = "geometry") -> DataFrame:
    """(key, _shape, _id), written: each different shape of a key once, oriented."""
    rows = df.where(F.col(key).isNotNull() & F.col(shape).isNotNull())
    named = rows.select(key, G.oriented(shape).alias("_shape"), G.fingerprint(G.canonical(shape)).alias("_id"))
    return durable(named.dropDuplicates([key, "_id"]), "shapes")


def _edges(shapes: DataFrame, key: str) -> DataFrame:
    edges = shapes.select(key, "_id", F.explode(G.edges_of("_shape")).alias("e")).select(key, "_id", "e.*")
    return edges.where((F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by")))


def _cells(side: float) -> Column:
    """The cells (x, y) that an edge passes, column by column; a hair more, as heights at
    the columns' borders are rounded."""
    ax, ay, bx, by = (F.col(c) for c in EDGE)
    column = lambda v: F.floor(v / F.lit(side)).cast("bigint")
    columns = F.sequence(column(F.least(ax, bx)), column(F.greatest(ax, bx)))
    slope = F.try_divide(by - ay, bx - ax)
    hair = (F.abs(ay) + F.abs(by) + F.lit(side)) * F.lit(1e-12)

    def rows(c: Column) -> Column:
        heights = [
            F.least(F.greatest(ay + (border - ax) * slope, F.least(ay, by)), F.greatest(ay, by))
            for border in (c * F.lit(side), (c + 1) * F.lit(side))
        ]
        low = F.when(ax == bx, F.least(ay, by)).otherwise(F.least(*heights))
        high = F.when(ax == bx, F.greatest(ay, by)).otherwise(F.greatest(*heights))
        lines = F.sequence(column(low - hair), column(high + hair))
        return F.transform(lines, lambda r: F.struct(c.alias("_cx"), r.alias("_cy")))

    return F.flatten(F.transform(columns, rows))


def crossings(edges: DataFrame, key: str) -> DataFrame:
    """(key, _id, edge, x, y): where edges (a written table) of different shapes of one key
    meet, for both edges."""
    longest = F.greatest(F.abs(F.col("bx") - F.col("ax")), F.abs(F.col("by") - F.col("ay")))
    side = edges.agg(F.avg(longest)).first()[0] or 1.0
    celled = edges.select(key, "_id", F.struct(*EDGE).alias("e"), F.inline(_cells(side)))
    other = celled.select(key, F.col("_id").alias("_id2"), F.col("e").alias("f"), "_cx", "_cy")
    met = celled.join(other, [key, "_cx", "_cy"]).where("_id < _id2").select(key, "_id", "e", "_id2", "f").distinct()
    ax, ay, bx, by = (F.col(f"e.{c}") for c in EDGE)
    cx, cy, dx, dy = (F.col(f"f.{c}") for c in EDGE)
    across = (bx - ax) * (dy - cy) - (by - ay) * (dx - cx)
    t = F.try_divide((cx - ax) * (dy - cy) - (cy - ay) * (dx - cx), across)
    u = F.try_divide((cx - ax) * (by - ay) - (cy - ay) * (bx - ax), across)
    at = [G.point(x, y) for x, y in ((ax, ay), (bx, by), (cx, cy), (dx, dy))]
    # a corner is cut at as it is, not as it would be computed
    place = (
        F.when(t == 0, at[0]).when(t == 1, at[1]).when(u == 0, at[2]).when(u == 1, at[3])
        .otherwise(G.point(ax + t * (bx - ax), ay + t * (by - ay)))
    )

    def within(p: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
        return (
            p["x"].between(F.least(x0, x1), F.greatest(x0, x1)) & p["y"].between(F.least(y0, y1), F.greatest(y0, y1))
        )

    on_line = (across == 0) & ((bx - ax) * (cy - ay) - (by - ay) * (cx - ax) == 0)
    ends = F.filter(
        F.array(*at), lambda p: within(p, ax, ay, bx, by) & within(p, cx, cy, dx, dy)
    )
    points = F.when((t >= 0) & (t <= 1) & (u >= 0) & (u <= 1), F.array(place)).when(on_line, ends)
    found = met.select(key, "_id", "e", "_id2", "f", F.explode(points).alias("p"))
    return (
        found.select(key, "_id", "e", "p")
        .unionByName(found.select(key, F.col("_id2").alias("_id"), F.col("f").alias("e"), "p"))
        .select(key, "_id", "e.*", F.col("p.x").alias("x"), F.col("p.y").alias("y"))
        .distinct()
    )


def _pieces(edges: DataFrame, key: str) -> DataFrame:
    """(key, _id, line, way): edges cut where they meet others, from the lower end on."""
    starts = edges.select(key, "_id", *EDGE, F.col("ax").alias("x"), F.col("ay").alias("y"))
    stops = starts.unionByName(crossings(edges, key)).distinct()
    along = (F.col("x") - F.col("ax")) * (F.col("bx") - F.col("ax")) + (F.col("y") - F.col("ay")) * (
        F.col("by") - F.col("ay")
    )
    order = Window.partitionBy(key, "_id", *EDGE).orderBy(along, "x", "y")
    end = F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))
    cut = stops.withColumn("_next", F.coalesce(F.lead(F.struct("x", "y")).over(order), end))
    cut = cut.where((F.col("x") != F.col("_next.x")) | (F.col("y") != F.col("_next.y")))
    forward = F.struct("x", "y") < F.col("_next")
    low = F.when(forward, F.struct("x", "y")).otherwise(F.col("_next"))
    high = F.when(forward, F.col("_next")).otherwise(F.struct("x", "y"))
    return cut.select(
        key, "_id", low["x"].alias("lx"), low["y"].alias("ly"), high["x"].alias("hx"), high["y"].alias("hy"),
        F.when(forward, 1).otherwise(-1).alias("way"),
    )


def union_border(shapes: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Directed border edges (key, ax, ay, bx, by, copy) of each key's union, inside on
    the left; and the keys whose shapes overlap."""
    pieces = durable(_pieces(durable(_edges(shapes, key), "edges"), key), "pieces")
    lines = pieces.groupBy(key, *LINE).agg(
        F.min("way").alias("least"), F.max("way").alias("most"), F.count(F.lit(1)).alias("times")
    )
    lines = durable(lines, "lines")
    middle = G.point((F.col("lx") + F.col("hx")) / 2, (F.col("ly") + F.col("hy")) / 2)
    middles = lines.select(key, *LINE, middle.alias("_middle"))
    inside = points_in_polygons(middles, shapes, "_middle", "_shape", same=(key,)).select(key, *LINE, "_id")
    # a shape covers the middles of its own border as well
    within = inside.join(pieces.select(key, *LINE, "_id"), [key, *LINE, "_id"], "left_anti")
    within = durable(within.select(key, *LINE).distinct(), "within")
    doubled = lines.where((F.col("times") > 1) & (F.col("least") == F.col("most"))).select(key)
    overlapping = within.select(key).unionByName(doubled).distinct()
    one_way = lines.where(F.col("least") == F.col("most")).join(within, [key, *LINE], "left_anti")
    up = F.col("least") > 0
    ends = {"ax": ("lx", "hx"), "ay": ("ly", "hy"), "bx": ("hx", "lx"), "by": ("hy", "ly")}
    border = one_way.select(
        key, *[F.when(up, F.col(a)).otherwise(F.col(b)).alias(c) for c, (a, b) in ends.items()], F.lit(1).alias("copy")
    )
    return border, overlapping


def covered_area(df: DataFrame, key: str, shape: str = "geometry") -> DataFrame:
    """(key, area, overlaps): area that the key's shapes cover together, and whether some
    of it is covered twice. No ring is traced for it."""
    border, overlapping = union_border(keyed_shapes(df, key, shape), key)
    areas = border_area(border, key)
    flagged = overlapping.withColumn("overlaps", F.lit(True))
    return areas.join(flagged, key, "left").select(key, "area", F.coalesce("overlaps", F.lit(False)).alias("overlaps"))


def dissolve_exact(df: DataFrame, key: str, shape: str = "geometry") -> DataFrame:
    """(key, shape, overlaps): the union of each key's shapes, and whether they overlap."""
    metadata = df.schema[shape].metadata
    border, overlapping = union_border(keyed_shapes(df, key, shape), key)
    border = durable(border, "border")
    parts = assemble_parts(durable(trace_rings(border, key), "rings"), key)
    whole = parts.groupBy(key).agg(F.sort_array(F.collect_list("part")).alias(shape))
    flagged = overlapping.withColumn("overlaps", F.lit(True))
    out = whole.join(flagged, key, "left").select(key, shape, F.coalesce("overlaps", F.lit(False)).alias("overlaps"))
    return out.withMetadata(shape, metadata)
