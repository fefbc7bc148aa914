"""Dissolve: merge the shapes of each key into one.

Shapes that share edges lose them: seen with the inside on the left, a shared edge
runs once each way and the two cancel, after edges were cut at the corners that lie on
them. What is left is the border, and it is linked into rings by pointer doubling, a
join per round. Keys of a single shape skip all that.

Exact where shapes of one key meet along their edges or do not touch. Overlapping
shapes keep their edges, as separate rings: containment still holds by any ring,
but area counts the overlap twice; ``overlay`` finds and unites them. Drop copies of a shape under other ids first
(``collapse``); copies within one key are dropped here,
wherever their rings start and whichever way they turn.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from lotwise.functions.once import with_computed
from lotwise.operators.collapse import first_value
from lotwise.operators.skew import key_counts, salted_left
from lotwise.operators.spatial import points_in_polygons
from lotwise.session import dealt, durable

MAX_ROUNDS = 40  # rings of up to 2^40 edges
FEW_EDGES = 32  # of a key: all its edges are compared with all its corners


def _net(edges: DataFrame, key: str) -> DataFrame:
    """(key, lx, ly, hx, hy, net): edges from their lower to their higher end, ``way``
    summed; edges that run as often each way are gone."""
    summed = edges.groupBy(key, "lx", "ly", "hx", "hy").agg(F.sum("way").alias("net"))
    return summed.where(F.col("net") != 0)


def _cut_in_rows(net: DataFrame, key: str) -> DataFrame:
    """Pieces (key, lx, ly, hx, hy, way) of keys with few edges: a key's edges are one row,
    and each edge is cut at those of their ends that lie on it."""
    end = lambda s, e: F.struct(s[f"{e}x"].alias("_x"), s[f"{e}y"].alias("_y"))
    rows = dealt(net, key).groupBy(key).agg(F.collect_list(F.struct("lx", "ly", "hx", "hy", "net")).alias("_sides"))
    ends = F.flatten(F.transform("_sides", lambda s: F.array(end(s, "l"), end(s, "h"))))
    sides = with_computed(rows, _ends=F.array_distinct(ends)).select(key, "_ends", F.explode("_sides").alias("_side"))
    side = F.col("_side")
    low, high = end(side, "l"), end(side, "h")
    flat = G.polygon(G.ring(*[G.point(e["_x"], e["_y"]) for e in (low, high, low)]))

    def cuts(c: Column) -> Column:
        near = c["_x"].between(side["lx"], side["hx"]) & c["_y"].between(
            F.least(side["ly"], side["hy"]), F.greatest(side["ly"], side["hy"])
        )
        return near & (c != low) & (c != high) & G.covers(flat, c["_x"], c["_y"])

    # ends are ordered by (x, y), so points between them are in that order as well
    inner = F.sort_array(F.filter("_ends", cuts))
    stops = with_computed(sides, _stops=F.concat(F.array(low), inner, F.array(high))).select(key, "_side.net", "_stops")
    pieces = F.zip_with(
        F.slice("_stops", F.lit(1), F.size("_stops") - 1),
        F.slice("_stops", F.lit(2), F.size("_stops") - 1),
        lambda a, b: F.struct(a["_x"].alias("lx"), a["_y"].alias("ly"), b["_x"].alias("hx"), b["_y"].alias("hy")),
    )
    return stops.select(key, F.inline(pieces), F.col("net").alias("way"))


def _cut_by_place(net: DataFrame, key: str) -> DataFrame:
    """The same for keys with many edges: the point join, with each edge as a flat polygon."""
    ends = [net.select(key, F.col(f"{e}x").alias("_x"), F.col(f"{e}y").alias("_y")) for e in "lh"]
    corners = ends[0].unionByName(ends[1]).distinct()
    corners = corners.select(key, G.point("_x", "_y").alias("_corner"))
    low, high = G.point("lx", "ly"), G.point("hx", "hy")
    side = F.struct("lx", "ly", "hx", "hy", "net")
    lines = net.select(key, side.alias("_side"), G.polygon(G.ring(low, high, low)).alias("_line"))
    on = points_in_polygons(corners, lines, "_corner", "_line", same=(key,))
    x, y = F.col("_corner.x"), F.col("_corner.y")
    inner = ((x != F.col("_side.lx")) | (y != F.col("_side.ly"))) & (
        (x != F.col("_side.hx")) | (y != F.col("_side.hy"))
    )
    cuts = durable(on.where(inner).select(key, "_side", x.alias("_x"), y.alias("_y")), "cuts")
    if cuts.isEmpty():
        return net.select(key, "lx", "ly", "hx", "hy", F.col("net").alias("way"))
    starts = net.select(
        key, side.alias("_side"), F.col("lx").alias("_x"), F.col("ly").alias("_y")
    ).unionByName(cuts)
    along = Window.partitionBy(key, "_side").orderBy("_x", "_y")
    end = F.struct(F.col("_side.hx").alias("_x"), F.col("_side.hy").alias("_y"))
    following = F.coalesce(F.lead(F.struct("_x", "_y")).over(along), end)
    return starts.withColumn("_next", following).select(
        key,
        F.col("_x").alias("lx"),
        F.col("_y").alias("ly"),
        F.col("_next._x").alias("hx"),
        F.col("_next._y").alias("hy"),
        F.col("_side.net").alias("way"),
    )


def split_at_corners(net: DataFrame, key: str) -> DataFrame:
    """Cut edges (a written table) where a corner of the same key lies on them, and
    cancel again: neighbours may have corners on one side of a border only.

    A corner counts as on an edge where the arithmetic says so exactly. Keys of few edges
    compare them all; the pairs of larger keys come from the point join.
    """
    counts = key_counts(net, [key])
    large = durable(counts.where(F.col("_n") > FEW_EDGES), "large")
    if large.isEmpty():
        return _net(_cut_in_rows(net, key), key)
    salted, (keys,), on = salted_left(net, [large.select(key)], [key], large)
    few = salted.join(keys, on, "left_anti").select(*net.columns)
    many = durable(salted.join(keys, on, "left_semi").select(*net.columns), "many")
    return _net(_cut_in_rows(few, key).unionByName(_cut_by_place(many, key)), key)


def border_edges(shapes: DataFrame, key: str, shape: str = "geometry") -> DataFrame:
    """Directed border edges (key, ax, ay, bx, by, copy), inside on the left.

    Edges are summed as +1 / -1 along one of their directions, in the map tasks
    first; what is left is cut at corners that lie on it and summed again. ``copy``
    numbers edges that overlapping shapes share on the same side.
    """
    edge = F.explode(G.edges_of(G.oriented(shape)))
    e = shapes.select(key, edge.alias("e")).select(key, "e.*")
    forward = F.struct("ax", "ay") < F.struct("bx", "by")
    low = [F.when(forward, F.col(a)).otherwise(F.col(b)) for a, b in (("ax", "bx"), ("ay", "by"))]
    high = [F.when(forward, F.col(b)).otherwise(F.col(a)) for a, b in (("ax", "bx"), ("ay", "by"))]
    ways = e.where((F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by"))).select(
        key,
        low[0].alias("lx"),
        low[1].alias("ly"),
        high[0].alias("hx"),
        high[1].alias("hy"),
        F.when(forward, 1).otherwise(-1).alias("way"),
    )
    net = split_at_corners(durable(_net(ways, key), "edges"), key)
    up = F.col("net") > 0
    return net.select(
        key,
        F.when(up, F.col("lx")).otherwise(F.col("hx")).alias("ax"),
        F.when(up, F.col("ly")).otherwise(F.col("hy")).alias("ay"),
        F.when(up, F.col("hx")).otherwise(F.col("lx")).alias("bx"),
        F.when(up, F.col("hy")).otherwise(F.col("ly")).alias("by"),
        F.explode(F.sequence(F.lit(1), F.abs("net").cast("int"))).alias("copy"),
    )


def border_area(edges: DataFrame, key: str) -> DataFrame:
    """Area per key from its border alone: no ring is needed."""
    cross = F.col("ax") * F.col("by") - F.col("bx") * F.col("ay")
    return edges.groupBy(key).agg((F.sum(cross) / 2.0).alias("area"))


def _successors(edges: DataFrame, key: str) -> DataFrame:
    """(id, next): the edge that follows each edge along its ring.

    Around a vertex, the edge that follows is the first one clockwise from the edge
    that arrives, so rings that touch in a vertex stay apart.
    """

    def seen_from(here: str, there: str, leaves: int) -> DataFrame:
        away = F.atan2(F.col(f"{there}y") - F.col(f"{here}y"), F.col(f"{there}x") - F.col(f"{here}x"))
        return edges.select(
            F.col(key).alias("k"),
            F.col(f"{here}x").alias("vx"),
            F.col(f"{here}y").alias("vy"),
            F.col(f"{there}x").alias("ox"),
            F.col(f"{there}y").alias("oy"),
            "copy",
            away.alias("angle"),
            F.lit(leaves).alias("leaves"),
            "id",
        )

    vertex = ["k", "vx", "vy"]
    others = ["ox", "oy", "copy"]
    around = Window.partitionBy(*vertex).orderBy(F.col("angle").desc(), "leaves", *others)
    kind = Window.partitionBy(*vertex, "leaves").orderBy(F.col("angle").desc(), *others)
    whole = Window.partitionBy(*vertex, "leaves")
    ranked = (
        dealt(seen_from("b", "a", 0).unionByName(seen_from("a", "b", 1)), *vertex)
        .withColumn("starts_leaving", F.first("leaves").over(around))
        .withColumn("rank", F.row_number().over(kind))
        .withColumn("degree", F.count(F.lit(1)).over(whole))
    )
    # where the first edge around the vertex leaves, the arriving ones pair one further
    partner = F.when(
        (F.col("leaves") == 0) & (F.col("starts_leaving") == 1),
        F.col("rank") % F.col("degree").cast("int") + 1,
    ).otherwise(F.col("rank"))
    of_kind = [F.max(F.when(F.col("leaves") == n, F.col("id"))).alias(c) for n, c in enumerate(("id", "next"))]
    pairs = ranked.groupBy(*vertex, partner.alias("pair")).agg(*of_kind)
    return pairs.where("id is not null and next is not null").select("id", "next")


def _doubled(state: DataFrame, r: int) -> DataFrame:
    """One round: each edge's window of 2^r edges is joined by the one that follows it.
    ``same``: both have the same lowest edge."""
    ahead = state.select(
        F.col("id").alias("next"),
        F.col("next").alias("_next"),
        F.col("low").alias("_low"),
        F.col("off").alias("_off"),
    )
    nearer = F.col("low") <= F.col("_low")
    return state.join(ahead, "next").select(
        "id",
        F.col("_next").alias("next"),
        F.least("low", "_low").alias("low"),
        F.when(nearer, F.col("off")).otherwise(F.col("_off") + 2**r).alias("off"),
        (F.col("low") == F.col("_low")).alias("same"),
    )


def trace_rings(edges: DataFrame, key: str) -> DataFrame:
    """One row per closed ring (key, ring) from directed border edges.

    Pointer doubling: after round r every edge knows the lowest edge among the next
    2^r of its ring and how far away it is. The lowest edge of the whole ring names
    the ring, the distance orders its points. Where two windows that follow each other
    have the same lowest edge, they reach around the ring, so all its edges know that
    name: the ring is closed and leaves, and later rounds see open rings alone. Rounds
    grow with the logarithm of the longest ring. Each is written to the shared folder, so
    a lost executor costs no more than that round. Edges go by a number of their own, so
    that rounds move numbers alone.
    """
    columns = ["id", "next", "low", "off"]
    # under a name of its own: the key may be called id
    named = edges.withColumnRenamed(key, "k")
    edges = durable(named.withColumn("id", F.monotonically_increasing_id()), "numbered")
    state = durable(
        _successors(edges, "k").select(
            "id", "next", F.col("id").alias("low"), F.lit(0).cast("bigint").alias("off")
        ),
        "rings",
    )
    closed = []
    for r in range(MAX_ROUNDS):
        # edges of one name so far are part of one ring
        of_name = F.max("same").over(Window.partitionBy("low"))
        seen = Observation()
        doubled = _doubled(state, r).select(*columns, of_name.alias("closed"))
        state = durable(doubled.observe(seen, F.count_if(~F.col("closed")).alias("open")), "rings")
        closed.append(state.where("closed").drop("closed"))
        state = state.where("not closed").drop("closed")
        if not seen.get["open"]:
            break
    else:
        raise RuntimeError(f"rings not closed after {MAX_ROUNDS} rounds")

    # the edge that names the ring first, then from the farthest to the nearest before it
    order = F.when(F.col("off") == 0, F.lit(-(2**62))).otherwise(-F.col("off"))
    start = F.struct(order.alias("o"), F.col("ax").alias("x"), F.col("ay").alias("y"))
    points = F.transform(F.sort_array(F.collect_list(start)), lambda s: F.struct(s["x"], s["y"]))
    whole = reduce(DataFrame.unionByName, closed).select("id", "low", "off").join(edges, "id")
    # a ring starts at its lowest edge
    lowest = F.min(F.struct("ax", "ay", "bx", "by", "copy", "off")).alias("lowest")
    traced = dealt(whole, "low").groupBy("low", "k").agg(points.alias("open"), lowest)
    before = F.pmod(F.size("open") - F.col("lowest.off"), F.size("open")).cast("int")
    turned = traced.select("k", "open", before.alias("before")).select(
        "k", F.concat(F.slice("open", F.col("before") + 1, F.size("open")), F.slice("open", F.lit(1), "before")).alias("open")
    )
    return turned.select(F.col("k").alias(key), F.concat("open", F.slice("open", 1, 1)).alias("ring"))


def assemble_parts(rings: DataFrame, key: str) -> DataFrame:
    """(key, part): each outer ring with its holes, a hole going to the smallest outer
    ring of its key around it. ``rings`` is read more than once: pass a written table."""
    sized = with_computed(rings, _size=G.ring_area(F.col("ring")))
    outers = sized.where(F.col("_size") > 0).select(key, "ring", "_size")
    inner = sized.where(F.col("_size") < 0)
    if inner.isEmpty():
        return outers.select(key, F.array("ring").alias("part"))
    # the middle of the hole's first edge: unlike a vertex, not on two outer rings
    a, b = F.col("ring")[0], F.col("ring")[1]
    holes = inner.select(
        key,
        F.col("ring").alias("hole"),
        G.point((a["x"] + b["x"]) / 2, (a["y"] + b["y"]) / 2).alias("_middle"),
    )
    named = outers.withColumn("_outer", G.fingerprint("ring"))
    candidates = named.select(key, "_size", "_outer", G.polygon(F.col("ring")).alias("_shape"))
    placed = (
        points_in_polygons(holes, candidates, "_middle", "_shape", same=(key,))
        .groupBy(key, "hole")
        .agg(F.min_by("_outer", F.struct("_size", "_outer")).alias("_outer"))
        .groupBy(key, "_outer")
        .agg(F.sort_array(F.collect_list("hole")).alias("_holes"))
    )
    part = F.concat(F.array("ring"), F.coalesce("_holes", F.array()))
    return named.join(placed, [key, "_outer"], "left").select(key, part.alias("part"))


def dissolve_parts(df: DataFrame, key: str, shape: str = "geometry") -> DataFrame:
    """(key, part): the connected pieces of each key, one row each."""
    edges = border_edges(df.where(F.col(key).isNotNull()), key, shape)
    return assemble_parts(durable(trace_rings(edges, key), "rings"), key)


def dissolve(
    df: DataFrame,
    key: str,
    first: list[str] = (),
    shape: str = "geometry",
    order: str = "row_id",
) -> DataFrame:
    """One row per key: merged shape, first non-null value of other columns.

    Rows without a key are dropped. A merged shape is one value, so the row holds all
    parts of its key, however many; ``dissolve_parts`` gives one row per part where the
    whole shape is not asked for.
    """
    metadata = df.schema[shape].metadata
    keyed = df.where(F.col(key).isNotNull())
    # read three times below: written, so that the shapes are shuffled once
    named = keyed.where(F.col(shape).isNotNull()).select(
        key, F.col(shape).alias("_shape"), F.unhex(G.fingerprint(G.canonical(shape))).alias("_print")
    )
    # dealt first: the map tasks would sort all their shapes to find a few copies
    shapes = durable(
        dealt(named, key, "_print").dropDuplicates([key, "_print"]).drop("_print"), "shapes"
    )
    several = shapes.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key)
    salted, (several,), on = salted_left(shapes, [several], [key])
    alone = salted.join(several, on, "left_anti").select(key, F.col("_shape").alias(shape))
    together = salted.join(several, on, "left_semi").select(key, "_shape")
    parts = dissolve_parts(together, key, "_shape")
    whole = parts.groupBy(key).agg(F.sort_array(F.collect_list("part")).alias(shape))
    out = alone.unionByName(whole)
    firsts = [first_value(c, order).alias(c) for c in first]
    values = keyed.groupBy(key).agg(*firsts) if firsts else keyed.select(key).distinct()
    # outer to the shapes: a key without any shape keeps its row
    return values.join(out, key, "left").withMetadata(shape, metadata)
