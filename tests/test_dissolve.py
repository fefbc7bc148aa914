"""Dissolve: area kept, shared edges gone, holes placed, blocks whole."""

import random

from pyspark.sql import functions as F

from lotwise.functions import geometry as G
from lotwise.operators import dissolve as M
from lotwise.operators import skew
from lotwise.schema import with_srid
from lotwise.session import durable
from tests.shapes import LONG, STRING, closed, covers, rectangle, ring_area, shape_table


def table(spark, rows):
    df = shape_table(spark, rows, ("row_id", LONG), ("k", STRING), ("c", STRING))
    return with_srid(df, 3735)


def plain(shape):
    return [[[tuple(p) for p in ring] for ring in part] for part in shape]


def by_key(df):
    return {r["k"]: r for r in df.collect()}


def test_hand_made_cases(spark):
    frame = [(i, j) for i in range(3) for j in range(3) if (i, j) != (1, 1)]
    rows = [(10 * i + j, "frame", None, rectangle(i, j, i + 1, j + 1)) for i, j in frame]
    island = rectangle(1.25, 1.25, 1.5, 1.5)
    rows += [(50, "frame", "late", island)]
    rows += [(60, "touch", "t", rectangle(0, 0, 1, 1)), (61, "touch", "u", rectangle(1, 1, 2, 2))]
    rows += [(70, "one", "o", rectangle(0, 0, 5, 5)), (71, "one", "p", rectangle(0, 0, 5, 5))]
    rows += [(80, "pair", "a", rectangle(0, 0, 1, 1)), (81, "pair", "b", rectangle(1, 0, 2, 1))]
    rows += [(90, None, "x", rectangle(0, 0, 9, 9)), (91, "bare", "y", None)]
    # clockwise input
    backward = [[rectangle(2, 0, 3, 1)[0][0][::-1]]]
    rows += [(95, "pair", "c", backward)]
    out = M.dissolve(table(spark, rows), "k", first=["c"])
    assert out.schema["geometry"].metadata == {"srid": 3735}
    got = by_key(out.withColumn("area", G.area("geometry")))
    assert set(got) == {"frame", "touch", "one", "pair", "bare"}
    assert {k: r["area"] for k, r in got.items()} == {
        "frame": 8.0625, "touch": 2.0, "one": 25.0, "pair": 3.0, "bare": None,
    }
    assert {k: r["c"] for k, r in got.items()} == {
        "frame": "late", "touch": "t", "one": "o", "pair": "a", "bare": "y",
    }
    rings = {k: sorted(len(p) for p in r["geometry"]) for k, r in got.items() if r["geometry"]}
    assert rings == {"frame": [1, 2], "touch": [1, 1], "one": [1], "pair": [1]}


def random_cells(rng, size=8, share=0.6):
    return {(i, j) for i in range(size) for j in range(size) if rng.random() < share}


def test_random_cell_sets(spark):
    rng = random.Random(5)
    cells = {f"k{n}": random_cells(rng) for n in range(12)}
    rows = [
        (100 * n + i * 8 + j, k, None, rectangle(i, j, i + 1, j + 1))
        for n, (k, chosen) in enumerate(cells.items())
        for i, j in chosen
    ]
    got = by_key(M.dissolve(table(spark, rows), "k"))
    assert set(got) == set(cells)
    for k, chosen in cells.items():
        shape = plain(got[k]["geometry"])
        assert sum(ring_area(r) for part in shape for r in part) == len(chosen)
        for part in shape:
            assert ring_area(part[0]) > 0 and all(ring_area(r) < 0 for r in part[1:])
            # holes lie in their outer ring
            assert all(covers([[part[0]]], p) for r in part[1:] for p in r)
        for i in range(8):
            for j in range(8):
                assert covers(shape, (i + 0.5, j + 0.5)) == ((i, j) in chosen)


def test_border_area_equals_area(spark):
    rng = random.Random(9)
    rows = [(8 * i + j, "k", None, rectangle(i, j, i + 1, j + 1)) for i, j in random_cells(rng)]
    df = table(spark, rows)
    edges = M.border_edges(df, "k")
    assert M.border_area(edges, "k").first()["area"] == len(rows)
    seen = edges.groupBy(F.least("ax", "bx"), F.least("ay", "by"), F.greatest("ax", "bx"),
                         F.greatest("ay", "by")).count()
    assert seen.where("count > 1").count() == 0


def test_overlap_keeps_every_edge(spark):
    rows = [(1, "k", None, rectangle(0, 0, 4, 4)), (2, "k", None, rectangle(2, 2, 6, 6))]
    row = M.dissolve(table(spark, rows), "k").first()
    shape = plain(row["geometry"])
    assert sum(len(r) - 1 for part in shape for r in part) == 8


def test_a_key_of_many_parts_is_one_row(spark):
    n = 12_000
    side = F.col("id") * 3.0
    ring = F.array(*[
        F.struct((side + dx).alias("x"), F.lit(dy).alias("y"))
        for dx, dy in ((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0), (0.0, 0.0))
    ])
    shapes = spark.range(n).select(
        F.col("id").alias("row_id"), F.lit("big").alias("k"), F.lit("c").alias("c"),
        F.array(F.array(ring)).alias("geometry"),
    )
    (row,) = M.dissolve(shapes, "k", first=["c"]).select("k", "c", F.size("geometry")).collect()
    assert tuple(row) == ("big", "c", n)


def test_hot_key(spark, monkeypatch):
    original = skew.hot_keys
    monkeypatch.setattr(skew, "hot_keys", lambda counts, keys: original(counts, keys, 10))
    rows = [(i, "hot", "c", rectangle(3 * i, 0, 3 * i + 1, 1)) for i in range(60)]
    rows += [(100 + i, f"k{i}", "d", rectangle(3 * i, 0, 3 * i + 1, 1)) for i in range(30)]
    out = M.dissolve(table(spark, rows), "k", first=["c"]).collect()
    assert [len(r["geometry"]) for r in out if r["k"] == "hot"] == [60]
    assert sorted(r["k"] for r in out if r["k"] != "hot") == sorted(f"k{i}" for i in range(30))


def test_dissolving_twice_changes_nothing(spark):
    rng = random.Random(2)
    rows = [(8 * i + j, "k", "c", rectangle(i, j, i + 1, j + 1)) for i, j in random_cells(rng)]
    once = M.dissolve(table(spark, rows), "k", first=["c"])
    twice = M.dissolve(once.withColumn("row_id", F.lit(1)), "k", first=["c"])
    assert twice.first()["geometry"] == once.first()["geometry"]


def test_ring_of_many_edges(spark):
    n = 40
    comb = [(0, 0), (2 * n, 0)]
    for i in range(n, 0, -1):
        comb += [(2 * i, 5), (2 * i - 1, 1)]
    rows = [(1, "k", None, [[closed(comb)]]), (2, "k", None, rectangle(0, -4, 2 * n, 0))]
    row = M.dissolve(table(spark, rows), "k").select(G.area("geometry"), F.size("geometry")).first()
    assert row[0] == ring_area(closed(comb)) + 8 * n and row[1] == 1


def test_corners_on_one_side_of_a_border(spark):
    whole, low, high = rectangle(0, 0, 1, 2), rectangle(1, 0, 3, 1), rectangle(1, 1, 3, 2)
    slope = [[closed([(0, 2), (1, 2), (3, 2), (3, 6)])]]
    steps = [[[closed([(0, 2), (1.5, 4), (0, 4)])]], [[closed([(1.5, 4), (3, 6), (0, 6), (0, 4)])]]]
    rows = [(i, "k", None, s) for i, s in enumerate([whole, low, high, slope, *steps])]
    row = M.dissolve(table(spark, rows), "k").first()
    shape = plain(row["geometry"])
    assert len(shape) == 1 and len(shape[0]) == 1
    assert ring_area(shape[0][0]) == 6 + 12


def test_copies_with_other_starts(spark):
    ring = rectangle(0, 0, 100, 100)[0][0]
    turned = [*ring[2:-1], *ring[:3]]
    rows = [(1, "k", None, [[ring]]), (2, "k", None, [[turned]]), (3, "k", None, [[ring[::-1]]])]
    row = M.dissolve(table(spark, rows), "k").select(G.area("geometry"), F.size("geometry")).first()
    assert tuple(row) == (10_000.0, 1)


def test_closed_rings_leave(spark, monkeypatch):
    """Each round writes fewer edges: small rings do not wait for the long one."""
    from lotwise.operators import dissolve as module

    written = []

    def recording(df, label="table"):
        out = durable(df, label)
        written.append(out.count())
        return out

    corners = [(float(i), 0.0) for i in range(100)] + [(99.0, 5.0), (0.0, 5.0)]
    rows = [("a", [[closed(corners)]])] + [(f"s{i}", rectangle(0, 0, 1, 1)) for i in range(30)]
    df = shape_table(spark, rows, ("k", STRING))
    edges = durable(module.border_edges(df, "k"), "edges")
    monkeypatch.setattr(module, "durable", recording)
    rings = module.trace_rings(edges, "k")
    assert rings.count() == 31
    assert written[0] == 30 * 4 + 102 and written[-1] == 102 and sorted(written, reverse=True) == written


def in_pieces(i, n=0):
    """A strip and two pieces beside it, whose corner lies on the strip's side; n more corners."""
    top = [(100 * i + 1 + j / 64, 2) for j in range(n)]
    low = [[closed([(100 * i + 1, 0), (100 * i + 3, 0), (100 * i + 3, 1), (100 * i + 1, 1)])]]
    high = [[closed([(100 * i + 1, 1), (100 * i + 3, 1), (100 * i + 3, 2), *top[::-1]] + [(100 * i + 1, 2)] * (not n))]]
    return [rectangle(100 * i, 0, 100 * i + 1, 2), low, high]


def test_few_edges_need_no_point_join(spark, monkeypatch):
    def refused(*args, **kwargs):
        raise AssertionError("point join of small keys")

    rows = [(3 * i + j, f"k{i}", None, s) for i in range(3) for j, s in enumerate(in_pieces(i))]
    monkeypatch.setattr(M, "points_in_polygons", refused)
    got = by_key(M.dissolve(table(spark, rows), "k").withColumn("area", G.area("geometry")))
    assert {k: (r["area"], len(r["geometry"])) for k, r in got.items()} == {f"k{i}": (6.0, 1) for i in range(3)}


def test_few_and_many_edges_are_cut_alike(spark, monkeypatch):
    shapes = [in_pieces(0), in_pieces(1, 60), in_pieces(2)]
    rows = [(10 * i + j, f"k{i}", None, s) for i, own in enumerate(shapes) for j, s in enumerate(own)]
    rows.append((99, "k2", None, rectangle(0, 50, 1, 51)))
    mixed = {k: plain(r["geometry"]) for k, r in by_key(M.dissolve(table(spark, rows), "k")).items()}
    monkeypatch.setattr(M, "FEW_EDGES", 0)
    by_place = {k: plain(r["geometry"]) for k, r in by_key(M.dissolve(table(spark, rows), "k")).items()}
    assert mixed == by_place
    assert {k: sum(ring_area(r) for p in shape for r in p) for k, shape in mixed.items()} == {"k0": 6, "k1": 6, "k2": 7}


def test_small_files_are_dealt(spark, sf_dir):
    from catalog import inputs

    assert inputs.lots(spark, sf_dir).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
