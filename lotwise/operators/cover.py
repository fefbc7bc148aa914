"""Cells that cover shapes, and the points that lie in them, as whole arrays.

The plane is cut into a grid of 2^24 by 2^24 squares, numbered in Z-order: a cell of side
2^k holds a contiguous range of 4^k numbers. A shape is covered by at most four cells about
its own size. Where these hold many edges they are cut in four, again and again: a cell
without an edge is inside or outside as a whole, and a border cell holds the edges that
pass it. What lies to its right is reduced to a parity, and to the heights at which that
parity turns within the cell, so no cell needs an edge from elsewhere.

A point is in a shape if an odd number of edges is to its right, or if it is on one. All
comparisons are made on the coordinates as given; the grid only decides who is compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Numbers of squares, with a cell's level beside, stay whole in a double (quantiles are).
BITS = 24
EDGES_PER_CELL = 24
# Edge tests made at once: some hundred megabytes at most.
TESTS_AT_ONCE = 1 << 20
# Where points are counted only, a cell with more of them is cut in four.
POINTS_PER_CELL = 64


def grid(v: np.ndarray, unit: float) -> np.ndarray:
    """Row or column of a coordinate; what lies beyond the grid goes to its border."""
    half = 1 << (BITS - 1)
    return np.floor(np.clip(v / unit, -half, half - 1)).astype(np.int64) + half


def apart(v: np.ndarray) -> np.ndarray:
    """The bits of a number, a zero bit after each."""
    for shift, mask in SPREAD:
        v = (v | (v << shift)) & mask
    return v


SPREAD = (
    (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333), (1, 0x5555555555555555),
)


def z_order(column: np.ndarray, row: np.ndarray) -> np.ndarray:
    return apart(column) | (apart(row) << 1)


def together(v: np.ndarray) -> np.ndarray:
    """Every other bit of a number, from the lowest: what ``apart`` has set apart."""
    v = v & SPREAD[-1][1]
    masks = [mask for _, mask in SPREAD[-2::-1]] + [0x00000000FFFFFFFF]
    for (shift, _), mask in zip(SPREAD[::-1], masks, strict=True):
        v = (v | (v >> shift)) & mask
    return v


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of consecutive runs of values, which may be empty."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


# --- shapes --------------------------------------------------------------------------


def edges_of(shapes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Edges (ax, ay, bx, by) of all shapes and the row of each; shapes with a coordinate
    that is no number have none."""
    parts, of_part = pc.list_flatten(shapes), pc.list_parent_indices(shapes).to_numpy()
    rings, of_ring = pc.list_flatten(parts), pc.list_parent_indices(parts).to_numpy()
    points, ring = pc.list_flatten(rings), pc.list_parent_indices(rings).to_numpy()
    x, y = (pc.struct_field(points, i).to_numpy(zero_copy_only=False).astype(float) for i in (0, 1))
    row = of_part[of_ring[ring]] if len(ring) else np.zeros(0, np.int64)
    first = np.flatnonzero(ring[1:] == ring[:-1])
    edges = np.stack([x[first], y[first], x[first + 1], y[first + 1]], 1)
    nowhere = np.unique(row[~(np.isfinite(x) & np.isfinite(y))])
    row = row[first]
    good = ~np.isin(row, nowhere)
    return edges[good], row[good]


class Cells:
    """Cells as they are found: row of the shape, level, first number, parity, edges and
    turning heights as bytes. ``plain`` ones, of shapes of few edges, come as arrays."""

    def __init__(self):
        self.plain: list[pa.Array] = []
        self.row: list[int] = []
        self.level: list[int] = []
        self.first: list[int] = []
        self.odd: list[bool] = []
        self.edges: list[bytes] = []
        self.turns: list[bytes] = []

    def add(self, row, level, first, odd=False, edges=b"", turns=b""):
        self.row.append(row)
        self.level.append(level)
        self.first.append(first)
        self.odd.append(odd)
        self.edges.append(edges)
        self.turns.append(turns)

    def add_plain(self, row, level, first, edges, n_edges):
        """Many cells at once, of all whose edges are given one after the other."""
        ends = np.concatenate([[0], np.cumsum(n_edges * edges.itemsize * 4)]).astype(np.int32)
        binary = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(ends), pa.py_buffer(edges.tobytes())])
        none = np.zeros(len(row), np.int32)
        empty = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(np.append(none, none[:1])), pa.py_buffer(b"")])
        values = row.astype(np.int64), level.astype(np.int32), first.astype(np.int64), none.astype(bool)
        self.plain = [*(pa.array(v) for v in values), binary, empty]

    def _all(self) -> list[pa.Array]:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
        values = [self.row, self.level, self.first, self.odd, self.edges, self.turns]
        found = [pa.array(v, k) for v, k in zip(values, kinds, strict=True)]
        return [pa.concat_arrays(x) for x in zip(self.plain, found, strict=True)] if self.plain else found

    def rows(self) -> pa.Array:
        return self._all()[0]

    def columns(self) -> list[pa.Array]:
        return self._all()[1:]


def cover(shapes: pa.Array, unit: float) -> Cells:
    edges, row = edges_of(shapes)
    out = Cells()
    if not len(row):
        return out
    x0, x1 = (grid(f(edges[:, 0], edges[:, 2]), unit) for f in (np.minimum, np.maximum))
    y0, y1 = (grid(f(edges[:, 1], edges[:, 3]), unit) for f in (np.minimum, np.maximum))
    begins = np.flatnonzero(np.concatenate([[True], np.diff(row) != 0]))
    counts = np.diff(np.concatenate([begins, [len(row)]]))
    low_x, low_y = np.minimum.reduceat(x0, begins), np.minimum.reduceat(y0, begins)
    high_x, high_y = np.maximum.reduceat(x1, begins), np.maximum.reduceat(y1, begins)
    side = np.maximum(high_x - low_x, high_y - low_y)
    # the least cell side, a power of two, that exceeds the shape's
    level = np.where(side > 0, np.floor(np.log2(np.maximum(side, 1))).astype(np.int64) + 1, 0)
    level = np.minimum(level, BITS)
    few = np.flatnonzero(counts <= EDGES_PER_CELL)
    if len(few):
        k, left, bottom = level[few], low_x[few] >> level[few], low_y[few] >> level[few]
        height = (high_y[few] >> k) - bottom + 1
        n = ((high_x[few] >> k) - left + 1) * height
        of, at = np.repeat(np.arange(len(few)), n), spans(np.zeros(len(few), np.int64), n)
        first = z_order(left[of] + at // height[of], bottom[of] + at % height[of]) << 2 * k[of]
        shape = few[of]
        own = edges[spans(begins[shape], counts[shape])]
        out.add_plain(row[begins[shape]], k[of], first, own, counts[shape])
    more = counts > EDGES_PER_CELL
    boxes = zip(*(v[more].tolist() for v in (begins, counts, low_x, low_y, high_x, high_y, level)), strict=True)
    for begin, count, ax, ay, bx, by, k in boxes:
        own = slice(begin, begin + count)
        roots = [(c, r) for c in range(ax >> k, (bx >> k) + 1) for r in range(ay >> k, (by >> k) + 1)]
        boxed = edges[own], x0[own], x1[own], y0[own], y1[own]
        cut(out, int(row[begin]), k, roots, *boxed, unit)
    return out


def cut(out: Cells, row: int, level: int, roots: list, edges, x0, x1, y0, y1, unit: float) -> None:
    """Cut cells until each has few edges; cells outside are left out."""
    low, high = np.minimum(edges[:, 1], edges[:, 3]), np.maximum(edges[:, 1], edges[:, 3])
    waiting = [(level, c, r, np.arange(len(edges)), False, np.zeros(0)) for c, r in roots]
    while waiting:
        k, column, line, held, odd, turns = waiting.pop()
        left, bottom = column << k, line << k
        right, top = left + (1 << k) - 1, bottom + (1 << k) - 1
        held = held[(y1[held] >= bottom) & (y0[held] <= top) & (x1[held] >= left)]
        beyond = x0[held] > right
        past, held = held[beyond], held[~beyond]
        turns = np.concatenate([turns, low[past], high[past]])
        at = grid(turns, unit)
        odd ^= bool(np.count_nonzero(at < bottom) & 1)
        turns, times = np.unique(turns[(at >= bottom) & (at <= top)], return_counts=True)
        turns = turns[times & 1 == 1]
        z = int(z_order(np.array([column]), np.array([line]))[0]) << 2 * k
        if not len(held) and not len(turns):
            if odd:
                out.add(row, k, z, True)
        elif k == 0 or len(held) + len(turns) <= EDGES_PER_CELL:
            out.add(row, k, z, odd, edges[held].tobytes(), turns.tobytes())
        else:
            for i, j in ((0, 0), (1, 0), (0, 1), (1, 1)):
                waiting.append((k - 1, 2 * column + i, 2 * line + j, held, odd, turns))


# --- points --------------------------------------------------------------------------


class Covered:
    """Points of one bucket against the cells of one bucket."""

    def __init__(self, x: np.ndarray, y: np.ndarray, unit: float, cells: list[pa.Array]):
        self.x, self.y, self.unit = x, y, unit
        self.code = z_order(grid(x, unit), grid(y, unit))
        self.level, self.first = (c.to_numpy().astype(np.int64) for c in cells[:2])
        self.odd = cells[2].to_numpy(zero_copy_only=False).astype(bool)
        self.edges, self.edge_at, self.n_edges = numbers(cells[3], 4)
        self.turns, self.turn_at, self.n_turns = numbers(cells[4], 1)

    def pairs(self, same: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Point and cell of each covered point, in bounded lots; with ``same``, only where
        the two numbers given for point and cell agree."""
        for level in np.unique(self.level).tolist():
            cells = np.flatnonzero(self.level == level)
            place = self.code >> 2 * level
            known, of_cell = np.unique(self.first[cells] >> 2 * level, return_inverse=True)
            at = np.minimum(np.searchsorted(known, place), len(known) - 1)
            points = np.flatnonzero(known[at] == place)
            wanted = at[points]
            if same is not None:
                of_cell = same[1][cells] * len(known) + of_cell
                wanted = same[0][points] * len(known) + wanted
            order = np.argsort(of_cell, kind="stable")
            keys, cells = of_cell[order], cells[order]
            a, b = np.searchsorted(keys, wanted), np.searchsorted(keys, wanted, "right")
            # so many candidates at a time that their edges stay within the bound
            work = np.concatenate([[0], np.cumsum(self.n_edges[cells] + self.n_turns[cells] + 1)])
            load = np.cumsum(work[b] - work[a])
            cuts = np.searchsorted(load, np.arange(TESTS_AT_ONCE, load[-1] if len(load) else 0, TESTS_AT_ONCE))
            for lot in np.split(np.arange(len(points)), cuts):
                counts = b[lot] - a[lot]
                p, c = np.repeat(points[lot], counts), cells[spans(a[lot], counts)]
                if len(p):
                    hit = self.tested(p, c)
                    yield p[hit], c[hit]

    def tested(self, p: np.ndarray, c: np.ndarray) -> np.ndarray:
        sides = (self.odd, self.edges, self.edge_at, self.n_edges, self.turns[:, 0], self.turn_at, self.n_turns)
        return tested(self.x[p], self.y[p], c, *sides)

    def counted(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each cell the sum of ``values`` over the points that it covers, and their number.

        Cells of many points are cut in four, again and again: points of parts that are
        inside as a whole are taken from running sums, and only those near an edge are tested.
        """
        order = np.argsort(self.code, kind="stable")
        points = self.code[order], self.x[order], self.y[order]
        running = np.concatenate([[0], np.cumsum(values[order], dtype=np.int64)])
        total, seen = np.zeros((2, len(self.level)), np.int64)
        load = np.cumsum(self.n_edges + self.n_turns + 1)
        cuts = np.flatnonzero(np.diff(load // PIECES_AT_ONCE)) + 1
        waiting = [Pieces.of(self, lot) for lot in np.split(np.arange(len(self.level)), cuts)]
        while waiting:
            pieces = waiting.pop()
            a, b = pieces.ranges(points[0])
            plain = pieces.n_edges + pieces.n_turns == 0
            inside = np.flatnonzero(plain & pieces.odd)
            np.add.at(total, pieces.cell[inside], running[b[inside]] - running[a[inside]])
            np.add.at(seen, pieces.cell[inside], (b - a)[inside])
            many = ~plain & (b - a > POINTS_PER_CELL) & (pieces.level > 0)
            few = np.flatnonzero(~plain & ~many & (b > a))
            for p, c in pieces.found(few, a, b, *points[1:]):
                np.add.at(total, pieces.cell[c], running[p + 1] - running[p])
                np.add.at(seen, pieces.cell[c], 1)
            many = np.flatnonzero(many)
            load = np.cumsum((pieces.n_edges + pieces.n_turns + 1)[many])
            cuts = np.flatnonzero(np.diff(load // PIECES_AT_ONCE)) + 1
            waiting += [pieces.quarters(lot, points[0], self.unit) for lot in np.split(many, cuts) if len(lot)]
        return total, seen


# Edges and turning heights of cells that are cut at once, before they are copied to four.
PIECES_AT_ONCE = 1 << 17


class Pieces:
    """Cells, or parts of them, as arrays: ``cell`` they are of, place, parity, edges, turns."""

    def __init__(self, cell, level, column, line, odd, edges, n_edges, turns, n_turns):
        self.cell, self.level, self.column, self.line, self.odd = cell, level, column, line, odd
        self.edges, self.n_edges, self.edge_at = edges, n_edges, np.cumsum(n_edges) - n_edges
        self.turns, self.n_turns, self.turn_at = turns, n_turns, np.cumsum(n_turns) - n_turns

    @staticmethod
    def of(cells: Covered, at: np.ndarray) -> Pieces:
        level, place = cells.level[at], cells.first[at] >> 2 * cells.level[at]
        n_edges, n_turns = cells.n_edges[at], cells.n_turns[at]
        edges = cells.edges[spans(cells.edge_at[at], n_edges)]
        turns = cells.turns[spans(cells.turn_at[at], n_turns), 0]
        return Pieces(at, level, together(place), together(place >> 1), cells.odd[at], edges, n_edges, turns, n_turns)

    def ranges(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First point of each piece and the one after the last, of points sorted by number."""
        first = z_order(self.column, self.line) << 2 * self.level
        size = np.left_shift(np.int64(1), 2 * self.level)
        return np.searchsorted(code, first), np.searchsorted(code, first + size)

    def found(self, at, a, b, x, y) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Point and piece of the covered points of the pieces ``at``, in bounded lots."""
        work = (b - a)[at] * (self.n_edges + self.n_turns + 1)[at]
        cuts = np.flatnonzero(np.diff(np.cumsum(work) // TESTS_AT_ONCE)) + 1
        for lot in np.split(at, cuts):
            counts = (b - a)[lot]
            p, c = spans(a[lot], counts), np.repeat(lot, counts)
            if len(p):
                sides = (self.odd, self.edges, self.edge_at, self.n_edges, self.turns, self.turn_at, self.n_turns)
                hit = tested(x[p], y[p], c, *sides)
                yield p[hit], c[hit]

    def quarters(self, at: np.ndarray, code: np.ndarray, unit: float) -> Pieces:
        """The quarters, of the pieces ``at``, that hold points: ``cut``, for all at once."""
        at, n = np.repeat(at, 4), len(at)
        column, line = (2 * v[at] + np.tile(i, n) for v, i in ((self.column, (0, 1, 0, 1)), (self.line, (0, 0, 1, 1))))
        level = self.level[at] - 1
        none = np.zeros(len(at), np.int64)
        a, b = Pieces(at, level, column, line, none, None, none, None, none).ranges(code)
        kept = np.flatnonzero(b > a)
        at, level, column, line = at[kept], level[kept], column[kept], line[kept]
        left, bottom = column << level, line << level
        side = np.left_shift(np.int64(1), level) - 1
        right, top = left + side, bottom + side

        own = np.repeat(np.arange(len(at)), self.n_edges[at])
        edges = self.edges[spans(self.edge_at[at], self.n_edges[at])]
        (x0, y0), (x1, y1) = (
            [grid(f(edges[:, i], edges[:, i + 2]), unit) for i in (0, 1)] for f in (np.minimum, np.maximum)
        )
        held = (y1 >= bottom[own]) & (y0 <= top[own]) & (x1 >= left[own])
        past = held & (x0 > right[own])
        held &= ~past

        low, high = (f(edges[past, 1], edges[past, 3]) for f in (np.minimum, np.maximum))
        turns = np.concatenate([self.turns[spans(self.turn_at[at], self.n_turns[at])], low, high])
        of = np.concatenate([np.repeat(np.arange(len(at)), self.n_turns[at]), own[past], own[past]])
        height = grid(turns, unit)
        odd = self.odd[at] ^ (np.bincount(of[height < bottom[of]], minlength=len(at)) & 1).astype(bool)
        within = (height >= bottom[of]) & (height <= top[of])
        turns, of = turns[within], of[within]
        order = np.lexsort((turns, of))
        turns, of = turns[order], of[order]
        # what turns the parity twice at one height turns nothing
        new = np.ones(len(of), bool)
        new[1:] = (turns[1:] != turns[:-1]) | (of[1:] != of[:-1])
        start = np.flatnonzero(new)
        start = start[np.diff(np.append(start, len(of))) & 1 == 1]
        n_edges, n_turns = (np.bincount(v, minlength=len(at)) for v in (own[held], of[start]))
        return Pieces(self.cell[at], level, column, line, odd, edges[held], n_edges, turns[start], n_turns)


def tested(x, y, c, odd, edges, edge_at, n_edges, turns, turn_at, n_turns) -> np.ndarray:
    """Whether the cells ``c`` cover the points."""
    odd = odd[c].copy()
    n = n_turns[c]
    if n.any():
        heights = turns[spans(turn_at[c], n)]
        odd ^= (sums(heights <= np.repeat(y, n), n) & 1).astype(bool)
    n = n_edges[c]
    ax, ay, bx, by = edges[spans(edge_at[c], n)].T
    px, py = np.repeat(x, n), np.repeat(y, n)
    side = (bx - ax) * (py - ay) - (px - ax) * (by - ay)
    crosses = ((ay <= py) & (by > py) & (side > 0)) | ((by <= py) & (ay > py) & (side < 0))
    on_edge = (
        (side == 0)
        & (py >= np.minimum(ay, by)) & (py <= np.maximum(ay, by))
        & (px >= np.minimum(ax, bx)) & (px <= np.maximum(ax, bx))
    )
    odd ^= (sums(crosses, n) & 1).astype(bool)
    return odd | (sums(on_edge, n) > 0)


def numbers(values: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of numbers from their bytes: all rows, first row and number of rows of each."""
    sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64) // (8 * width)
    if values.type != pa.binary() or values.null_count:
        data = b"".join(x or b"" for x in values.to_pylist())
        return np.frombuffer(data, float).reshape(-1, width), np.cumsum(sizes) - sizes, sizes
    # the bytes lie one after the other
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    data = np.frombuffer(data.slice(int(ends[0]), int(ends[-1] - ends[0])), float) if len(values) and data else np.zeros(0)
    return data.reshape(-1, width), np.cumsum(sizes) - sizes, sizes
