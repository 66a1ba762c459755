"""The geometry kernel over whole Arrow columns of WKB.

Shapes of one layout (kinds, counts and byte order, all but the coordinates) are measured at once; rectangles are compared and cut by their sides alone. What has no
such way goes through ``geometry`` shape by shape, equal ones of a batch once.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from . import geometry as G

#: Sides nearer to each other than this, and not the same, are left to the general overlay, which snaps to its grid.
_CLEAR = 100 * 1e-9
_RECTANGLE = struct.pack("<BIII", 1, 3, 1, 5)
_LEAST, _MOST_RUNS, _CELLS = 4, 64, 1 << 20


# ---- columns


def _parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each value begins, its length (-1 for NULL), and all bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type != pa.binary():
        column = column.cast(pa.binary())
    if not len(column):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    sizes = np.diff(ends)
    if column.null_count:
        sizes[column.is_null().to_numpy(zero_copy_only=False)] = -1
    return ends[:-1], sizes, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def column_of(count: int, blocks: list[tuple[np.ndarray, np.ndarray]], others: dict[int, bytes | None]) -> pa.Array:
    """A column from rows of bytes for some places and single values for others; all else is NULL."""
    sizes, there = np.zeros(count, np.int64), np.zeros(count, dtype=bool)
    for places, rows in blocks:
        sizes[places], there[places] = rows.shape[1], True
    for place, value in others.items():
        if value is not None:
            sizes[place], there[place] = len(value), True
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    if offsets[-1] >= 1 << 31:
        raise ValueError("a batch of shapes is larger than 2 GB; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    data = np.empty(int(offsets[-1]), np.uint8)
    for places, rows in blocks:
        data[offsets[places][:, None] + np.arange(rows.shape[1])] = rows
    for place, value in others.items():
        if value:
            data[offsets[place] : offsets[place] + len(value)] = np.frombuffer(value, np.uint8)
    mask = pa.py_buffer(np.packbits(there, bitorder="little"))
    return pa.Array.from_buffers(pa.binary(), count, [mask, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


@dataclass
class Layout:
    """Shapes without points that differ in coordinates only. ``rings`` and ``lines`` have a row for each shape."""

    places: np.ndarray
    rows: np.ndarray
    runs: list[tuple[int, int, int, str]]
    polygons: list[list[int]]
    lines: list[int]

    def coordinates(self, run: int) -> np.ndarray:
        at, count, width, order = self.runs[run]
        return np.ascontiguousarray(self.rows[:, at : at + 8 * width * count]).view(order + "f8").reshape(len(self.rows), count, width)[:, :, :2].astype(np.float64)

    def edges(self) -> np.ndarray:
        """As ``geometry._all_edges``: those of polygons before those of lines."""
        chains = [self.coordinates(k) for k in [r for p in self.polygons for r in p] + self.lines if self.runs[k][1] > 1]
        return np.concatenate([np.concatenate([c[:, :-1], c[:, 1:]], axis=2) for c in chains], axis=1) if chains else np.zeros((len(self.rows), 0, 4))


def _walk(data: bytes) -> tuple[list[tuple[int, int, int, str]], list[list[int]], list[int]] | None:
    """Runs of coordinates as (at, count, width, order), and which of them make polygons and lines; None for shapes with points."""
    runs: list[tuple[int, int, int, str]] = []
    polygons, lines = [], []

    def walk(at: int) -> int:
        order = "<" if data[at] else ">"
        (code,) = struct.unpack_from(order + "I", data, at + 1)
        at += 9 if code & 0x20000000 else 5
        kind, width = code & 0xFFFF, 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
        if kind >= 1000:
            kind, width = kind % 1000, {1: 3, 2: 3, 3: 4}[kind // 1000]
        if kind == 1:
            return -1
        (count,) = struct.unpack_from(order + "I", data, at)
        at += 4
        if kind == 2:
            runs.append((at, count, width, order))
            if count:
                lines.append(len(runs) - 1)
            return at + 8 * width * count
        own = []
        for _ in range(count):
            if kind == 3:
                (n,) = struct.unpack_from(order + "I", data, at)
                own.append(len(runs))
                runs.append((at + 4, n, width, order))
                at += 4 + 8 * width * n
            else:
                at = walk(at)
            if at < 0 or len(runs) > _MOST_RUNS:
                return -1
        if own and runs[own[0]][1]:
            polygons.append(own)
        return at

    return (runs, polygons, lines) if walk(0) >= 0 else None


def layouts(column: pa.Array) -> tuple[list[Layout], list[int]]:
    """The layouts of several rows, and the places of all other shapes; NULLs are in neither."""
    begins, sizes, data = _parts(column)
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    found, others = [], []
    for places in np.split(order, cuts) if len(order) else []:
        size = int(sizes[places[0]])
        if size < 0:
            continue
        for _ in range(4):  # layouts of one length are few
            if len(places) < _LEAST:
                break
            first = bytes(data[begins[places[0]] : begins[places[0]] + size])
            walked = _walk(first)
            if walked is None:
                break
            rows = data[begins[places][:, None] + np.arange(size)]
            fixed = np.ones(size, dtype=bool)
            for at, count, width, _ in walked[0]:
                fixed[at : at + 8 * width * count] = False
            alike = (rows[:, fixed] == rows[0, fixed]).all(axis=1)
            found.append(Layout(places[alike], rows[alike], *walked))
            places = places[~alike]
        others += places.tolist()
    return found, others


def _once(column: pa.Array, places: list[int], function: Callable) -> Iterator[tuple[int, object]]:
    """A function's values for single shapes, those of equal ones computed once."""
    known: dict[bytes, object] = {}
    for place in places:
        value = column[place].as_py()
        if value not in known:
            known[value] = function(value)
        yield place, known[value]


def _numbers(column: pa.Array, many: Callable[[Layout], np.ndarray], one: Callable[[bytes], object], width: int = 1) -> np.ndarray:
    """Numbers of each shape, NaN for NULL and where there is none."""
    out = np.full((len(column), width), np.nan)
    found, others = layouts(column)
    for layout in found:
        out[layout.places] = np.reshape(many(layout), (len(layout.places), width))
    for place, value in _once(column, others, one):
        if value is not None:
            out[place] = value
    return out


def nullable(values: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    """A column of doubles, NULL where the values are NaN, or where it is said."""
    return pa.array(values, pa.float64(), mask=np.isnan(values) if missing is None else missing)


def nulls(column: pa.Array) -> np.ndarray:
    return column.is_null().to_numpy(zero_copy_only=False)


# ---- measures


def _ring_areas(rings: np.ndarray) -> np.ndarray:
    if rings.shape[1] < 3:
        return np.zeros(len(rings))
    x, y = np.moveaxis(rings - rings[:, :1], 2, 0)
    return (np.einsum("ij,ij->i", x[:, :-1], y[:, 1:]) - np.einsum("ij,ij->i", x[:, 1:], y[:, :-1])) / 2


def _summed(layout: Layout, measure: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """A measure of outer rings less that of holes."""
    out = np.zeros(len(layout.places))
    for polygon in layout.polygons:
        for number, run in enumerate(polygon):
            size = np.abs(measure(layout.coordinates(run)))
            out += -size if number else size
    return out


def areas(column: pa.Array) -> np.ndarray:
    return _numbers(column, lambda x: _summed(x, _ring_areas), lambda w: G.area_of(G.decode(w).polygons))[:, 0]


def geodesic_areas(column: pa.Array) -> np.ndarray:
    return _numbers(column, lambda x: np.abs(_summed(x, G.ring_square_meters)), lambda w: G.geodesic_area(G.decode(w).polygons))[:, 0]


def bounds(column: pa.Array) -> np.ndarray:
    """Least and greatest x and y; NaN for NULL and empty shapes."""

    def many(layout: Layout) -> np.ndarray:
        runs = layout.lines + [p[0] for p in layout.polygons]
        if not runs:
            return np.full((len(layout.places), 4), np.nan)
        every = np.concatenate([layout.coordinates(k) for k in runs], axis=1)
        return np.concatenate([every.min(axis=1), every.max(axis=1)], axis=1)

    return _numbers(column, many, lambda w: G.bounds(G.decode(w)), 4)


def first_vertices(column: pa.Array) -> np.ndarray:
    """A vertex of each shape: a polygon's, else a line's or a point; NaN for NULL and empty shapes."""

    def many(layout: Layout) -> np.ndarray:
        runs = [p[0] for p in layout.polygons] + layout.lines
        return layout.coordinates(runs[0])[:, 0] if runs else np.full((len(layout.places), 2), np.nan)

    def one(wkb: bytes) -> np.ndarray | None:
        found = G.decode(wkb)
        chains = [p[0] for p in found.polygons] + found.lines + [p[None] for p in found.points]
        return chains[0][0] if chains else None

    return _numbers(column, many, one, 2)


def map_coordinates(column: pa.Array, change: Callable[[np.ndarray], np.ndarray]) -> pa.Array:
    found, others = layouts(column)
    blocks, rest = [], dict(_once(column, others, lambda w: G.map_coordinates(w, change)))
    for layout in found:
        rows, odd = layout.rows.copy(), np.zeros(len(layout.rows), dtype=bool)
        for at, count, width, order in layout.runs:
            if not count:
                continue
            values = np.ascontiguousarray(rows[:, at : at + 8 * width * count]).view(order + "f8").reshape(-1, width).astype(np.float64)
            odd |= np.isnan(values[:, :2]).reshape(len(rows), -1).any(axis=1)
            values[:, :2] = change(values[:, :2])
            rows[:, at : at + 8 * width * count] = values.astype(order + "f8").view(np.uint8).reshape(len(rows), -1)
        blocks.append((layout.places[~odd], rows[~odd]))
        rest |= dict(_once(column, layout.places[odd].tolist(), lambda w: G.map_coordinates(w, change)))
    return column_of(len(column), blocks, rest)


# ---- distance


def _to_edges(points: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The distance of points (..., 2) from edges (..., 4) that go with them."""
    start, along = edges[..., :2], edges[..., 2:] - edges[..., :2]
    size = (along**2).sum(axis=-1)
    gap = points - start
    t = np.clip((gap * along).sum(axis=-1) / np.where(size == 0, 1, size), 0, 1)
    return np.hypot(gap[..., 0] - t * along[..., 0], gap[..., 1] - t * along[..., 1])


def distances_to(column: pa.Array, other: G.Geometry) -> np.ndarray:
    """The planar distance of each shape from a given one; infinite for NULL and empty shapes."""
    if other.is_empty:
        return np.full(len(column), np.inf)
    theirs = G._all_edges(other)

    def many(layout: Layout) -> np.ndarray:
        edges = layout.edges()
        if not edges.shape[1] or not len(theirs):
            return np.full(len(layout.places), np.inf)
        best = np.full(len(layout.places), np.inf)
        rings = sum(self_run[1] - 1 for p in layout.polygons for k in p if (self_run := layout.runs[k])[1] > 1)
        x, y = theirs[0, :2]
        own = edges[:, :rings]
        with np.errstate(divide="ignore", invalid="ignore"):
            spans = (own[..., 1] > y) != (own[..., 3] > y)
            crossing = own[..., 0] + (y - own[..., 1]) * (own[..., 2] - own[..., 0]) / (own[..., 3] - own[..., 1])
        within = ((spans & (x < crossing)).sum(axis=1) % 2 == 1) | G.contains(other.polygons, edges[:, 0, :2])
        step_b = max(1, _CELLS // edges.shape[1])
        for low_b in range(0, len(theirs), step_b):
            b = theirs[None, None, low_b : low_b + step_b]
            step = max(1, _CELLS // (edges.shape[1] * b.shape[2]))
            for low in range(0, len(edges), step):
                a = edges[low : low + step, :, None]
                d, e, gap = a[..., 2:] - a[..., :2], b[..., 2:] - b[..., :2], b[..., :2] - a[..., :2]
                cross = d[..., 0] * e[..., 1] - d[..., 1] * e[..., 0]
                with np.errstate(divide="ignore", invalid="ignore"):
                    t = (gap[..., 0] * e[..., 1] - gap[..., 1] * e[..., 0]) / cross
                    u = (gap[..., 0] * d[..., 1] - gap[..., 1] * d[..., 0]) / cross
                met = ((cross != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)).any(axis=(1, 2))
                near = np.minimum.reduce([_to_edges(p, q).min(axis=(1, 2)) for p, q in ((a[..., :2], b), (a[..., 2:], b), (b[..., :2], a), (b[..., 2:], a))])
                best[low : low + step] = np.minimum(best[low : low + step], np.where(met, 0.0, near))
        return np.where(within, 0.0, best)

    out = _numbers(column, many, lambda w: G.distance(G.decode(w), other))[:, 0]
    out[nulls(column)] = np.inf
    return out


# ---- rectangles


def rectangles(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which shapes are rectangles as ``geometry.box`` makes them, and the sides of those as x0, y0, x1, y1."""
    begins, sizes, data = _parts(column)
    found, sides = np.zeros(len(sizes), dtype=bool), np.zeros((len(sizes), 4))
    places = np.flatnonzero(sizes == len(_RECTANGLE) + 80)
    if len(places):
        rows = data[begins[places][:, None] + np.arange(len(_RECTANGLE) + 80)]
        p = np.ascontiguousarray(rows[:, len(_RECTANGLE) :]).view("<f8")
        fits = (rows[:, : len(_RECTANGLE)] == np.frombuffer(_RECTANGLE, np.uint8)).all(axis=1) & np.isfinite(p).all(axis=1)
        fits &= (p[:, 0] < p[:, 2]) & (p[:, 1] < p[:, 5]) & (p[:, [3, 4, 6, 7, 8, 9]] == p[:, [1, 2, 0, 5, 0, 1]]).all(axis=1) & (p[:, 7] == p[:, 5])
        found[places[fits]] = True
        sides[places[fits]] = p[fits][:, [0, 1, 2, 5]]
    return found, sides


def box_rows(sides: np.ndarray) -> np.ndarray:
    """The bytes of boxes, a row each."""
    rows = np.empty((len(sides), len(_RECTANGLE) + 80), np.uint8)
    rows[:, : len(_RECTANGLE)] = np.frombuffer(_RECTANGLE, np.uint8)
    rows[:, len(_RECTANGLE) :] = np.ascontiguousarray(sides[:, [0, 1, 2, 1, 2, 3, 0, 3, 0, 1]], "<f8").view(np.uint8)
    return rows


def boxes(sides: np.ndarray) -> pa.Array:
    return column_of(len(sides), [(np.arange(len(sides)), box_rows(sides))], {})


def clear(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs of rectangles whose sides are the same or well apart."""
    out = np.ones(len(a), dtype=bool)
    for axis in (0, 1):
        v = np.stack([a[:, axis], a[:, axis + 2], b[:, axis], b[:, axis + 2]])
        for i in range(4):
            for j in range(i):
                gap = np.abs(v[i] - v[j])
                out &= (gap == 0) | (gap > _CLEAR)
    return out


def gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The distance of rectangles."""
    dx, dy = (np.maximum(0, np.maximum(b[:, k] - a[:, k + 2], a[:, k] - b[:, k + 2])) for k in (0, 1))
    return np.hypot(dx, dy)


@lru_cache(maxsize=4096)
def _pattern(xs: tuple[int, ...], ys: tuple[int, ...], operation: str) -> tuple[bytes, list[tuple[int, np.ndarray, np.ndarray]]] | None:
    """The overlay of two rectangles whose sides have these ranks: its bytes, and for each ring where it is and which sides its vertices have."""
    a, b = (G.box(xs[k], ys[k], xs[k + 1], ys[k + 1]) for k in (0, 2))
    area = G.overlay(a, b, operation)
    if not area:
        return None
    data = G.encode(area)
    rings = []
    for at, count, _, _ in _walk(data)[0]:
        ranks = np.rint(np.frombuffer(data, "<f8", 2 * count, at)).astype(int).reshape(count, 2)
        rings.append((at, np.array([xs.index(r) for r in ranks[:, 0]]), np.array([ys.index(r) for r in ranks[:, 1]])))
    return data, rings


def rectangle_overlays(a: np.ndarray, b: np.ndarray, operation: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Places and the bytes of the overlays there; those that leave nothing are left out. How the sides follow one another decides the rings."""
    values = [np.stack([a[:, k], a[:, k + 2], b[:, k], b[:, k + 2]], axis=1) for k in (0, 1)]
    codes = np.zeros(len(a), np.int64)
    for v in values:
        for i, j in ((0, 2), (0, 3), (1, 2), (1, 3)):
            codes = codes * 3 + np.sign(v[:, i] - v[:, j]).astype(np.int64) + 1
    out = []
    for code in np.unique(codes).tolist():
        places = np.flatnonzero(codes == code)
        ranks = [tuple(np.unique(v[places[0]], return_inverse=True)[1].ravel().tolist()) for v in values]
        made = _pattern(*ranks, operation)
        if made is None:
            continue
        data, rings = made
        rows = np.tile(np.frombuffer(data, np.uint8), (len(places), 1))
        for at, ix, iy in rings:
            vertices = np.stack([values[0][places][:, ix], values[1][places][:, iy]], axis=2)
            rows[:, at : at + 16 * len(ix)] = np.ascontiguousarray(vertices, "<f8").view(np.uint8).reshape(len(places), -1)
        out.append((places, rows))
    return out


def _pairs(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Which pairs are rectangles, their sides, and the places of other pairs without NULL."""
    (fl, a), (fr, b) = rectangles(left), rectangles(right)
    both = fl & fr
    return both, a, b, np.flatnonzero(~both & ~nulls(left) & ~nulls(right)).tolist()


def overlays(left: pa.Array, right: pa.Array, operation: str) -> pa.Array:
    """NULL where nothing of polygonal area is left."""
    both, a, b, others = _pairs(left, right)
    quick = both.copy()
    quick[both] = clear(a[both], b[both])
    places = np.flatnonzero(quick)
    blocks = [(places[p], rows) for p, rows in rectangle_overlays(a[quick], b[quick], operation)]
    known: dict[tuple[bytes, bytes], bytes | None] = {}
    rest = {}
    for place in others + np.flatnonzero(both & ~quick).tolist():
        pair = left[place].as_py(), right[place].as_py()
        if pair not in known:
            area = G.overlay(*(G.decode(w).polygons for w in pair), operation)
            known[pair] = G.encode(area) if area else None
        rest[place] = known[pair]
    return column_of(len(left), blocks, rest)


def distances(left: pa.Array, right: pa.Array) -> np.ndarray:
    """NaN where one is NULL."""
    both, a, b, others = _pairs(left, right)
    out = np.full(len(left), np.nan)
    out[both] = gaps(a[both], b[both])
    known: dict[tuple[bytes, bytes], float] = {}
    for place in others:
        pair = left[place].as_py(), right[place].as_py()
        if pair not in known:
            known[pair] = G.distance(*map(G.decode, pair))
        out[place] = known[pair]
    return out


def within(left: pa.Array, right: pa.Array, most: np.ndarray) -> pa.Array:
    """Whether two shapes are at most so far apart; empty shapes are not, NULL where one is NULL."""
    both, a, b, others = _pairs(left, right)
    out = np.zeros(len(left), dtype=bool)
    out[both] = gaps(a[both], b[both]) <= most[both]
    known: dict[tuple, bool] = {}
    for place in others:
        key = left[place].as_py(), right[place].as_py(), float(most[place])
        if key not in known:
            known[key] = G.dwithin(G.decode(key[0]), G.decode(key[1]), key[2])
        out[place] = known[key]
    return pa.array(out, mask=nulls(left) | nulls(right))


def valid(column: pa.Array) -> pa.Array:
    found, sides = rectangles(column)
    out = found & (sides[:, 2] - sides[:, 0] > _CLEAR) & (sides[:, 3] - sides[:, 1] > _CLEAR)
    for place, value in _once(column, np.flatnonzero(~out & ~nulls(column)).tolist(), lambda w: G.is_valid(G.decode(w).polygons)):
        out[place] = value
    return pa.array(out, mask=nulls(column))


def cleaned(column: pa.Array) -> pa.Array:
    """As ``geometry.clean``; anything without polygons stays as it is."""

    def one(wkb: bytes) -> bytes:
        area = G.decode(wkb).polygons
        return G.encode(G.clean(area)) if area else wkb

    found, sides = rectangles(column)
    width, height = sides[:, 2] - sides[:, 0], sides[:, 3] - sides[:, 1]
    # a rectangle stays if its corners are off the diagonal by more than the tolerance, 22 metres in degrees, could ever be
    with np.errstate(divide="ignore", invalid="ignore"):
        stays = found & (width * height > 1e-5) & (width * height / np.hypot(width, height) > 1e-3)
    return column_of(len(column), [(np.flatnonzero(stays), box_rows(sides[stays]))], dict(_once(column, np.flatnonzero(~stays & ~nulls(column)).tolist(), one)))


def representative_points(column: pa.Array) -> np.ndarray:
    found, sides = rectangles(column)
    out = np.full((len(column), 2), np.nan)
    out[found] = (sides[found, :2] + sides[found, 2:]) / 2
    for place, value in _once(column, np.flatnonzero(~found & ~nulls(column)).tolist(), lambda w: G.representative_point(a) if (a := G.decode(w).polygons) else None):
        if value is not None:
            out[place] = value
    return out


# ---- growth


def nested_growth(sides: np.ndarray, begins: np.ndarray, quick: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array, np.ndarray]:
    """For the groups marked ``quick``, rows of rectangles one after the other: the rows whose rectangle, cut by all later ones of its group, outgrows the one before; the
    last row before the next of those; the cut rectangles and what they add. Last come the groups that are not clear, which are left out.
    """
    ends, sizes = begins[1:], np.diff(begins)
    cut, alive, odd = sides.copy(), np.zeros(len(sides), dtype=bool), np.zeros(len(sizes), dtype=bool)
    open_ = np.flatnonzero(quick)
    alive[ends[open_] - 1] = True
    step = 1
    while len(open_ := open_[(sizes[open_] > step) & ~odd[open_]]):
        at = ends[open_] - 1 - step
        later = cut[at + 1]
        odd[open_[alive[at + 1] & ~clear(sides[at], later)]] = True
        cut[at] = np.concatenate([np.maximum(sides[at, :2], later[:, :2]), np.minimum(sides[at, 2:], later[:, 2:])], axis=1)
        alive[at] = alive[at + 1] & (cut[at, :2] < cut[at, 2:]).all(axis=1)
        step += 1
    group = np.repeat(np.arange(len(sizes)), sizes)
    alive &= ~odd[group]
    before = np.zeros(len(sides), dtype=bool)
    before[1:] = alive[:-1] & (group[1:] == group[:-1])
    same = np.zeros(len(sides), dtype=bool)
    same[1:] = (cut[1:] == cut[:-1]).all(axis=1)
    grown = alive & ~(before & same)
    first = np.flatnonzero(grown)
    last = ends[group[first]] - 1
    if len(first) > 1:
        follows = group[first[1:]] == group[first[:-1]]
        last[:-1][follows] = first[1:][follows] - 1
    alone = ~before[first]
    blocks = [(np.flatnonzero(alone), box_rows(cut[first[alone]]))]
    places, later = np.flatnonzero(~alone), first[~alone]
    blocks += [(places[p], rows) for p, rows in rectangle_overlays(cut[later], cut[later - 1], "difference")]
    return first, last, boxes(cut[first]), column_of(len(first), blocks, {}), odd
