"""Whole columns of shapes give what the kernel gives for each shape."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pytest

from cinderlake.functions import batches as B
from cinderlake.functions import geometry as G
from cinderlake.functions import spatial


def shapes() -> list[bytes | None]:
    r = np.random.default_rng(7)
    boxes = [G.encode(G.box(x, y, x + w, y + h)) for x, y, w, h in np.concatenate([r.integers(0, 6, (60, 2)), r.integers(1, 5, (60, 2))], axis=1) / 4.0]
    small = [G.encode(G.box(x, y, x + 0.004, y + 0.003)) for x, y in r.uniform(0, 1, (6, 2))]
    triangles = [G.encode([[np.array([p, q, s, p])]]) for p, q, s in r.uniform(0, 2, (12, 3, 2))]
    holed = [G.encode([[G.box(x, 0, x + 2, 2)[0][0], G.box(x + 0.5, 0.5, x + 1, 1)[0][0][::-1]], G.box(x + 5, 0, x + 6, 1)[0]]) for x in r.uniform(0, 1, 6)]
    lines = [G.encode_line(line) for line in r.uniform(0, 2, (5, 3, 2))]
    points = [G.encode_point(p) for p in r.uniform(0, 2, (5, 2))]
    big = [struct.pack(">BIII", 0, 3, 1, 4) + np.array([(x, 0), (x + 1, 0), (x, 1), (x, 0)], ">f8").tobytes() for x in range(5)]
    with_z = [struct.pack("<BIII", 1, 1003, 1, 4) + np.array([(x, 0, 9), (x + 1, 0, 9), (x, 1, 9), (x, 0, 9)], "<f8").tobytes() for x in range(5)]
    flat = [G.encode(G.box(1, 1, 1, 2)), G.encode(G.box(0, 0, 1e-9, 1)), G.encode([]), None, None]
    out = boxes + small + triangles + holed + lines + points + big + with_z + flat
    return [out[k] for k in r.permutation(len(out))]


def each(column, one):
    return [None if w is None else one(w) for w in column.to_pylist()]


def same(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (w is None and (g is None or np.isnan(g).all())) or np.allclose(g, w, rtol=1e-12, atol=1e-12)


# a slice too, whose buffers begin elsewhere
@pytest.fixture(params=[0, 7])
def column(request):
    return pa.array(shapes(), pa.binary())[request.param :]


def test_measures(column):
    polygons = lambda w: G.decode(w).polygons
    same(B.areas(column), each(column, lambda w: G.area_of(polygons(w))))
    same(B.geodesic_areas(column), each(column, lambda w: G.geodesic_area(polygons(w))))
    same(B.bounds(column), each(column, lambda w: G.bounds(G.decode(w))))
    same(B.representative_points(column), each(column, lambda w: G.representative_point(polygons(w)) if polygons(w) else None))
    assert B.valid(column).to_pylist() == each(column, lambda w: G.is_valid(polygons(w)))
    assert B.cleaned(column).to_pylist() == each(column, lambda w: G.encode(G.clean(polygons(w))) if polygons(w) else w)
    assert B.map_coordinates(column, lambda p: p * 2 + 1).to_pylist() == each(column, lambda w: G.map_coordinates(w, lambda p: p * 2 + 1))
    border = G.decode(G.encode_line(np.array([(0.5, -1.0), (0.5, 0.4), (1.7, 0.4)])))
    far = [np.inf if w is None else G.distance(G.decode(w), border) for w in column.to_pylist()]
    same(B.distances_to(column, border), far)
    area = G.decode(G.encode(G.box(0.9, 0.9, 1.1, 1.1)))
    same(B.distances_to(column, area), [np.inf if w is None else G.distance(G.decode(w), area) for w in column.to_pylist()])


def test_pairs(column):
    other = column.take(pa.array(np.random.default_rng(2).permutation(len(column))))
    pairs = [None if a is None or b is None else (G.decode(a), G.decode(b)) for a, b in zip(column.to_pylist(), other.to_pylist())]
    same(B.distances(column, other), [p and G.distance(*p) for p in pairs])
    assert B.within(column, other, np.full(len(column), 0.5)).to_pylist() == [p and G.dwithin(*p, 0.5) for p in pairs]


def test_overlays():
    # all ways in which two intervals lie to each other, on both axes
    sides = [(a, b) for a in range(4) for b in range(a + 1, 4)]
    rows = [((x[0], y[0], x[1], y[1]), (u[0], v[0], u[1], v[1])) for x in sides for y in sides for u in sides for v in sides]
    a, b = (pa.array([G.encode(G.box(*r[k])) for r in rows], pa.binary()) for k in (0, 1))
    for name in ("intersection", "union", "difference", "symmetric_difference"):
        got = B.overlays(a, b, name).to_pylist()
        for k, (g, (p, q)) in enumerate(zip(got, rows)):
            w, h = min(p[2], q[2]) - max(p[0], q[0]), min(p[3], q[3]) - max(p[1], q[1])
            size = [(r[2] - r[0]) * (r[3] - r[1]) for r in (p, q)]
            both = max(0, w) * max(0, h)
            want = {"intersection": both, "union": sum(size) - both, "difference": size[0] - both, "symmetric_difference": sum(size) - 2 * both}[name]
            assert (g is None) == (want == 0) and (g is None or G.area_of(G.decode(g).polygons) == want)
    # sides that all but meet snap, as ever
    slim = [pa.array([G.encode(G.box(*r))] * 5, pa.binary()) for r in ((0, 0, 1, 1), (1 - 5e-9, 0, 2, 1))]
    want = G.overlay(G.box(0, 0, 1, 1), G.box(1 - 5e-9, 0, 2, 1), "union")
    assert B.overlays(*slim, "union").to_pylist() == [G.encode(want)] * 5


def test_a_column_of_rectangles_takes_few_overlays(monkeypatch):
    calls, overlay = [], G.overlay
    monkeypatch.setattr(G, "overlay", lambda *x: calls.append(1) or overlay(*x))
    B._pattern.cache_clear()
    r = np.random.default_rng(3)
    a, b = (B.boxes(np.concatenate([low := r.uniform(0, 1, (5000, 2)), low + r.uniform(0.1, 1, (5000, 2))], axis=1)) for _ in range(2))
    assert B.overlays(a, b, "union").null_count == 0 and len(calls) <= 169


def test_a_border_is_compared_with_whole_columns(monkeypatch):
    r = np.random.default_rng(4)
    low = r.uniform(-5, 5, (5000, 2))
    column = B.boxes(np.concatenate([low, low + r.uniform(0.1, 1, (5000, 2))], axis=1))
    border = G.decode(G.encode_line(r.uniform(-5, 5, (4, 2))))
    want = [G.distance(G.decode(w), border) for w in column.slice(0, 200).to_pylist()]
    monkeypatch.setattr(G, "distance", None)
    got = B.distances_to(column, border)
    assert np.allclose(got[:200], want, rtol=1e-12, atol=1e-12) and len(got) == 5000 and (got == 0).any()


def test_equal_shapes_of_a_key_unite_once(spark):
    rows = [(k % 3, bytearray(G.encode(G.box(k % 5, 0, k % 5 + 1, 1 + k % 3)))) for k in range(30_000)] + [(9, None)]
    frame = spark.createDataFrame(rows, "k int, shape binary").coalesce(1)
    got = {r.k: r.shape and G.area_of(G.decode(bytes(r.shape)).polygons) for r in spatial.union_by(frame, "k", "shape").collect()}
    assert got == {0: 5, 1: 10, 2: 15, 9: None}
    table = pa.table({"key": [k for k, _ in rows], "shape": pa.array([s and bytes(s) for _, s in rows], pa.binary())})
    assert spatial.distinct(table).num_rows == 16
