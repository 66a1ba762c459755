"""Growth and unions of many keys at once give what the kernel gives for each key."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from cinderlake.functions import batches as B
from cinderlake.functions import geometry as G
from cinderlake.functions import spatial


def groups(seed: int) -> list[list[tuple]]:
    r = np.random.default_rng(seed)
    out = []
    for _ in range(300):
        low, size = r.integers(0, 4, (int(r.integers(1, 7)), 2)) / 4.0, r.integers(1, 9) / 4.0
        out.append([(*p, *(p + size * r.integers(1, 4) / 2)) for p in low])
    out.append([(0, 0, 1, 1), (1, 0, 2, 1), (0, 0, 3, 3)])  # those that only touch leave nothing, and so do all before
    out.append([(0, 0, 1, 1), (0, 0, 1 + 5e-9, 1)])  # too near to tell
    return out


def test_growth_of_many_groups():
    found = groups(1)
    begins = np.concatenate([[0], np.cumsum([len(g) for g in found])])
    sides = np.array([s for g in found for s in g], dtype=float)
    first, last, cut, rings, odd = B.nested_growth(sides, begins, np.ones(len(found), dtype=bool))
    assert np.flatnonzero(odd).tolist() == [len(found) - 1]
    rows = iter(zip(first.tolist(), last.tolist(), cut.to_pylist(), rings.to_pylist()))
    for begin, group in zip(begins.tolist(), found[:-1]):
        corrected = G.suffix_intersections([G.box(*s) for s in group])
        grown = G.growth_rings(corrected)
        for (i, ring), following in zip(grown, [*(k for k, _ in grown[1:]), len(group)]):
            a, b, shape, added = next(rows)
            assert (a, b) == (begin + i, begin + following - 1)
            assert np.isclose(G.area_of(G.decode(shape).polygons), G.area_of(corrected[i])) and np.isclose(G.area_of(G.decode(added).polygons), G.area_of(ring))
    assert next(rows, None) is None


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_keys_stay_whole(size):
    keys = pa.array([None, None, 1, 2, 2, 2, 2, 2, 3, 4, 4, 5], pa.int64())
    batches = [pa.RecordBatch.from_arrays([keys[k : k + size], pa.array(range(k, min(len(keys), k + size)))], ["key", "n"]) for k in range(0, len(keys), size)]
    got = []
    for rows, at in spatial.whole_keys(iter([batches[0].slice(0, 0), *batches])):
        got += [rows.slice(a, b - a).to_pydict() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    assert [g["key"] for g in got] == [[None] * 2, [1], [2] * 5, [3], [4] * 2, [5]] and [n for g in got for n in g["n"]] == list(range(12))


def test_differential_mixes_rectangles_and_others(spark):
    r = np.random.default_rng(2)
    triangle = lambda h: G.encode([[np.array([(-h, -h), (h, -h), (0.0, h), (-h, -h)])]])
    rows = []
    for key in range(40):
        for place, h in enumerate(r.uniform(0.1, 1, 4).tolist()):
            shape = triangle(h) if key % 4 == 1 else G.encode(G.box(-h, -h, h, h))
            rows.append((key, place, None if key % 4 == 2 and place == 1 else bytearray(shape)))
    got = spatial.differential(spark.createDataFrame(rows, "k bigint, seq bigint, shape binary").repartition(3), "k", "seq", "shape").collect()
    want = {}
    for key in range(40):
        corrected = G.suffix_intersections([None if w is None else G.decode(bytes(w)).polygons for k, _, w in rows if k == key])
        grown = G.growth_rings(corrected)
        for (i, ring), following in zip(grown, [*(k for k, _ in grown[1:]), 4]):
            want[key, i] = (following - 1, G.area_of(ring), G.geodesic_area(corrected[i]), G.geodesic_area(ring))
    assert sorted((x.k, x.seq) for x in got) == sorted(want)
    for x in got:
        mine = (x.last_seq, G.area_of(G.decode(bytes(x.ring)).polygons), x.acres * spatial.SQUARE_METERS_PER_ACRE, x.ring_acres * spatial.SQUARE_METERS_PER_ACRE)
        assert np.allclose(mine, want[x.k, x.seq], rtol=1e-9)
