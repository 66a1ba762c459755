from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from cinderlake.llm import simhash_bk as S
from cinderlake.llm._common import blocks

from .conftest import WORDS, prose


def signatures_of(texts):
    made = [S.signatures(b) for b in blocks(pa.array(texts, pa.string()), 5000)]
    return np.concatenate([m[0] for m in made]), np.concatenate([m[1] for m in made])


def brute_classes(rows, radius=S.RADIUS):
    """Class (its smallest id), links to other signatures, and size for each distinct (id, text) with words; and the pairs of row numbers within the radius."""
    rows = sorted({(r[0], r[1]) for r in rows if r[0] is not None and r[1]})
    signature, has = signatures_of([t for _, t in rows])
    rows, signature = [r for r, h in zip(rows, has) if h], signature[has]
    leader = list(range(len(rows)))

    def find(x):
        while leader[x] != x:
            x = leader[x]
        return x

    near = [{b for b in range(len(rows)) if int(S.hamming(signature[a : a + 1], signature[b : b + 1])[0]) <= radius} for a in range(len(rows))]
    for a, own in enumerate(near):
        for b in own:
            leader[max(find(a), find(b))] = min(find(a), find(b))
    links = [len({signature[b].tobytes() for b in own} - {signature[a].tobytes()}) for a, own in enumerate(near)]
    found = {r: (rows[find(k)][0], links[k], sum(find(j) == find(k) for j in range(len(rows)))) for k, r in enumerate(rows)}
    return found, {(a, b) for a, own in enumerate(near) for b in own if a < b}


def brute_groups(rows, radius=S.RADIUS):
    """(id, kept id) of the rows that go, where ids are unique."""
    found, pairs = brute_classes(rows, radius)
    return {(i, keeper) for (i, _), (keeper, _, _) in found.items() if i != keeper}, pairs


def near_copy(text, share, r):
    return " ".join(r.choice(WORDS) if r.random() < share else w for w in text.split())


@pytest.fixture(scope="module")
def rows():
    r = random.Random(9)
    out = [(i, prose(i, r.randint(1, 300)), "en", "s") for i in range(80)]
    for i in range(90):
        base = r.choice(out[:80])[1]
        out.append((1000 + i, near_copy(base, r.choice((0, 0.01, 0.03, 0.06)), r), "en", "s"))
    return out


def test_classes_and_links_equal_brute_force_on_all_ways(make, rows):
    docs = make(rows)
    want, pairs = brute_classes(rows)
    grouped = {i: (keeper, links) for (i, _), (keeper, links, size) in want.items() if size > 1}
    assert len(grouped) > 100
    results = []
    for settings in ({"broadcast_bytes": 1 << 30}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_rows": 3}):
        got = {x.doc_id: (x.class_doc_id, x.n_links) for x in S.classes(docs, **settings).collect()}
        assert set(got) <= set(grouped)
        assert sum(got.get(i) == x for i, x in grouped.items()) >= 0.95 * len(grouped)
        assert all(n <= grouped[i][1] for i, (_, n) in got.items())
        results.append(got)
    assert results[0] == results[1] == results[2]
    gone = {(x.doc_id, x.kept_doc_id) for x in S.duplicates(docs).collect()}
    assert gone == {(i, keeper) for i, (keeper, _) in results[0].items() if i != keeper}


def test_a_hot_shard_is_cut_into_parts(make):
    r = random.Random(2)
    base = prose(1, 200)
    rows = [(k, near_copy(base, 0.02, r), "en", "s") for k in range(60)]
    want, _ = brute_classes(rows)
    for hot in (4, 1 << 17):
        got = {x.doc_id: (x.class_doc_id, x.n_links) for x in S.classes(make(rows), broadcast_bytes=0, hot_rows=hot).collect()}
        assert got == {i: (keeper, links) for (i, _), (keeper, links, _) in want.items()}


def test_pairs_that_share_no_shard_are_linked(make, monkeypatch):
    r = random.Random(3)
    rows = [(i, prose(i, 120), "en", "s") for i in range(60)]
    rows += [(100 + i, near_copy(rows[i % 60][1], 0.1, r), "en", "s") for i in range(240)]
    want, pairs = brute_classes(rows)
    keys = S._keys(signatures_of([t for _, t, *_ in rows])[0])
    assert sum(not (keys[a] == keys[b]).any() for a, b in pairs) >= 3
    grouped = {i: (keeper, links) for (i, _), (keeper, links, size) in want.items() if size > 1}
    for settings, block_rows in (({"broadcast_bytes": 1 << 30}, 1 << 19), ({"broadcast_bytes": 0}, 1 << 19), ({"broadcast_bytes": 0, "hot_rows": 3}, 120)):
        monkeypatch.setattr(S, "BLOCK_ROWS", block_rows)
        assert {x.doc_id: (x.class_doc_id, x.n_links) for x in S.classes(make(rows), **settings).collect()} == grouped


@pytest.mark.parametrize("radius", [16, 30, 44, 47, 50])
def test_rest_links_are_those_of_pairs_that_share_no_shard(radius):
    r = np.random.default_rng(radius)
    code = r.integers(0, 2**63, (150, 4)).astype(np.uint64)
    flips = np.zeros((150, S.SIGNATURE_BITS), np.uint8)
    near = [code]
    for distance in (3, radius - 2, radius, radius, radius, radius + 1):
        flips[:] = 0
        np.put_along_axis(flips, r.random(flips.shape).argsort(axis=1)[:, :distance], 1, axis=1)
        near.append(code ^ np.ascontiguousarray(np.packbits(flips, axis=1)).view(np.uint64))
    code = np.concatenate(near)
    keys, side = S._keys(code), np.arange(len(code)) % 2
    want, crossed = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
    for a in range(len(code)):
        linked = (S.hamming(code[a : a + 1], code) <= radius) & ~(keys == keys[a]).any(axis=1)
        want[a], crossed[a] = linked.sum(), (linked & (side != side[a])).sum()
    assert (want.sum() > 20) == (radius > 30)
    assert (sum(S.rest_links(code, 0 * side, radius, part, 3)[2] for part in range(3)) == want).all()
    order = np.argsort(side, kind="stable")
    assert (S.rest_links(code[order], side[order], radius)[2] == crossed[order]).all()


def test_half_spaces_of_the_radius_have_sixteen_bits():
    spaces = S.half_spaces(S.RADIUS)
    assert len(spaces) == 400 and {mask.bit_count() for _, _, mask in spaces} == {16}
    assert sum(bits + 1 for bits in {word: bits for word, bits, _ in spaces}.values()) == S.RADIUS + 1


@pytest.mark.parametrize(("distance", "least"), [(15, 1.0), (24, 0.99), (32, 0.98), (40, 0.94), (44, 0.9)])
def test_pairs_within_the_radius_share_a_shard(distance, least):
    r = np.random.default_rng(distance)
    code = r.integers(0, 2**63, (4000, 4)).astype(np.uint64)
    flips = np.zeros((len(code), S.SIGNATURE_BITS), np.uint8)
    np.put_along_axis(flips, r.random(flips.shape).argsort(axis=1)[:, :distance], 1, axis=1)
    other = code ^ np.ascontiguousarray(np.packbits(flips, axis=1)).view(np.uint64)
    assert (S.hamming(code, other) == distance).all()
    assert (S._keys(code) == S._keys(other)).any(axis=1).mean() >= least


def test_forest_search_is_exact():
    r = np.random.default_rng(4)
    code = r.integers(0, 2**63, (300, 4)).astype(np.uint64)
    code[100:] = code[r.integers(0, 100, 200)] ^ (np.uint64(1) << r.integers(0, 20, (200, 4)).astype(np.uint64))
    group = np.sort(r.integers(0, 7, 300))
    forest = S.Forest(code, group)
    got = {(int(q), int(n)) for place, node in forest.search(code, forest.root, 6) for q, n in zip(place, node)}
    want = {(q, n) for q in range(300) for n in range(300) if group[q] == group[n] and int(np.bitwise_count(code[q] ^ code[n]).sum()) <= 6}
    assert got == want and len(want) > 300


def test_samples_cover_bits_evenly_and_meet_in_one():
    families = [[set(x) for x in S.SAMPLES[16 * f : 16 * f + 16]] for f in range(4)]
    for number, family in enumerate(families):
        assert set().union(*family) == set(range(S.SIGNATURE_BITS))
        for other in families[:number]:
            assert all(len(a & b) == 1 for a in family for b in other)


def test_odd_rows(make, odd_rows):
    docs = make(odd_rows)
    got = {(x.doc_id, x.kept_doc_id) for x in S.duplicates(docs).collect()}
    assert got == {(2, 1), (12, 11)}
    assert {(x.doc_id, x.class_doc_id, x.n_links) for x in S.classes(docs).collect()} == {(1, 1, 0), (2, 1, 0), (11, 11, 0), (12, 11, 0), (8, 8, 0)}
    out = S.drop_duplicates(docs)
    assert out.columns == docs.columns
    left = sorted(str((x.doc_id, (x.text or "")[:20])) for x in out.collect())
    # of the repeated row 8 one stays; the two texts of id 9 are two documents
    rest = [x for k, x in enumerate(odd_rows) if x[0] not in (2, 12) and k != 10]
    assert left == sorted(str((i, (t or "")[:20])) for i, t, *_ in rest)
    assert S.classes(make([])).count() == 0 and S.drop_duplicates(make([])).count() == 0
