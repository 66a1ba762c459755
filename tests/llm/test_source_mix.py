from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction
from math import ceil, floor

import numpy as np
import pytest

from cinderlake.llm import source_mix as M


def simulate(blocks, weights):
    """Earliest deadline first, slot by slot, with renormalised rates when a source runs out."""
    left, out = {s: n for s, n in blocks.items() if n}, []
    while left:
        total, sent, slot = sum(weights[s] for s in left), dict.fromkeys(left, 0), 0
        while all(sent[s] < left[s] for s in left):
            rate = {s: Fraction(weights[s], total) for s in left}
            ready = [s for s in left if floor(sent[s] / rate[s]) <= slot]
            pick = min(ready, key=lambda s: (ceil((sent[s] + 1) / rate[s]), -weights[s], s is None, s or ""))
            assert ceil((sent[pick] + 1) / rate[pick]) > slot
            out.append((pick, blocks[pick] - left[pick] + sent[pick]))
            sent[pick] += 1
            slot += 1
            for s in left:
                assert abs(sent[s] - slot * rate[s]) < 1
        left = {s: n - sent[s] for s, n in left.items() if n > sent[s]}
    return out


@pytest.mark.parametrize("seed", range(6))
def test_schedule_equals_simulation(make, seed):
    r = random.Random(seed)
    weights = {f"s{k}": r.randint(1, 7) for k in range(r.randint(1, 5))}
    rows, sizes = [], {}
    for s in [*weights, None, "other"]:
        sizes[s] = r.randint(1, 60)
        rows += [(len(rows) + k, "t", "en", s) for k in range(sizes[s])]
    got = M.schedule(make(rows), weights, 1, 4).collect()
    assert sorted(x.position for x in got) == list(range(len(rows)))
    blocks = {s: -(-n // 4) for s, n in sizes.items()}
    want = simulate(blocks, {s: weights.get(s, 1) for s in sizes})
    order = list(dict.fromkeys((x.source, x.block) for x in sorted(got, key=lambda x: x.position)))
    assert order == want
    assert Counter(x.source for x in got) == Counter(sizes)


def integer_simulation(blocks, weights):
    """The same in integers, all sources of a slot at once: for many sources."""
    names = sorted((s for s in blocks if blocks[s]), key=lambda s: (-weights[s], s))
    left, out = np.array([blocks[s] for s in names]), []
    done = np.zeros(len(names), np.int64)
    share = np.array([weights[s] for s in names])
    alive, slot, sent = np.arange(len(names)), 0, np.zeros(len(names), np.int64)
    while len(alive):
        q, total = share[alive], share[alive].sum()
        ready = np.flatnonzero(sent[alive] * total // q <= slot)
        deadline = -(-(sent[alive][ready] + 1) * total // q[ready])
        pick = alive[ready[np.argmin(deadline)]]  # the first of equals is first in the order of names
        out.append((names[pick], int(done[pick])))
        done[pick] += 1
        sent[pick] += 1
        slot += 1
        assert (np.abs(sent[alive] * total - slot * q) < total).all()
        if done[pick] == left[pick]:
            alive, slot, sent = alive[done[alive] < left[alive]], 0, np.zeros(len(names), np.int64)
    return out


@pytest.mark.parametrize("sources", [1, 65, 200, 2000])
def test_many_sources(sources):
    r = random.Random(sources)
    rows = {f"s{k:04}": r.randint(1, 400 if sources < 300 else 30) for k in range(sources)}
    weights = {s: r.choice((1, 1, 1, 2, 5)) for s in rows}
    made = M.plan(rows, weights, 8)
    want = integer_simulation({s: -(-n // 8) for s, n in rows.items()}, weights)
    source = np.array([made.names.index(s) for s, _ in want]) if sources < 300 else np.array([int(s[1:]) for s, _ in want])
    _, slot = made.place(source, np.array([b for _, b in want]))
    assert slot.tolist() == list(range(len(want)))
    sizes = [min(8, rows[s] - 8 * b) for s, b in want]
    assert (slot * 8 - made.lacking(slot)).tolist() == np.cumsum([0, *sizes])[:-1].tolist()
    for low, high in ((0, sources), (sources // 3, sources // 2 + 1)):
        part, inside = made.of(low, high), (source >= low) & (source < high)
        assert part.place(source[inside] - low, np.array([b for _, b in want])[inside])[1].tolist() == slot[inside].tolist()


def test_broadcast_in_parts(make):
    rows = [(k, "t", "en", None if k % 9 == 0 else f"s{k % 70}") for k in range(900)]
    whole, parts = (sorted(M.schedule(make(rows), {"s1": 3}, 1, 4, schedule_bytes=n).collect(), key=lambda x: x.position) for n in (1 << 20, 2000))
    assert whole == parts and [x.position for x in whole] == list(range(900))


def test_position_takes_a_free_name(spark, tmp_path):
    docs = spark.createDataFrame([(1, "t", "a", "x", "y"), (2, "u", "b", "x", "y")], "doc_id bigint, text string, source string, `Mix_Position` string, mix_position_2 string")
    out = M.mix(docs)
    assert out.columns == [*docs.columns, "mix_position_3"]
    out.write.parquet(str(tmp_path / "out"))
    assert {r.Mix_Position for r in out.collect()} == {"x"} and sorted(r.mix_position_3 for r in out.collect()) == [0, 1]


def test_mix_keeps_rows_and_orders_them(make, odd_rows):
    docs = make(odd_rows)
    out = M.mix(docs, {"a": 2}, 1, 2)
    assert out.columns == [*docs.columns, "mix_position"]
    rows = out.collect()
    assert [r.mix_position for r in rows] == list(range(len(odd_rows)))
    assert Counter((r.doc_id, r.text, r.source) for r in rows) == Counter((i, t, s) for i, t, _, s in odd_rows)
    assert M.mix(make([])).count() == 0
    with pytest.raises(ValueError):
        M.schedule(docs, {"a": 0})
