from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from cinderlake.llm import suffix_dedup as S

from .conftest import WORDS, prose


def brute(rows, passage):
    where = defaultdict(set)
    for i, text, *_ in rows:
        words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
        if i is not None:
            for k in range(len(words) - passage + 1):
                where[tuple(words[k : k + passage])].add((i, k))
    marked = defaultdict(set)
    for places in where.values():
        ids = {i for i, _ in places}
        if len(ids) > 1:
            for i, k in places:
                marked[i, min(ids)].add(k)
    out = set()
    for (i, kept), places in marked.items():
        for k in places:
            if k - 1 not in places:
                end = k
                while end + 1 in places:
                    end += 1
                out.add((i, k, end + passage, kept, i == kept))
    return out


def found(frame):
    return {(x.doc_id, x.first_word, x.end_word, x.kept_doc_id, x.is_kept) for x in frame.collect()}


@pytest.mark.parametrize(("ranges", "sample", "run"), [(50_000, 64, 100_000), (40, 1, 50)])
def test_equals_brute_force(make, monkeypatch, ranges, sample, run):
    monkeypatch.setattr(S, "RANGE_SUFFIXES", ranges)
    monkeypatch.setattr(S, "_SAMPLE", sample)
    monkeypatch.setattr(S, "RUN_SUFFIXES", run)
    r = random.Random(3)
    shared = [prose(500 + k, r.randint(8, 60)) for k in range(8)]
    rows = []
    for i in range(60):
        parts = [prose(1000 + 10 * i + k, r.randint(0, 40)) for k in range(3)]
        parts.insert(r.randint(0, 3), r.choice(shared))
        parts.insert(r.randint(0, 3), " ".join([r.choice(WORDS)] * r.choice((0, 0, 30))))
        rows.append((i, " ".join(parts), "en", "s"))
    rows += [(100 + k, rows[k][1].upper() + "!", "en", "s") for k in range(10)]
    for passage in (10, 13):
        want = brute(rows, passage)
        assert found(S.passages(make(rows), passage)) == want and len(want) > 50


def test_loser_tree_orders_and_compares_little():
    r = random.Random(0)
    for _ in range(50):
        runs = []
        for _ in range(r.randint(1, 9)):
            strings = sorted(b"".join(r.choice((b"aaaa", b"aaab", b"zaaa")) for _ in range(6)) for _ in range(r.randint(0, 25)))
            shared = [0] * len(strings)
            for i in range(1, len(strings)):
                while shared[i] < 6 and strings[i][: 4 * shared[i] + 4] == strings[i - 1][: 4 * shared[i] + 4]:
                    shared[i] += 1
            runs.append((strings, shared))
        tree, out = S.LoserTree(runs, 4), []
        for run, place, prefix in tree:
            string = runs[run][0][place]
            if out:
                same = 0
                while same < 6 and string[: 4 * same + 4] == out[-1][: 4 * same + 4]:
                    same += 1
                assert prefix == same
            out.append(string)
        assert out == sorted(x for strings, _ in runs for x in strings)


def test_odd_rows(make, odd_rows):
    got = found(S.passages(make(odd_rows)))
    assert got == brute(odd_rows, S.PASSAGE) and {i for i, *_ in got} == {1, 2}
    assert S.passages(make([])).count() == 0
    assert S.passages(make([(1, prose(1, 49), "en", "s"), (2, prose(1, 49), "en", "s")])).count() == 0
    twice = [(1, prose(1, 80), "en", "s"), (1, prose(1, 80), "en", "s"), (2, (prose(2, 70) + " ") * 2, "en", "s")]
    assert S.passages(make(twice)).count() == 0


def test_front_coding_round_trip():
    r = random.Random(4)
    keys = sorted(b"".join(r.choice((b"a ", b"bb ", b"abc ")) for _ in range(r.randint(1, 9))) for _ in range(300))
    shared, tails = S.encode(keys)
    assert S.decode(shared, np.array([len(k) for k in keys]), tails) == keys and len(tails) < sum(map(len, keys)) / 2
    order, words = S.merge_range([(keys[::2], [0, *(S.shared_bytes(a, b) for a, b in zip(keys[::2], keys[2::2]))]), (keys[1::2], [0, *(S.shared_bytes(a, b) for a, b in zip(keys[1::2], keys[3::2]))])])
    both = keys[::2] + keys[1::2]
    merged = [both[k] for k in order]
    assert merged == keys
    for a, b, n in zip(merged, merged[1:], words[1:]):
        x, y = a.split(), b.split()
        assert n == next((k for k, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))


def test_words_of_one_letter_and_long_words(make):
    r = random.Random(6)
    shared = " ".join(r.choice("abcdefgh") for _ in range(60))
    wide = " ".join(["x" * 70_000, *(r.choice(WORDS) for _ in range(60))])
    rows = [(k, f"{prose(k, 9)} {shared if k % 2 else wide} {prose(50 + k, 9)}", "en", "s") for k in range(6)]
    assert found(S.passages(make(rows))) == brute(rows, S.PASSAGE)
