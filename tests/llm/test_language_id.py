from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest

from cinderlake.llm import language_id as L
from cinderlake.llm._common import blocks


def texts_of(alphabet: str, seed: int, n: int) -> list[str]:
    r = np.random.default_rng(seed)
    syllables = [a + b for a in alphabet for b in "aeiou"]
    return [" ".join("".join(r.choice(syllables, 3)) for _ in range(int(r.integers(1, 40)))).capitalize() + "." for _ in range(n)]


def brute_grams(text: str) -> dict[tuple, int]:
    low = re.sub(r"[^a-z\x80-\U0010ffff]+", " ", "".join(c.lower() if len(c.encode()) == len(c.lower().encode()) and ord(c) < 256 else c for c in text)).strip()
    if not low:
        return {}
    chars = [int.from_bytes(c.encode(), "big") for c in f" {low} "]
    out: dict[tuple, int] = {}
    for n in L.ORDERS:
        for i in range(len(chars) - n + 1):
            g = chars[i : i + n]
            h = g[-1] * 0x9E3779B97F4A7C15
            for back in range(1, n):
                h += g[-1 - back] * 0x9E3779B97F4A7C15 * ((0xC2B2AE3D27D4EB4F ** (back + 1)) & (2**64 - 1))
            h &= 2**64 - 1
            h ^= h >> 29
            h = (h * (0xBF58476D1CE4E5B9 ^ (n << 1))) & (2**64 - 1)
            out[h >> (64 - L.BUCKET_BITS)] = out.get(h >> (64 - L.BUCKET_BITS), 0) + 1
    return out


def counted(texts: list[str | None]) -> list[dict[int, int]]:
    out: list[dict[int, int]] = [{} for _ in texts]
    for block in blocks(pa.array(texts, pa.string()), 200):
        for first, row, bucket, times in L.sparse_counts(block):
            for r, b, t in zip(row.tolist(), bucket.tolist(), times.tolist()):
                out[block.first + first + r][b] = t
    return out


def test_counts_equal_brute_force():
    texts = ["Abc", "", None, "é", "ÉCOLE d'été!", "a  b\n\nc", "123", "中文 x", "ßß 😀", *texts_of("bdk", 1, 40)]
    assert counted(texts) == [brute_grams(t or "") for t in texts]


@pytest.fixture(scope="module")
def labelled(make):
    rows = [(i, t, "xx", "s") for i, t in enumerate(texts_of("bdgk", 1, 300))] + [(1000 + i, t, "yy", "s") for i, t in enumerate(texts_of("lmns", 2, 300))]
    return make(rows)


def test_held_out_accuracy_and_rejection(make, labelled):
    model = L.train(labelled, train_rows=100)
    assert model.labels == ("xx", "yy")
    rows = [(i, t, None, "s") for i, t in enumerate(texts_of("bdgk", 3, 200))] + [(1000 + i, t, None, "s") for i, t in enumerate(texts_of("lmns", 4, 200))]
    got = L.identify(make(rows), model).collect()
    right = sum(r.language == ("xx" if r.doc_id < 1000 else "yy") for r in got)
    assert right >= 0.98 * len(rows)
    assert sum(r.accepted for r in got) >= 0.99 * len(rows)
    strange = L.identify(make([(1, "中文的汉字不在里面" * 5, None, "s")]), model).first()
    assert not strange.accepted


def test_odd_rows(make, labelled, odd_rows):
    model = L.train(labelled)
    docs = make(odd_rows)
    got = L.identify(docs, model).collect()
    assert len(got) == len(odd_rows)
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    for i in (3, 4, 5, 6):
        assert by[i].language is None and by[i].score is None and not by[i].accepted
    kept = L.keep_known_languages(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.accepted for r in got)
    assert L.identify(make([]), model).count() == 0
    empty = L.train(make([]))
    assert empty.labels == () and not any(r.accepted for r in L.identify(docs, empty).collect())
    assert L.keep_known_languages(docs, empty).count() == 0
