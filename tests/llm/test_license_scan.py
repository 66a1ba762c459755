from __future__ import annotations

import re

import numpy as np
import pytest

from cinderlake.llm import license_scan as S
from cinderlake.llm.licenses import TEMPLATES

from .conftest import prose


def words_of(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())


def grams(words):
    return {tuple(words[i : i + S.SHINGLE]) for i in range(max(1, len(words) - S.SHINGLE + 1))}


def brute(rows, templates):
    """All windows of every class against all its templates, by exact containment."""
    out = {}
    for cls in S.Scanner(templates).classes:
        for i, text, *_ in rows:
            words = words_of(text)
            for at in range(0, max(1, len(words)), cls.stride):
                if words[at : at + cls.window]:
                    own = grams(words[at : at + cls.window])
                    for name, _, template in cls.members:
                        share = len(own & grams(words_of(templates[name]))) / len(template)
                        if share >= S.CONTAINMENT and share > out.get((i, name), (0, 0))[0]:
                            out[i, name] = (share, at)
    return out


def found(frame):
    return {(r.doc_id, r.license): (r.containment, r.word) for r in frame.collect()}


@pytest.fixture(scope="module")
def rows():
    out = []
    for k, text in enumerate(TEMPLATES.values()):
        words = text.split()
        out.append((10 * k, prose(k, 60 + 7 * k) + "\n" + text.upper() + "\n" + prose(50 + k, 30), "en", "s"))
        edited = [w for n, w in enumerate(words) if n % 40 != 7]
        out.append((10 * k + 1, prose(k, k) + " " + " ".join(edited) + " " + prose(90 + k, 5), "en", "s"))
        out.append((10 * k + 2, prose(k, 20) + " " + " ".join(words[: len(words) // 2]) + " " + prose(k, 20), "en", "s"))
    return out


def test_recall_against_brute_force(make, rows):
    want, got = brute(rows, TEMPLATES), found(S.scan(make(rows)))
    assert len(want) > 40 and set(got) <= set(want)
    assert len(got) >= 0.98 * len(want)
    for k, name in enumerate(TEMPLATES):
        assert got[10 * k, name][0] == 1.0


def test_bands_keep_their_promise():
    for cls in S.Scanner(TEMPLATES).classes:
        for name, shingles, _ in cls.members:
            number = [m[0] for m in cls.members].index(name)
            least = int(np.ceil(S.CONTAINMENT * len(shingles) - 1e-9))
            room = max(1, cls.window - S.SHINGLE + 1)
            misses = 0
            for trial in range(40):
                r = np.random.default_rng(trial)
                other = r.integers(0, 2**63, room - least).astype(np.uint64)
                misses += number not in cls.retrieve(np.concatenate([r.choice(shingles, least, replace=False), other]))
            assert misses <= 1


def test_odd_rows(make, odd_rows):
    rows = [*odd_rows, (40, "All rights reserved.", "en", "s"), (40, "All rights reserved.", "en", "s"), (41, "MIT", "en", "s"), (None, odd_rows[8][1] + "\nReleased under the MIT License.", "en", "s")]
    got = [(r.doc_id, r.license) for r in S.scan(make(rows)).collect()]
    assert sorted(got, key=str) == [(40, "all-rights-reserved")] * 2 + [(None, "mit-notice")]
    assert S.scan(make([])).count() == 0
    with pytest.raises(ValueError):
        S.scan(make([]), {"none": "The MIT"})
